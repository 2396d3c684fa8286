from __future__ import annotations

import datetime as dt
import re
from html import unescape
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from gatherline.functions import markup
from gatherline.operators import site_pages
from gatherline.vocab import EMAIL, MORE_LINK, NAME_FAULTS, WEEKDAY

D = dt.date
PAGES = "/root/testdata/sf0.01/pages.parquet"
ODD = [
    "", "plain text", "<p>one<p>two <b>bold<p>three", "<ul><li>a<li>b <ul><li>inner</ul><li>c</ul>after", "<table><tr><td>1<td>2<tr><th>3</table>x",
    "</div>stray<div><br/>x<img src='a.png'>y</div></p>", "<dl><dt>t<dd>d<dt>u</dl>", "a < b and <1> c", "<div><p>x<div>y</p>z</div></div>", "<select><option>a<option>b</select>", "<!-- <p> --><script>'<p>'</script><P>Case</P>",
]


class Walk(HTMLParser):
    """A plain tree builder: nodes are [tag, parent, children or text]."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.root = {"tag": None, "up": None, "kids": []}
        self.at, self.nodes = self.root, []

    def handle_starttag(self, tag, attrs):
        ends, within = markup.ENDS.get(tag, ([], []))
        node, hit = self.at, None
        while node is not self.root and node["tag"] not in within:
            if node["tag"] in ends:
                hit = node
                break
            node = node["up"]
        if hit:
            # Boxes above stop the search; what ends takes the last of its kind with all inside.
            self.at = hit["up"]
        new = {"tag": tag, "up": self.at, "kids": [], "attrs": dict(attrs)}
        self.at["kids"].append(new)
        self.nodes.append(new)
        if tag not in markup.VOID:
            self.at = new

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        node = self.at
        while node is not self.root:
            if node["tag"] == tag:
                self.at = node["up"]
                return
            node = node["up"]
        self.at["kids"].append(None)  # parts texts, says nothing else

    def handle_data(self, data):
        self.at["kids"].append(data)

    def handle_entityref(self, name):
        self.handle_data(unescape(f"&{name};"))

    def handle_charref(self, name):
        self.handle_data(unescape(f"&#{name};"))

    def handle_comment(self, data):
        pass


def walked(html):
    html = re.sub(r"(?is)<!--.*?-->|<(script|style|noscript|svg|header|footer|nav)\b[^>]*>.*?</\1\s*>", " ", html)
    made = Walk()
    made.feed(html)
    made.close()
    return made


def said(node):
    """Texts are joined where entities cut them, and parted by blanks where tags do."""
    parts, run = [], ""
    for k in node["kids"]:
        if isinstance(k, str):
            run += k
        else:
            parts += [run, said(k) if k else ""]
            run = ""
    parts.append(run)
    return " ".join(x for x in (re.sub(r"\s+", " ", p).strip() for p in parts) if x)


def inside(node):
    for k in node["kids"]:
        if k and not isinstance(k, str):
            yield k
            yield from inside(k)


def test_elements_are_those_of_a_plain_walk(spark):
    """Tags, parents and texts of every page of the table and of pages that are not well formed."""
    pages = [r.html for r in spark.read.parquet(PAGES).collect()]
    table = spark.createDataFrame([(i, h) for i, h in enumerate(pages + [h for h in ODD if "< b" not in h])], "page_id long, html string")
    for r in site_pages.trees(table, "x", "script|style|noscript|svg|header|footer|nav").collect():
        tree = walked(r.html)
        number = {id(n): i for i, n in enumerate(tree.nodes)}
        want = [(n["tag"], number.get(id(n["up"]), -1), None if n["tag"] in ("html", "body", "head") else said(n)) for n in tree.nodes]
        assert [(e.tag, e.up, e.text) for e in r.tree] == want, r.html[:200]


HEADS = set(markup.HEADINGS)


def plain_title(node, date):
    cut = lambda t: re.sub(r"^[\s\-–—|:,]+|[\s\-–—|:,]+$", "", t.split(date)[0] if date in t else t)
    for tags in (HEADS, {"strong", "b"}, {"a"}):
        for k in inside(node):
            if k["tag"] in tags:
                t = cut(said(k))
                if len(t) >= 5 and not re.search(MORE_LINK, t) and not re.search(EMAIL, t):
                    return t[:140]
    t = re.sub(r"^[\s\-–—|:,]+|[\s\-–—|:,]+$", "", re.sub(WEEKDAY, " ", said(node).split(date)[0]))
    return t[:140] if len(t) >= 5 and not re.search(MORE_LINK, t) and not re.search(NAME_FAULTS[0][1], t) else None


def plain_blocks(html, mark):
    """The rule as a plain climb over a tree: the elements of all blocks."""
    tree = walked(html)
    heads = lambda n: sum(k["tag"] in HEADS for k in inside(n)) + (n["tag"] in HEADS)
    dates = lambda n: len(re.findall(mark, said(n)))
    linked = lambda n: any(k["tag"] == "img" or (k["tag"] == "a" and "href" in k["attrs"]) for k in [n, *inside(n)])
    top = ("html", "body", "head", None)
    found = []
    for node in tree.nodes:
        if node["tag"] in top:
            continue
        run = []
        for k in node["kids"]:
            run = run[:-1] + [run[-1] + k] if isinstance(k, str) and run and isinstance(run[-1], str) else [*run, k]
        for k in run:
            if isinstance(k, str) and re.search(mark, re.sub(r"\s+", " ", k).strip()):
                date, el = re.search(mark, re.sub(r"\s+", " ", k).strip())[0], node
                for _ in range(6):
                    if el["tag"] in ("article", "li", "tr") or plain_title(el, date) or el["up"]["tag"] in top:
                        break
                    if (heads(el) and heads(el["up"]) > heads(el)) or (linked(el) and dates(el["up"]) > dates(el)):
                        break
                    el = el["up"]
                for _ in range(3):
                    up = el["up"]
                    if up["tag"] in top or len(said(up)) > 800 or dates(up) > dates(el) or heads(up) > max(1, heads(el)):
                        break
                    el = up
                if len(said(el)) <= 1500:
                    found.append(el)
    number = {id(n): i for i, n in enumerate(tree.nodes)}
    ups = lambda n: {id(n["up"])} | ups(n["up"]) if n["up"] is not None else set()
    ids = {id(f) for f in found}
    return sorted({number[id(f)]: said(f) for f in found if not ups(f) & ids}.items())


CARDS = """<html><body><h1>Our Events</h1><div class=grid>
<div class=card><h3>Otter Harvest Cup</h3><p>November 7-8, 2026</p><p>Elm Falls, NJ</p><a href="/events/otter">Learn more</a></div>
<div class=card><h3>Pine Classic</h3><p>Nov 14, 2026</p><p>Oak Park</p></div>
<div class=card><img src="/img/Event Logos/Fall Brawl/a.png"><p>December 5, 2026</p><a href="/events/brawl">Register</a></div>
<article><p><b>Granite Shootout</b> October 3 - 4, 2026 for boys</p></article></div>
<ul><li>Winter Slam, January 9, 2027</li><li>Ice Box Classic: January 16, 2027</li></ul>
<table><tr><td>Spring Fling Cup<td>March 6, 2027<tr><td>Tryouts<td>March 7, 2027</table>
<p>%s April 1, 2027</p></body></html>""" % ("words " * 400)


@pytest.mark.parametrize("mark", [r"(?i)\b(?:Jan|Mar|Oct|Nov|Dec|November|December|October|January|March|April)\s+\d+", r"\bthat\b", r"(?i)\bth\w+\b"])
def test_blocks_are_those_of_a_plain_climb(spark, mark):
    """On every page of the table, on cards, lists and tables, and on pages that are not well formed."""
    pages = [(r.page_id, r.html) for r in spark.read.parquet(PAGES).collect()] + [(10_000 + i, h) for i, h in enumerate([*ODD, CARDS]) if "< b" not in h]
    got = {}
    for r in site_pages.page_blocks(spark.createDataFrame(pages, "page_id long, html string"), mark).collect():
        got.setdefault(r.page_id, []).append((r.block, r.said))
    want = {i: plain_blocks(h, mark) for i, h in pages}
    assert {i: sorted(b) for i, b in got.items()} == {i: b for i, b in want.items() if b}
    assert sum(map(len, got.values())) > 3


def test_events_of_cards_lists_and_tables(spark):
    rows = [(1, "http://site.test/events", CARDS), (2, "http://site.test/none", None), (3, "http://site.test/empty", "")]
    got = {r.name: r for r in site_pages.event_blocks(spark.createDataFrame(rows, "page_id long, url string, html string"), "2026-09-01").collect()}
    assert {n: (r.start, r.end) for n, r in got.items()} == {
        "Otter Harvest Cup": (D(2026, 11, 7), D(2026, 11, 8)),
        "Pine Classic": (D(2026, 11, 14), D(2026, 11, 14)),
        "Fall Brawl": (D(2026, 12, 5), D(2026, 12, 5)),
        "Granite Shootout": (D(2026, 10, 3), D(2026, 10, 4)),
        "Winter Slam": (D(2027, 1, 9), D(2027, 1, 9)),
        "Ice Box Classic": (D(2027, 1, 16), D(2027, 1, 16)),
        "Spring Fling Cup": (D(2027, 3, 6), D(2027, 3, 6)),
    }
    assert got["Otter Harvest Cup"].detail == "http://site.test/events/otter" and got["Pine Classic"].detail is None
    assert [n for n, r in got.items() if r.unnamed] == ["Fall Brawl"]


def test_names_are_cleaned(spark):
    clean = lambda n: spark.range(1).select(site_pages.clean_name(F.lit(n)).alias("x")).first().x
    assert [clean(n) for n in ("NJ FALL CLASSIC", "Laxtoberfest Oct. 25th, 2026", "2026 Boys Fall Prix", "Hackfest 2026 Information", "Tournament Witches Brew Fest", "Battle OF the Bay", "CUP OF THE BAY", "Otter (", "2026")] == [
        "NJ Fall Classic", "Laxtoberfest", "Boys Fall Prix", "Hackfest 2026", "Witches Brew Fest", "Battle OF the Bay", "Cup of the Bay", "Otter", "2026",
    ]


def test_links_become_whole(spark):
    whole = lambda h: spark.range(1).select(site_pages.absolute(F.lit(h), F.lit("https://a.test/x/y?q=1#z")).alias("x")).first().x
    assert [whole(h) for h in ("http://b.test/#c", "//c.test/d", "/e", "f", "./g", "?h=1", "")] == ["http://b.test/", "https://c.test/d", "https://a.test/e", "https://a.test/x/f", "https://a.test/x/g", "https://a.test/x/y?h=1", "https://a.test/x/"]


def test_trees_are_made_once(spark):
    pages = spark.createDataFrame([(1, "<body><div><h2>Harvest Cup</h2><p>June 6, 2026</p></div></body>")], "page_id long, html string")
    blocks = site_pages.page_blocks(pages)
    # What picks blocks reads finished trees: nothing of it goes back to the page.
    assert "html#" not in blocks._jdf.queryExecution().optimizedPlan().toString()
    assert [r.title for r in blocks.collect()] == ["Harvest Cup"]
