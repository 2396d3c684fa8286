"""Events on the pages of organisers' sites: blocks of listing pages, events' own pages, and the walk over a site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatherline import vocab
from gatherline.functions.dates import find_ranges
from gatherline.functions.markup import HEADINGS, attribute, elements, tag_of, texts, tokens
from gatherline.functions.names import squeeze
from gatherline.functions.pages import SKIP_LINK, emails, is_platform, page_text, phones, registered_domain, vendor_email
from gatherline.functions.values import let, text
from gatherline.operators.gate import in_horizon, name_verdict
from gatherline.operators.report import crawl_words
from gatherline.plans.scratch import Scratch

#: Levels that a block climbs until it is named, and widens beyond.
CLIMB, WIDEN = 6, 3
#: Characters that a widened block, and any block, holds at most.
CARD, LONGEST = 800, 1500
_BOLD, _LINK = ["strong", "b"], ["a"]
_TREE = "tag text, up, text, heads, dates, linked"


def clean_name(name: Column) -> Column:
    """An event's name without dates, years at its ends and lead-ins; shouted words are calmed."""
    calm = lambda w, i: F.when((i > 0) & F.lower(w).isin(vocab.SMALL_WORDS), F.lower(w)).when(w.rlike("^[A-Za-z]{1,2}$"), w).otherwise(F.initcap(F.lower(w)))
    shouted = (name == F.upper(name)) & name.rlike("[A-Z]")
    out = F.regexp_replace(F.when(shouted, F.array_join(F.transform(F.split(name, " "), calm), " ")).otherwise(name), vocab.DATE_TEXT, " ")
    for pattern in vocab.NAME_TRIMS:
        out = squeeze(F.regexp_replace(out, pattern, " "))
    return let(F.regexp_replace(out, r"^[\s\-–—|:,·]+|[\s\-–—|:,·]+$", ""), lambda n: F.when(n != "", n).otherwise(squeeze(name)))


def absolute(href: Column, base: Column) -> Column:
    """A link as a whole address, without its fragment; ``base`` is the page's own address."""
    root = F.regexp_extract(base, r"^(https?://[^/?#]+)", 1)
    folder = F.regexp_extract(base, r"^(https?://[^/?#]+(?:/[^?#]*/|/)?)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    full = F.when(href.rlike("(?i)^https?://"), href).when(href.startswith("//"), F.concat(F.regexp_extract(base, "^(https?:)", 1), href)).when(href.startswith("/"), F.concat(root, href)).when(href.startswith("?"), F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), href)).otherwise(F.concat(folder, F.regexp_replace(href, r"^\./", "")))
    return F.regexp_replace(full, "#.*$", "")


def page_key(url: Column) -> Column:
    """What makes two addresses one page: no fragment, no slash at the end."""
    return F.regexp_replace(F.regexp_replace(F.lower(url), "#.*$", ""), "/+$", "")


def trees(pages: DataFrame, mark: str, without: str) -> DataFrame:
    """``pages`` with toks (tokens), said (their texts) and tree: of every element its tag, parent, span, text, headings, marks and whether it holds a picture or a link."""
    whole = pages.withColumn("toks", tokens(F.col("html"), without)).withColumn("_tags", F.transform("toks", tag_of)).withColumn("said", texts(F.col("toks"), F.col("_tags"))).withColumn("_els", elements(F.col("_tags")))
    inside = lambda c, e: F.slice(c, e["from"] + 1, e["to"] - e["from"])
    hit = lambda e: e["tag"].isin("html", "body", "head")
    linked = F.zip_with("toks", "_tags", lambda x, t: (t == "img") | ((t == "a") & x.rlike(r"(?i)\shref\s*=")))

    def made(e: Column) -> Column:
        words = F.when(~hit(e), F.array_join(F.filter(inside("said", e), lambda x: x != ""), " "))
        return let(
            words,
            lambda w: F.struct(
                e["tag"].alias("tag"),
                e["up"].alias("up"),
                e["from"].alias("from"),
                e["to"].alias("to"),
                w.alias("text"),
                F.size(F.filter(inside("_tags", e), lambda t: t.isin(HEADINGS))).alias("heads"),
                F.size(F.regexp_extract_all(w, F.lit(mark), F.lit(0))).alias("dates"),
                F.exists(inside("_linked", e), lambda x: x).alias("linked"),
            ),
        )

    return whole.withColumn("_linked", linked).withColumn("tree", F.transform("_els", made)).drop("_tags", "_els", "_linked")


def _upto(t: Column, date: Column) -> Column:
    return F.when(t.contains(date), F.substring(t, F.lit(1), F.position(date, t) - 1)).otherwise(t)


def _cut(t: Column, date: Column) -> Column:
    return F.regexp_replace(_upto(t, date), r"^[\s\-–—|:,]+|[\s\-–—|:,]+$", "")


def _good(t: Column) -> Column:
    return (F.length(t) >= 5) & ~t.rlike(vocab.MORE_LINK) & ~t.rlike(rf"^(?:{vocab.DATE_TEXT})$") & ~t.rlike(vocab.EMAIL)


def _before(e: Column, date: Column) -> Column:
    """What stands before the date in an element's text, if it may be a name."""
    words = F.regexp_replace(F.regexp_replace(_upto(e["text"], date), vocab.WEEKDAY, " "), r"^[\s\-–—|:,]+|[\s\-–—|:,]+$", "")
    return let(words, lambda t: F.when((F.length(t) >= 5) & ~t.rlike(vocab.MORE_LINK) & ~t.rlike(vocab.NAME_FAULTS[0][1]), t))


def _within(x: Column, e: Column) -> Column:
    return (x["from"] > e["from"]) & (x["to"] <= e["to"])


def _title(tree: Column, e: Column, date: Column) -> Column:
    """The name that an element gives a date: its headings, bold texts or links, else what stands before the date; or null."""
    own = F.filter(tree, lambda x: _within(x, e))
    first = lambda inner, tags: F.try_element_at(F.filter(F.transform(F.filter(inner, lambda x: x["tag"].isin(tags)), lambda x: _cut(x["text"], date)), _good), F.lit(1))
    return F.substring(let(own, lambda inner: F.coalesce(first(inner, HEADINGS), first(inner, _BOLD), first(inner, _LINK), _before(e, date))), 1, 140)


def _titled(tree: Column, e: Column, date: Column) -> Column:
    """Whether _title() is there: the first text that may be a name will do."""
    named = F.exists(tree, lambda x: _within(x, e) & x["tag"].isin(HEADINGS + _BOLD + _LINK) & F.exists(F.array(_cut(x["text"], date)), _good))
    return F.coalesce(named, F.lit(False)) | _before(e, date).isNotNull()


def page_blocks(pages: DataFrame, mark: str = vocab.DATE_TEXT, without: str = "script|style|noscript|svg|header|footer|nav") -> DataFrame:
    """The smallest named block around every text of a page that holds a ``mark`` (a date): one row a block.

    From the text's element a block climbs until it gives a name, never into a box that holds another heading's event
    or, once it has a picture or a link, another date; then it widens to the whole card while that holds no other event.
    Blocks within a larger one go. Returns page_id, block (place of its element), tag, mark, title, said, tokens (its
    tags and texts). A page is one row, and nothing is grouped; null and empty pages have no blocks.
    """
    # The table keeps the tree from being made again in every expression that names it.
    plain = Scratch(pages.sparkSession, "trees").table(trees(pages.select("page_id", "html"), mark, without).drop("html"), "trees")
    tree = F.col("tree")
    bare = lambda e: e["tag"].isin("body", "html", "head")
    at = lambda i: F.get(tree, i)

    def climbed(e: Column, date: Column) -> Column:
        def step(s: Column, _: Column) -> Column:
            def seen(el: Column) -> Column:
                def above(up: Column) -> Column:
                    # Reading texts for a name is dear and comes last.
                    ends = el["tag"].isin("article", "li", "tr") | (el["up"] < 0) | bare(up) | ((el["heads"] > 0) & (up["heads"] > el["heads"])) | (el["linked"] & (up["dates"] > el["dates"])) | _titled(tree, el, date)
                    return F.when(F.coalesce(ends, F.lit(True)), F.struct(s["e"].alias("e"), F.lit(True).alias("done"))).otherwise(F.struct(el["up"].alias("e"), F.lit(False).alias("done")))

                return let(at(F.greatest(el["up"], F.lit(0))), above)

            return F.when(s["done"], s).otherwise(let(at(s["e"]), seen))

        return F.aggregate(F.sequence(F.lit(1), F.lit(CLIMB)), F.struct(e.alias("e"), F.lit(False).alias("done")), step)["e"]

    def widened(e: Column) -> Column:
        def step(s: Column, _: Column) -> Column:
            def seen(el: Column) -> Column:
                def above(up: Column) -> Column:
                    ends = (el["up"] < 0) | bare(up) | (F.length(up["text"]) > CARD) | (up["dates"] > el["dates"]) | (up["heads"] > F.greatest(F.lit(1), el["heads"]))
                    return F.when(F.coalesce(ends, F.lit(True)), F.struct(s["e"].alias("e"), F.lit(True).alias("done"))).otherwise(F.struct(el["up"].alias("e"), F.lit(False).alias("done")))

                return let(at(F.greatest(el["up"], F.lit(0))), above)

            return F.when(s["done"], s).otherwise(let(at(s["e"]), seen))

        return F.aggregate(F.sequence(F.lit(1), F.lit(WIDEN)), F.struct(e.alias("e"), F.lit(False).alias("done")), step)["e"]

    places = F.filter(F.transform("said", lambda x, i: F.when(x.rlike(mark), i)), lambda i: i.isNotNull())
    innermost = lambda i: F.array_max(F.transform(tree, lambda x, k: F.when((x["from"] < i) & (x["to"] > i), k)))
    starts = F.filter(F.transform(places, lambda i: F.struct(innermost(i).alias("e"), F.regexp_extract(F.get("said", i), mark, 0).alias("date"))), lambda s: s["e"].isNotNull() & ~bare(F.get(tree, s["e"])))
    # Texts of one element with one mark climb alike.
    chosen = plain.withColumn("_starts", F.array_distinct(starts)).withColumn("_blocks", F.array_distinct(F.transform("_starts", lambda s: widened(climbed(s["e"], s["date"])))))
    short = F.filter("_blocks", lambda b: F.length(at(b)["text"]) <= LONGEST)
    chosen = chosen.withColumn("_blocks", short)
    outer = F.filter("_blocks", lambda b: ~F.exists("_blocks", lambda o: (at(o)["from"] < at(b)["from"]) & (at(o)["to"] >= at(b)["to"])))
    rows = chosen.select("page_id", "tree", "toks", F.explode_outer(F.array_sort(outer)).alias("block")).where("block IS NOT NULL").withColumn("_e", at(F.col("block")))
    rows = rows.withColumn("mark", F.regexp_extract(F.col("_e.text"), mark, 0)).where("mark <> ''")
    title = _title(tree, F.col("_e"), F.col("mark"))
    return rows.select("page_id", "block", F.col("_e.tag").alias("tag"), "mark", title.alias("title"), F.col("_e.text").alias("said"), F.slice("toks", F.col("_e.from") + 1, F.col("_e.to") - F.col("_e.from")).alias("tokens"))


def card_name(toks: Column) -> Column:
    """A name for a block that has it in its picture only: the picture's alt or title, else its folder, else the last part of a link's path."""
    images = F.filter(toks, lambda t: t.rlike("(?i)^<img[ /]"))
    spoken = F.filter(F.flatten(F.transform(images, lambda t: F.array(attribute(t, "alt"), attribute(t, "title")))), lambda v: (F.length(v) >= 4) & ~v.rlike(r"(?i)\b(logo|image|icon|photo|banner)\b"))
    path = lambda u: F.filter(F.split(F.regexp_replace(F.regexp_replace(u, r"^https?://[^/]*", ""), r"[?#].*$", ""), "/"), lambda p: p != "")
    folders = F.flatten(F.transform(images, lambda t: let(path(text(attribute(t, "src"))), lambda p: F.reverse(F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0)))))))
    named = F.filter(F.transform(folders, lambda p: F.regexp_replace(F.regexp_replace(p, "%20", " "), "[_-]", " ")), lambda p: p.rlike("[A-Za-z]{3}") & ~p.rlike(vocab.PLAIN_FOLDER))
    hrefs = F.filter(F.transform(F.filter(toks, lambda t: t.rlike(r"(?i)^<a\s")), lambda t: attribute(t, "href")), lambda h: h.isNotNull() & ~h.rlike(SKIP_LINK) & ~h.rlike(r"(?i)share|\.(php|html?|aspx?)$"))
    slug = let(F.try_element_at(path(F.try_element_at(hrefs, F.lit(1))), F.lit(-1)), lambda p: F.when(p.rlike("[A-Za-z]{4}"), F.initcap(F.regexp_replace(p, "[_-]", " "))))
    return F.coalesce(F.try_element_at(spoken, F.lit(1)), F.try_element_at(named, F.lit(1)), slug)


def event_blocks(pages: DataFrame, as_of: str) -> DataFrame:
    """Events in the blocks of listing pages: page_id, block, name, start, end, detail (the block's own link), said, unnamed (its name is from a picture or a link)."""
    blocks = page_blocks(pages).join(pages.select("page_id", "url"), "page_id")
    dated = blocks.withColumn("_d", F.get(find_ranges(F.col("said"), as_of), F.lit(0))).where("_d IS NOT NULL")
    named = dated.withColumn("_t", clean_name(F.col("title"))).withColumn("name", F.coalesce(F.nullif("_t", F.lit("")), clean_name(card_name(F.col("tokens")))))
    wordy = F.size(F.split("name", " ")) > 10
    fault = name_verdict(F.col("name"))
    kept = named.where(F.col("name").isNotNull() & ~wordy & (fault.isNull() | ~fault.isin("junk", "heading", "not_event")))
    hrefs = F.transform(F.filter("tokens", lambda t: t.rlike(r"(?i)^<a\s")), lambda t: absolute(text(attribute(t, "href")), F.col("url")))
    own = F.filter(hrefs, lambda u: u.rlike("^https?://") & ~u.rlike(SKIP_LINK) & (page_key(u) != page_key(F.col("url"))) & ((registered_domain(u) == registered_domain(F.col("url"))) | is_platform(u)))
    return kept.select("page_id", "block", "name", F.col("_d.start").alias("start"), F.col("_d.end").alias("end"), F.try_element_at(own, F.lit(1)).alias("detail"), "said", F.col("title").isNull().alias("unnamed"))
