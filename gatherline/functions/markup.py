"""The element tree of a page, as column expressions.

A page is its row of tokens, tags and texts. One fold over the tags keeps the stack of open elements: a tag that opens
takes the top of the stack for its parent, and ends what its kind cannot stand in; a tag that closes ends everything down
to its own. So every element knows its parent and the tokens it spans, and what it holds is a slice of the page's tokens.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gatherline.functions.names import squeeze
from gatherline.functions.pages import unescape
from gatherline.functions.values import let, text

#: Elements whose content is no text of a page.
UNREAD = "script|style|noscript|svg"
#: Elements without content.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
HEADINGS = ["h1", "h2", "h3", "h4", "h5"]
#: What an opening tag ends, looked for no further up than the second list.
_BLOCKS = "p div ul ol table article section main aside header footer nav form dl pre blockquote address figure hr h1 h2 h3 h4 h5 h6".split()
_BOXES = "div article section main aside td th li table ul ol form blockquote body".split()
ENDS = {t: (["p"], _BOXES) for t in _BLOCKS} | {
    "li": (["li", "p"], ["ul", "ol"]),
    "dt": (["dt", "dd", "p"], ["dl"]),
    "dd": (["dt", "dd", "p"], ["dl"]),
    "tr": (["tr"], ["table"]),
    "td": (["td", "th"], ["tr", "table"]),
    "th": (["td", "th"], ["tr", "table"]),
    "option": (["option"], ["select"]),
}

#: Parents and ends are gathered in leaves of so many, so that a step copies a leaf and not all before it.
_LEAF = 128
_STATE = "struct<n:int,open:array<struct<e:int,tag:string>>,ups:array<int>,ends:array<struct<e:int,to:int>>,all_ups:array<array<int>>,all_ends:array<array<struct<e:int,to:int>>>>"


def tokens(html: Column, without: str = UNREAD) -> Column:
    """array<string>: tags and texts of a page in order, comments and the elements ``without`` left out."""
    bare = F.regexp_replace(text(html), rf"(?is)<!--.*?-->|<({without})\b[^>]*>.*?</\1\s*>", " ")
    return F.regexp_extract_all(bare, F.lit(r"(?s)<[^>]*>|[^<]+|<"), F.lit(0))


def tag_of(token: Column) -> Column:
    """The name of an opening tag, with a slash before that of a closing one, empty for text."""
    return F.lower(F.concat(F.regexp_extract(token, "^<(/?)[a-zA-Z]", 1), F.regexp_extract(token, "^</?([a-zA-Z][a-zA-Z0-9]*)", 1)))


def elements(tags: Column) -> Column:
    """array<struct<tag, up, from, to>> of the elements, in order of their opening tags.

    tags: tag_of() of every token. up is the parent's place in the array (-1 for none); the element spans the tokens
    ``from`` (its tag) up to before ``to``. What is not closed ends with the page; a closing tag without an open one
    says nothing.
    """
    lists = lambda k: F.create_map(*[x for t, v in ENDS.items() for x in (F.lit(t), F.array(*map(F.lit, v[k])))])
    none = F.array().cast("array<string>")
    marks = F.filter(F.transform(tags, lambda t, i: F.struct(i.alias("i"), F.ltrim(t, F.lit("/")).alias("tag"), t.startswith("/").alias("shut"))), lambda m: m["tag"] != "")
    known = F.transform(marks, lambda m: F.struct(m["i"].alias("i"), m["tag"].alias("tag"), m["shut"].alias("shut"), F.coalesce(F.element_at(lists(0), m["tag"]), none).alias("ends"), F.coalesce(F.element_at(lists(1), m["tag"]), none).alias("within")))
    last = lambda stack, hit: F.coalesce(F.array_max(F.transform(stack, lambda x, k: F.when(hit(x), k + 1).otherwise(0))), F.lit(0))

    def step(s: Column, m: Column) -> Column:
        stack = s["open"]
        shut = last(stack, lambda x: x["tag"] == m["tag"])
        over = last(stack, lambda x: F.array_contains(m["ends"], x["tag"]))
        box = last(stack, lambda x: F.array_contains(m["within"], x["tag"]))
        keep = F.when(m["shut"], F.when(shut > 0, shut - 1).otherwise(F.size(stack))).otherwise(F.when((F.size(m["ends"]) > 0) & (over > box), over - 1).otherwise(F.size(stack)))

        def pushed(n: Column) -> Column:
            kept = F.slice(stack, 1, n)
            gone = F.transform(F.slice(stack, n + 1, F.size(stack) - n), lambda x: F.struct(x["e"].alias("e"), m["i"].alias("to")))
            up = F.coalesce(F.try_element_at(kept, F.lit(-1))["e"], F.lit(-1))
            void = m["tag"].isin(VOID)
            full = lambda c: F.size(s[c]) >= _LEAF
            ups, ends = (F.when(full(c), F.slice(s[c], 1, 0)).otherwise(s[c]) for c in ("ups", "ends"))
            itself = F.array(F.struct(s["n"].alias("e"), (m["i"] + 1).alias("to")))
            return F.struct(
                (s["n"] + F.when(m["shut"], 0).otherwise(1)).alias("n"),
                F.when(m["shut"] | void, kept).otherwise(F.concat(kept, F.array(F.struct(s["n"].alias("e"), m["tag"].alias("tag"))))).alias("open"),
                F.when(m["shut"], ups).otherwise(F.concat(ups, F.array(up))).alias("ups"),
                F.when(~m["shut"] & void, F.concat(ends, gone, itself)).otherwise(F.concat(ends, gone)).alias("ends"),
                F.when(full("ups"), F.concat(s["all_ups"], F.array(s["ups"]))).otherwise(s["all_ups"]).alias("all_ups"),
                F.when(full("ends"), F.concat(s["all_ends"], F.array(s["ends"]))).otherwise(s["all_ends"]).alias("all_ends"),
            )

        return let(keep, pushed)

    empty = F.struct(F.lit(0), *[F.array()] * 5).cast(_STATE)
    folded = F.aggregate(known, empty, step)
    opened = F.filter(known, lambda m: ~m["shut"])

    def made(s: Column) -> Column:
        rest = F.transform(s["open"], lambda x: F.struct(x["e"].alias("e"), F.size(tags).alias("to")))
        to = F.array_sort(F.concat(F.flatten(s["all_ends"]), s["ends"], rest))
        ups = F.concat(F.flatten(s["all_ups"]), s["ups"])
        return F.transform(F.arrays_zip(opened.alias("m"), ups.alias("up"), to.alias("x")), lambda r: F.struct(r["m"]["tag"].alias("tag"), r["up"].alias("up"), r["m"]["i"].alias("from"), r["x"]["to"].alias("to")))

    return let(folded, made)


def texts(toks: Column, tags: Column) -> Column:
    """array<string>: the readable text of every token, empty for tags."""
    return F.zip_with(toks, tags, lambda x, t: F.when(t == "", squeeze(unescape(x))).otherwise(""))


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a tag, entities decoded, or null."""
    got = F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", 0)
    return F.when(got != "", F.trim(unescape(F.regexp_replace(F.regexp_replace(got, r"(?is)^\s\w+\s*=\s*", ""), "^[\"']|[\"']$", ""))))
