"""Links, contacts and text of raw web pages, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gatherline import vocab
from gatherline.functions.names import squeeze
from gatherline.functions.values import first_case, let, text

FREE_MAIL = ["gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "aol.com", "icloud.com", "comcast.net", "verizon.net", "msn.com", "me.com"]
SKIP_LINK = r"(?i)(facebook|instagram|twitter|x\.com|tiktok|youtube|linkedin|maps\.google|goo\.gl|apple\.com|mailto:|tel:|\.pdf$|\.jpe?g$|\.png$|/cart|/login|/account|/wp-admin|/privacy|/terms|/shop|/store|/product|/feed|#)"
#: tag stripping in order: whole elements without text, then tags, then entities
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#0?39;|&apos;|&rsquo;|&#8217;", "'"), ("&ndash;|&#8211;", "–"), ("&mdash;|&#8212;", "—"), ("&amp;", "&")]


def page_text(html: Column) -> Column:
    """The readable text of a page on one line: scripts, styles, comments and tags dropped, common entities decoded."""
    out = F.regexp_replace(text(html), r"(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>|<!--.*?-->", " ")
    return squeeze(unescape(F.regexp_replace(out, r"(?s)<[^>]*>", " ")))


def unescape(x: Column) -> Column:
    for entity, plain in ENTITIES:
        x = F.regexp_replace(x, entity, plain)
    return x


def page_lines(html: Column) -> Column:
    """array<string> of a page's lines of text: block tags and line breaks end a line, empty lines go."""
    out = F.regexp_replace(text(html), r"(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>|<!--.*?-->", " ")
    out = F.regexp_replace(out, r"(?i)<(?:br|/p|/div|/li|/h[1-6]|/tr|/td|/ul|/article|/nav|/title)\b[^>]*>", "\n")
    lines = F.split(unescape(F.regexp_replace(out, r"(?s)<[^>]*>", " ")), "\n")
    return F.filter(F.transform(lines, squeeze), lambda x: x != "")


def links(html: Column) -> Column:
    """array<struct<href, label>> of a page's anchors in order; scripts and comments do not count."""
    html = F.regexp_replace(text(html), r"(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>|<!--.*?-->", " ")
    pattern = r"(?is)<a\b[^>]*?href\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"
    href, label = (F.regexp_extract_all(html, F.lit(pattern), F.lit(g)) for g in (1, 2))
    return F.transform(F.arrays_zip(href.alias("h"), label.alias("l")), lambda r: F.struct(unescape(r["h"]).alias("href"), squeeze(unescape(F.regexp_replace(r["l"], r"(?s)<[^>]*>", " "))).alias("label")))


def page_title(html: Column) -> Column:
    return F.nullif(squeeze(unescape(F.regexp_extract(text(html), r"(?is)<title[^>]*>(.*?)</title>", 1))), F.lit(""))


def host(url: Column) -> Column:
    """Host in lower case without 'www.'."""
    return F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), r"^www\.", "")


def registered_domain(url: Column) -> Column:
    """The last two parts of the host (three under two-letter second levels such as co.uk)."""
    p = F.split(host(url), r"\.")
    long = F.when((F.length(F.element_at(p, -1)) == 2) & (F.size(p) >= 3) & (F.length(F.get(p, F.size(p) - 2)) <= 3), 3).otherwise(2)
    return F.array_join(F.slice(p, F.greatest(F.size(p) - long + 1, F.lit(1)), long), ".")


def is_platform(url: Column) -> Column:
    """Whether a link leads to a registration platform."""
    return text(url).rlike(r"(?i)(tourneymachine|leagueapps|sportsengine|sportngin|exposureevents|gotsport|playbook365|eventbrite|teamsnap|laxnumbers)\.")


def link_kind(href: Column, label: Column) -> Column:
    """skip, query, event or page: how promising a link is for finding events."""
    words = F.concat_ws(" ", F.lower(text(href)), F.lower(text(label)))
    return F.when(text(href).rlike(SKIP_LINK) | (text(href) == ""), "skip").when(words.rlike(r"tournament|event|schedule|showcase|classic|calendar"), "event").when(text(href).contains("?"), "query").otherwise("page")


def document_kind(name: Column) -> Column:
    """Kind of a linked document by its file name: field_map, rules, logo, image or document."""
    ext = F.lower(F.regexp_extract(name, r"\.(\w+)$", 1))
    image = ext.isin("png", "jpg", "jpeg", "gif")
    return first_case(name, [(r"(?i)map|layout|site|field[- ]?plan|parking|venue|complex|directions", "field_map"), (r"(?i)rule|regulation|policy|waiver|code of conduct", "rules")], F.when(image & name.rlike("(?i)140x140|logo|icon"), "logo").when(image, "image").otherwise("document"))


def emails(x: Column) -> Column:
    """Addresses of a page or text in order, lower-case, each once; mailto links first, image names and placeholders dropped."""
    found = F.concat(F.regexp_extract_all(text(x), F.lit("(?i)mailto:([^\"'?>\\s]+)"), F.lit(1)), F.regexp_extract_all(text(x), F.lit(f"({vocab.EMAIL})"), F.lit(1)))
    bare = F.transform(found, lambda e: F.lower(F.regexp_replace(F.trim(e), "^[.,;:]+|[.,;:]+$", "")))
    return F.array_distinct(F.filter(bare, lambda e: e.rlike(f"^{vocab.EMAIL}$") & ~e.rlike(vocab.JUNK_EMAIL)))


def phones(x: Column) -> Column:
    """North American numbers as '(201) 555-0123', in order, each once."""
    pattern = r"(?<!\d)(?:\+?1[\s.\-]?)?\(?([2-9]\d{2})\)?[\s.\-]?([2-9]\d{2})[\s.\-]?(\d{4})(?!\d)"
    a, b, c = (F.regexp_extract_all(F.regexp_replace(text(x), "(?i)tel:", " "), F.lit(pattern), F.lit(g)) for g in (1, 2, 3))
    return F.array_distinct(F.transform(F.arrays_zip(a.alias("a"), b.alias("b"), c.alias("c")), lambda r: F.concat(F.lit("("), r["a"], F.lit(") "), r["b"], F.lit("-"), r["c"])))


def spots(x: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of all matches: 0-based code points, end exclusive.

    A match is located by the text between it and the match before, so repeated values keep their own places. The text is
    worked out once; ``pattern`` never matches nothing and names no group of its own.
    """
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def walk(hits: Column, gaps: Column) -> Column:
        return F.aggregate(
            F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("gap"), hits.alias("hit")),
            F.struct(F.lit(0).alias("at"), empty.alias("out")),
            lambda s, r: let(
                F.struct((s["at"] + F.length(r["gap"])).alias("start"), F.length(r["hit"]).alias("n")),
                lambda m: F.struct((m["start"] + m["n"]).alias("at"), F.concat(s["out"], F.array(F.struct(m["start"].alias("start"), (m["start"] + m["n"]).alias("end"), r["hit"].alias("value")))).alias("out")),
            ),
        )["out"]

    def read(said: Column) -> Column:
        hits = F.regexp_extract_all(said, F.lit(f"({pattern})"), F.lit(1))
        return let(hits, lambda h: F.when(F.size(h) == 0, empty).otherwise(walk(h, F.split(said, pattern, -1))))

    return let(text(x), read)


#: vocab.EMAIL, tried only where a run of its characters begins or the last match ended: from within a run it finds no more.
_EMAIL = vocab.EMAIL.replace("[A-Za-z0-9._%+\\-]+@", r"(?:\G|(?<![A-Za-z0-9._%+\-]))[A-Za-z0-9._%+\-]++@")


def vendor_email(x: Column) -> Column:
    """The address nearest to vendor or sponsor wording, at most 400 characters away; the first of equals."""
    return let(text(x), _vendor_email)


def _vendor_email(x: Column) -> Column:
    words = F.transform(spots(x, vocab.VENDOR_WORDS.replace("(?i)", "(?i:") + ")"), lambda s: s["start"])
    found = let(words, lambda at: F.transform(spots(x, _EMAIL), lambda s: F.struct(F.array_min(F.transform(at, lambda w: F.abs(w - s["start"]))).alias("far"), s["start"].alias("start"), F.lower(s["value"]).alias("value"))))
    return F.try_element_at(F.array_sort(F.filter(found, lambda s: s["far"] <= 400)), F.lit(1))["value"]


def contact_roles(x: Column) -> Column:
    """array<struct<email, role>>: one per address, vendor before director before organizer by the words left of it."""
    return let(text(x), _contact_roles)


def _contact_roles(x: Column) -> Column:
    left = lambda s, n: F.lower(F.substring(text(x), F.greatest(s["start"] - n + 1, F.lit(1)), F.least(s["start"], F.lit(n))))
    made = F.transform(
        spots(x, _EMAIL),
        lambda s, i: F.struct(
            F.when(left(s, 140).rlike(r"vendor|sponsor|exhibitor"), 0).when(left(s, 110).rlike(r"director|commissioner|founder"), 1).otherwise(2).alias("rank"),
            i.alias("i"),
            F.lower(F.regexp_replace(s["value"], "^[.,;:]+|[.,;:]+$", "")).alias("email"),
        ),
    )
    made = F.array_sort(F.filter(made, lambda m: ~m["email"].rlike(vocab.JUNK_EMAIL)))
    first = let(made, lambda all_: F.filter(all_, lambda m, k: ~F.exists(F.slice(all_, 1, k), lambda e: e["email"] == m["email"])))
    return F.transform(first, lambda m: F.struct(m["email"].alias("email"), F.element_at(F.array(*map(F.lit, ("vendor", "director", "organizer"))), m["rank"] + 1).alias("role")))


def json_ld(html: Column) -> Column:
    """array<string> of a page's embedded JSON-LD documents."""
    return F.regexp_extract_all(text(html), F.lit(r"(?is)<script[^>]+application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))
