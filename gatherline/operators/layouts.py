"""Listing pages of known layouts, read by rules that are data.

A layout is a row of LAYOUTS: which line is an event's anchor, how many lines its date takes, where the name stands, and
which lines around it are a place, an age range, furniture, or the end of the block or of the list. One plan reads pages
of all layouts: lines of a page are one array, an anchor's block is a slice of it, and the patterns are columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatherline import vocab
from gatherline.functions.dates import find_ranges, next_season
from gatherline.functions.names import gender_class, squeeze
from gatherline.functions.values import let
from gatherline.operators.site_pages import clean_name

_DAY = vocab.DATE_TEXT
_NEVER = r"(?!)"
_TOWN = r"^([A-Z][A-Za-z .'’-]+,\s*[A-Z]{2})(?:\s+\d{5})?$"
_FURNITURE = r"(?i)^(?:learn more|view event.*|find out.*|register.*|details|more info|event details|tournaments?|showcases?|boys|girls|coed|boys only|girls only|location:?|classes:?.*)$"
_AGES = r"(?i)((?:\bU\d{1,2}\b|\b20\d\d\b)(?:\s*[-–/,&]\s*(?:U\d{1,2}|20\d\d|\d\d)\b)*)"

#: layout: (organizer, anchor, date group, name group, place group, date lines, name from, lines ahead, place, stop, last, upcoming)
#: Groups of the anchor are 0 for the whole line, -1 for none; names come from the anchor, the line before it, the first
#: line after it or all up to the place, or the page's first line. upcoming: the list shows no past events, so that a past
#: date has a mistyped year.
LAYOUTS = {
    "mlt": ("MLT", rf"^(?:{_DAY})$", 0, -1, -1, 1, "before", 4, r"^(.+,\s*[A-Z]{2})$", _NEVER, _NEVER, True),
    "apex": ("APEX", rf"^(?:{_DAY})$", 0, -1, -1, 1, "before", 12, r"([A-Z][A-Za-z .'’-]+,\s*[A-Z]{2})(?:\s+\d{5})?$", _NEVER, r"(?i)^past events$", False),
    "buku": ("Buku", rf"^(?:{_DAY})$", 0, -1, -1, 1, "after", 6, _TOWN, r"(?i)^view event", _NEVER, False),
    "pll": ("PLL", rf"^({_DAY})\s*\|\s*(.+)$", 1, -1, 2, 1, "before", 1, _NEVER, r"(?i)^find out", _NEVER, False),
    "trilogy": ("Trilogy", rf"^(.+?)\s+({_DAY})\s*\|\s*([A-Z]{{2}})\b.*$", 2, 1, 3, 1, "anchor", 0, _NEVER, _NEVER, _NEVER, False),
    "victory": ("Victory", rf"^(?:(?:Mon|Tues|Wednes|Thurs|Fri|Satur|Sun)day,?\s+)?({_DAY})$", 1, -1, -1, 1, "first after", 5, _TOWN, r"(?i)^view event", _NEVER, False),
    "hogans": ("Hogan's", rf"^.*?({_DAY}).*$", 1, -1, -1, 1, "first line", 8, _TOWN, _NEVER, _NEVER, False),
    "ml8": ("ML8", rf"^{vocab.MONTH}$", 0, -1, -1, 6, "before", 10, _TOWN, _NEVER, _NEVER, False),
    "primetime": ("PrimeTime", rf"^(?:{_DAY})$", 0, -1, -1, 1, "before", 3, _TOWN, _NEVER, _NEVER, False),
    "adrenaline": ("Adrenaline", r"(?i)^(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)$", 0, -1, -1, 2, "first after", 6, _TOWN, _NEVER, _NEVER, False),
    "nlf": ("NLF", rf"^.*?({_DAY}).*$", 1, -1, -1, 1, "first line", 8, r"([A-Z][A-Za-z .'’-]+,\s*[A-Z]{2})(?:\s+\d{5})?$", _NEVER, _NEVER, False),
}
_COLUMNS = "layout string, organizer string, anchor string, date_group int, name_group int, place_group int, date_lines int, name_from string, ahead int, place string, stop string, last string, upcoming boolean"


def _extract(x: Column, pattern: Column, group: Column) -> Column:
    """As regexp_extract, of a pattern and a group that are columns."""
    return F.call_function("regexp_extract", x, pattern, group)


def _first(lines: Column, wanted) -> Column:
    return F.try_element_at(F.filter(lines, wanted), F.lit(1))


def _date_text(lines: Column, i: Column, count: Column, line: Column, anchor: Column, group: Column) -> Column:
    """The date's text: the anchor's group, or its lines joined, a month repeated by a widget once and '&' before a year dropped."""
    joined = F.array_join(F.slice(lines, i + 1, count), " ")
    tidy = F.regexp_replace(F.regexp_replace(joined, rf"(?i)\b({vocab.MONTH})\s+(?:\1\s+)+", "$1 "), r"\s*&\s*(?=(?:19|20)\d\d\b)", " ")
    return F.when(count > 1, tidy).when(group == 0, line).otherwise(_extract(line, anchor, group))


def layout_events(pages: DataFrame, as_of: str) -> DataFrame:
    """One row an event of pages whose layout is known.

    pages: page_id, layout, lines (array of the page's lines). Returns page_id, layout, line_no, organizer, name, start,
    end, raw_date, place, ages, gender, note. Of an event that a page lists twice the first stands; pages of no known
    layout, without lines or without anchors have no events.
    """
    spark = pages.sparkSession
    rules = F.broadcast(spark.createDataFrame([(k, *v) for k, v in LAYOUTS.items()], _COLUMNS))  # one row a layout
    known = pages.join(rules, "layout")
    ends = F.coalesce(F.array_min(F.filter(F.transform("lines", lambda x, i: F.when(F.rlike(x, F.col("last")), i)), lambda i: i.isNotNull())), F.size("lines"))
    read = known.withColumn("lines", F.slice(F.transform("lines", lambda x: squeeze(x)), 1, F.greatest(ends, F.lit(0))))
    hits = F.filter(F.transform("lines", lambda x, i: F.when(F.rlike(x, F.col("anchor")), i)), lambda i: i.isNotNull())
    # A widget prints the month twice: the first line of a run of anchors counts.
    runs = let(hits, lambda h: F.filter(h, lambda i: ~(F.array_contains(h, i - 1) & (F.col("date_lines") > 1))))
    rows = read.withColumn("_at", runs).select("*", F.posexplode("_at").alias("_k", "line_no"))
    line = F.get("lines", F.col("line_no"))
    stop = F.coalesce(F.get("_at", F.col("_k") + 1), F.size("lines"))
    first = F.col("line_no") + F.when(F.col("date_lines") > 1, F.when(F.col("name_from") == "before", 1).otherwise(F.col("date_lines"))).otherwise(1)
    after = F.slice("lines", F.greatest(first + 1, F.lit(1)), F.greatest(F.least(F.col("ahead"), stop - first), F.lit(0)))
    until = let(after, lambda a: let(F.array_min(F.filter(F.transform(a, lambda x, i: F.when(F.rlike(x, F.col("stop")), i)), lambda i: i.isNotNull())), lambda n: F.when(n.isNull(), a).otherwise(F.slice(a, 1, n))))
    # Of a date in pieces the pieces are no part of the block.
    until = F.when(F.col("date_lines") > 1, F.filter(until, lambda x: ~x.rlike(rf"^(?:\d{{1,2}}|&|(?:19|20)\d\d|{vocab.MONTH})$"))).otherwise(until)
    rows = rows.withColumns({"_line": line, "_after": until, "_before": F.get("lines", F.col("line_no") - 1)})
    place_at = F.array_min(F.filter(F.transform("_after", lambda x, i: F.when(F.rlike(x, F.col("place")), i)), lambda i: i.isNotNull()))
    rows = rows.withColumn("_place_at", place_at)
    plain = lambda x: ~x.rlike(_FURNITURE) & ~x.rlike(_TOWN) & ~x.rlike(rf"^{_AGES}$") & (F.length(x) > 3)
    upto = F.slice("_after", 1, F.coalesce("_place_at", F.size("_after")))
    name = (
        F.when(F.col("name_from") == "anchor", _extract(F.col("_line"), F.col("anchor"), F.greatest("name_group", F.lit(0))))
        .when(F.col("name_from") == "before", F.col("_before"))
        .when(F.col("name_from") == "after", F.array_join(F.filter(upto, plain), " "))
        .when(F.col("name_from") == "first after", _first(F.col("_after"), plain))
        .otherwise(_first(F.col("lines"), plain))
    )
    place = F.when(F.col("place_group") > 0, _extract(F.col("_line"), F.col("anchor"), F.greatest("place_group", F.lit(0)))).otherwise(_extract(F.get("_after", F.col("_place_at")), F.col("place"), F.lit(1)))
    raw = _date_text(F.col("lines"), F.col("line_no"), F.col("date_lines"), F.col("_line"), F.col("anchor"), F.greatest("date_group", F.lit(0)))
    rows = rows.withColumns({"name": clean_name(name), "raw_date": raw, "place": F.nullif(squeeze(place), F.lit("")), "_block": F.array_join("_after", " | ")})
    rows = rows.withColumn("_d", F.get(find_ranges(F.col("raw_date"), as_of), F.lit(0))).where("_d IS NOT NULL AND name <> ''")
    at = F.lit(as_of).cast("date")
    season = F.when(F.col("upcoming"), next_season(F.col("_d.start"), F.coalesce("_d.end", "_d.start"), F.date_sub(at, 3)))
    rows = rows.withColumn("_s", season)
    said = F.concat_ws(" | ", "name", "_line", "_block")
    out = rows.select("page_id", "layout", "line_no", "organizer", "name", F.coalesce("_s.start", "_d.start").alias("start"), F.coalesce("_s.end", "_d.end").alias("end"), "raw_date", "place", F.nullif(F.regexp_extract("_block", _AGES, 1), F.lit("")).alias("ages"), gender_class(said).alias("gender"), F.col("_s.note").alias("note"))
    once = out.groupBy("page_id", "layout", F.lower("name").alias("_name"), "start").agg(F.min_by(F.struct(*[c for c in out.columns if c not in ("page_id", "layout", "start")]), "line_no").alias("r"))
    return once.select("page_id", "layout", "r.line_no", "r.organizer", "r.name", "start", "r.end", "r.raw_date", "r.place", "r.ages", "r.gender", "r.note")
