"""Dates, times, ages and team counts in free text, as column expressions. ``as_of`` is always given, never today."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gatherline import vocab
from gatherline.functions.names import squeeze
from gatherline.functions.values import let, text

MONTH, WEEKDAY = vocab.MONTH, vocab.WEEKDAY
RANGE = "struct<start:date,end:date>"


def month_number(word: Column) -> Column:
    """1 to 12 by the first three letters, null for others."""
    at = F.array_position(F.array(*map(F.lit, vocab.MONTHS)), F.substring(F.lower(word), 1, 3))
    return F.when(at > 0, at).cast("int")


def day(year: Column, month: Column, number: Column) -> Column:
    """The date, null where there is no such day."""
    return F.try_to_date(F.format_string("%04d-%02d-%02d", year.cast("int"), month.cast("int"), number.cast("int")), "yyyy-MM-dd")


def span(start: Column, end: Column) -> Column:
    return F.struct(start.cast("date").alias("start"), end.cast("date").alias("end"))


def no_date() -> Column:
    return F.lit(None).cast("date")


def lenient_range(x: Column, default_year: Column | int | None = None) -> Column:
    """struct<start, end> of a messy date text: any case, ordinals, '&' for '-', extra words; an end before its start becomes it.

    The first two month names count, the first day after each, and the second day after a single month. A year of
    2000-2099 must be written or given; the last one written is the end's where the months run over New Year.
    """
    t = F.regexp_replace(text(x), r"(?i)(\d+)(st|nd|rd|th)\b", "$1")
    t = F.lower(squeeze(F.regexp_replace(F.regexp_replace(t, "[–—&]", "-"), "[.,]", " ")))
    years = F.regexp_extract_all(t, F.lit(r"\b(20\d{2})\b"), F.lit(1))
    given = F.lit(None).cast("int") if default_year is None else (default_year if isinstance(default_year, Column) else F.lit(default_year)).cast("int")
    y1 = F.coalesce(F.try_element_at(years, F.lit(1)).cast("int"), given)
    y2 = F.coalesce(F.try_element_at(years, F.lit(-1)).cast("int"), given)
    # Months and days in order, as signed numbers: -12..-1 for months, 1..31 for days.
    tokens = F.regexp_extract_all(t, F.lit(r"\b([a-z]{3,9}|\d{1,2})\b"), F.lit(1))
    marks = F.transform(tokens, lambda w: F.when(w.rlike(r"^\d"), w.try_cast("int")).otherwise(-month_number(w)))
    marks = F.filter(marks, lambda m: m.isNotNull() & ((m < 0) | m.between(1, 31)))
    return let(F.transform(marks, lambda m, i: F.struct(i.alias("i"), m.alias("m"))), lambda whole: _lenient(whole, y1, y2))


def _lenient(whole: Column, y1: Column, y2: Column) -> Column:
    months = F.filter(whole, lambda s: s["m"] < 0)
    first, second = F.try_element_at(months, F.lit(1)), F.try_element_at(months, F.lit(2))
    days = lambda after: F.filter(whole, lambda s: (s["m"] > 0) & (s["i"] > after["i"]))
    d = F.transform(days(first), lambda s: s["m"])
    e = F.transform(days(second), lambda s: s["m"])
    m1, m2 = -first["m"], F.coalesce(-second["m"], -first["m"])
    d1 = F.try_element_at(d, F.lit(1))
    d2 = F.when(second.isNotNull(), F.coalesce(F.try_element_at(e, F.lit(1)), d1)).otherwise(F.coalesce(F.try_element_at(d, F.lit(2)), d1))
    both = span(day(y1, m1, d1), day(F.when(m2 < m1, y2).otherwise(y1), m2, d2))
    good = lambda r: r["start"].isNotNull() & r["end"].isNotNull()
    return let(both, lambda r: span(F.when(good(r), r["start"]), F.when(good(r), F.greatest(r["start"], r["end"]))))


def strict_range(x: Column, default_year: Column | int | None = None) -> Column:
    """struct<start, end> of a date text in one of six exact forms; month names as 'Oct' or 'October', case matters.

    'Oct 3, 2026 - Nov 1, 2026', 'Oct 3 - Nov 1, 2026', 'Oct 3 - 4, 2026', 'Oct 3, 2026', and with a default year
    'Oct 3 - 4' and 'Oct 3'. An end may lie before its start.
    """
    t = F.regexp_replace(F.trim(F.regexp_replace(text(x), "[–—]", "-")), r"([A-Za-z]{3})[a-z]*", "$1")
    return let(F.regexp_replace(t, r"\s*-\s*", " - "), lambda bare: _strict(bare, default_year))


def _strict(t: Column, default_year: Column | int | None) -> Column:
    given = F.lit(None).cast("int") if default_year is None else (default_year if isinstance(default_year, Column) else F.lit(default_year)).cast("int")
    named = lambda w: F.when(F.initcap(w) == w, month_number(w))
    forms = [
        (r"^(\w{3}) (\d{1,4}), (\d{4}) - (\w{3}) (\d{1,4}), (\d{4})$", (3, 1, 2), (6, 4, 5)),
        (r"^(\w{3}) (\d{1,4}) - (\w{3}) (\d{1,4}), (\d{4})$", (5, 1, 2), (5, 3, 4)),
        (r"^(\w{3}) (\d{1,4}) - (\d{1,4}), (\d{4})$", (4, 1, 2), (4, 1, 3)),
        (r"^(\w{3}) (\d{1,4}), (\d{4})$", (3, 1, 2), (3, 1, 2)),
        (r"^(\w{3}) (\d{1,4}) - (\d{1,4})$", (0, 1, 2), (0, 1, 3)),
        (r"^(\w{3}) (\d{1,4})$", (0, 1, 2), (0, 1, 2)),
    ]
    out = None
    for form, a, b in forms:
        part = lambda g, f=form: F.regexp_extract(t, f, g)
        ends = [day(part(y).try_cast("int") if y else given, named(part(m)), part(d).try_cast("int")) for y, m, d in (a, b)]
        made = let(span(*ends), lambda r: span(F.when(r["end"].isNotNull(), r["start"]), F.when(r["start"].isNotNull(), r["end"])))
        hit = t.rlike(form) & (F.lit(True) if a[0] else given.isNotNull())
        out = F.when(hit, made) if out is None else out.when(hit, made)
    return out.otherwise(span(no_date(), no_date()))


def find_ranges(x: Column, as_of: Column | str) -> Column:
    """array<struct<start, end>> of every date range in a text, in order.

    A date without a year takes the next occurrence (more than 60 days past counts as next year), or the year of a full
    date of the same day elsewhere in the text. Only where no month is named, numeric dates (m/d, m/d/y) are read.
    """
    as_of = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    t = F.regexp_replace(text(x), WEEKDAY, "")
    t = F.regexp_replace(t, r"(?:\s*[-–—]\s*){2,}", " - ")
    pattern = f"({vocab.DATE_TEXT})"
    cleaned = F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(1)), _tidy)

    def made(raw: Column) -> Column:
        dated = raw.rlike(r"\b20\d\d\b")
        later = lambda now: F.when(~dated & (now["start"] < F.date_sub(as_of, 60)), strict_range(raw, F.year(as_of) + 1)).otherwise(now)
        best = let(strict_range(raw, F.year(as_of)), later)
        return let(best, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"), dated.alias("dated")))

    def settled(found: Column) -> Column:
        same = lambda r: F.try_element_at(F.filter(found, lambda f: f["dated"] & (F.date_format(f["start"], "MMdd") == F.date_format(r["start"], "MMdd"))), F.lit(-1))
        bare = lambda r: span(r["start"], r["end"])
        named = F.transform(found, lambda r: F.when(r["dated"], bare(r)).otherwise(let(F.coalesce(same(r), r), bare)))
        return F.when(F.size(found) > 0, named).otherwise(numeric_ranges(t, as_of))

    return let(F.filter(F.transform(cleaned, made), lambda r: r["start"].isNotNull()), settled)


def _tidy(raw: Column) -> Column:
    """One date text in the strict forms' spelling."""
    out = F.regexp_replace(raw, r"(?i)(\d)(?:st|nd|rd|th)\b", "$1")
    out = F.regexp_replace(out, r"(\d{1,2})\s+(20\d\d)\b", "$1, $2")
    out = F.regexp_replace(out, r"(\d),(20\d\d)\b", "$1, $2")
    out = F.regexp_replace(F.regexp_replace(out, r"(?i)\s*[–—\-&/]\s*|\s+(?:to|thru|through|and)\s+", " - "), r"\.", "")
    return F.initcap(squeeze(out))


def numeric_ranges(t: Column, as_of: Column) -> Column:
    """array<struct<start, end>> of m/d, m/d/y and ranges of them; spans over 14 days are single days."""
    pattern = r"\b(\d{1,2})/(\d{1,2})(?:/(\d{2,4}))?(?:\s*(?:–|—|-|to)\s*(?:(\d{1,2})/)?(\d{1,2})(?:/(\d{2,4}))?)?\b"
    groups = [F.regexp_extract_all(t, F.lit(pattern), F.lit(g)) for g in range(1, 7)]
    rows = F.arrays_zip(*[g.alias(n) for g, n in zip(groups, ("m1", "d1", "y1", "m2", "d2", "y2"), strict=True)])
    century = lambda y: F.when(y < 100, y + 2000).otherwise(y)
    number = lambda s: F.nullif(s, F.lit("")).try_cast("int")

    def made(r: Column) -> Column:
        written = F.coalesce(number(r["y1"]), number(r["y2"]))
        y = century(F.coalesce(written, F.year(as_of)))
        start = day(y, number(r["m1"]), number(r["d1"]))
        end = F.when(number(r["d2"]).isNotNull(), day(century(F.coalesce(number(r["y2"]), y)), F.coalesce(number(r["m2"]), number(r["m1"])), number(r["d2"]))).otherwise(start)
        roll = written.isNull() & (start < F.date_sub(as_of, 60))
        start2, end2 = F.when(roll, F.add_months(start, 12)).otherwise(start), F.when(roll, F.add_months(end, 12)).otherwise(end)
        odd = (end2 < start2) | (F.datediff(end2, start2) > 14)
        return span(F.when(end2.isNotNull(), start2), F.when(odd, start2).otherwise(end2))

    return F.filter(F.transform(rows, made), lambda r: r["start"].isNotNull())


def date_label(start: Column, end: Column) -> Column:
    """'Jun 19–20, 2027', 'Jun 29 – Jul 1, 2027', 'Jun 19, 2027'; '' without a start."""
    e = F.coalesce(end, start)
    f = lambda d, p: F.date_format(d, p)
    return (
        F.when(start.isNull(), "")
        .when(e == start, f(start, "MMM d, yyyy"))
        .when(F.trunc(e, "month") == F.trunc(start, "month"), F.concat(f(start, "MMM d"), F.lit("–"), f(e, "d, yyyy")))
        .when(F.year(e) == F.year(start), F.concat(f(start, "MMM d"), F.lit(" – "), f(e, "MMM d, yyyy")))
        .otherwise(F.concat(f(start, "MMM d, yyyy"), F.lit(" – "), f(e, "MMM d, yyyy")))
    )


def overlaps(s1: Column, e1: Column, s2: Column, e2: Column, tolerance: int = 1) -> Column:
    """Whether two spans meet within the tolerance; false without both starts. A missing end is the start."""
    return F.coalesce((F.date_sub(s1, tolerance) <= F.coalesce(e2, s2)) & (F.date_sub(s2, tolerance) <= F.coalesce(e1, s1)), F.lit(False))


def month_span(year: Column, first: Column, last: Column) -> Column:
    """First day of one month to the last day of another."""
    return span(F.make_date(year, first, F.lit(1)), F.last_day(F.make_date(year, last, F.lit(1))))


def next_season(start: Column, end: Column, as_of: Column) -> Column:
    """struct<start, end, note>: a past date on an upcoming-only list belongs to next year; over 400 days past it stays."""
    late = F.datediff(as_of, end)
    moved = (late > 0) & (late <= 400)
    return F.struct(F.when(moved, F.add_months(start, 12)).otherwise(start).alias("start"), F.when(moved, F.add_months(end, 12)).otherwise(end).alias("end"), F.when(moved, F.concat(F.lit("listed as "), F.year(start).cast("string"))).alias("note"))


def grad_years(x: Column, season: Column, floor: Column | None = None) -> Column:
    """struct<label, grad_min, grad_max, gender> of divisions in a text.

    Class years are read as they stand; 'U14' and '14U' and grades are turned into class years of the season; high
    school without any stands for the next four classes. floor: the oldest class that can still play.
    """
    t = text(x)
    numbers = lambda p, g=1: F.transform(F.regexp_extract_all(t, F.lit(p), F.lit(g)), lambda v: v.try_cast("int"))
    ages = F.filter(F.concat(numbers(r"\b[Uu](\d{1,2})\b"), numbers(r"\b(\d{1,2})[Uu]\b")), lambda a: a.between(5, 19))
    grades = F.filter(numbers(r"(?i)\b(\d{1,2})(?:st|nd|rd|th)\s+grade\b"), lambda g: g.between(1, 12))
    years = F.concat(numbers(r"\b(20[2-4]\d)(?:'?s)?\b"), F.transform(ages, lambda a: season + 19 - a), F.transform(grades, lambda g: season + 13 - g))
    years = let(years, lambda y: F.when((F.size(y) == 0) & t.rlike(r"(?i)\b(HS|high school|varsity|JV)\b"), F.array(season + 1, season + 4)).otherwise(y))
    if floor is not None:
        years = F.filter(years, lambda y: F.coalesce(y >= floor, F.lit(True)))
    return let(years, lambda y: _labelled(y, t))


def _labelled(years: Column, t: Column) -> Column:
    low, high = F.array_min(years), F.array_max(years)
    boys, girls = t.rlike(r"(?i)\b(boys?|men)\b"), t.rlike(r"(?i)\b(girls?|women)\b")
    adult = t.rlike(r"(?i)\b(adult|men'?s|women'?s|masters|open)\b") & low.isNull()
    label = F.when(adult, "Adult").when(low == high, low.cast("string")).otherwise(F.concat(low.cast("string"), F.lit("–"), high.cast("string")))
    gender = F.when(adult, None).when(boys & girls, "coed").when(boys, "boys").when(girls, "girls")
    return F.struct(label.alias("label"), low.alias("grad_min"), high.alias("grad_max"), gender.alias("gender"))


def team_int(x: Column) -> Column:
    """A text as a whole number of teams: digits with optional commas, else null."""
    bare = F.regexp_replace(F.trim(text(x.cast("string"))), ",", "")
    return F.when(bare.rlike(r"^\d+$"), bare.try_cast("int")).when(bare.rlike(r"^\d+\.0$"), F.regexp_replace(bare, r"\.0$", "").try_cast("int"))


def team_count(x: Column) -> Column:
    """Teams named in a text ('Team cap: 64', '48 teams'), from 4 to 600."""
    cap = F.regexp_extract(text(x), r"(?i)\b(?:team\s+cap|teams?\s+max(?:imum)?|max(?:imum)?\s+teams?)\s*(?:of|:|is)?\s*(\d{2,3})\b", 1)
    told = F.regexp_extract(text(x), r"(?i)\b(?:(?:limited|capped)\s+to\s+|team\s+cap\s*(?:of|:)?\s*|max(?:imum)?\s*(?:of)?\s*)?(\d{2,3})\s*(?:\+\s*)?(?:-\s*)?teams?\b", 1)
    n = F.coalesce(F.nullif(cap, F.lit("")), F.nullif(told, F.lit(""))).cast("int")
    return F.when(n.between(4, 600), n)


def clock_times(x: Column) -> Column:
    """struct<first, last> of the clock times in a text, as '8:00 AM'; last is null if there is one only."""
    pattern = r"(?i)\b(1[0-2]|0?[1-9])(?::([0-5]\d))?\s*([ap])\.?\s*m\.?\b"
    h, m, ap = (F.regexp_extract_all(text(x), F.lit(pattern), F.lit(g)) for g in (1, 2, 3))
    rows = F.transform(
        F.arrays_zip(h.alias("h"), m.alias("m"), ap.alias("p")),
        lambda r: F.struct(
            (F.pmod(r["h"].cast("int"), F.lit(12)) * 60 + F.when(F.lower(r["p"]) == "p", 720).otherwise(0) + F.coalesce(F.nullif(r["m"], F.lit("")).cast("int"), F.lit(0))).alias("at"),
            F.concat(r["h"].cast("int").cast("string"), F.lit(":"), F.lpad(F.when(r["m"] == "", "00").otherwise(r["m"]), 2, "0"), F.lit(" "), F.upper(r["p"]), F.lit("M")).alias("label"),
        ),
    )
    ordered = F.array_sort(rows)
    return F.struct(F.try_element_at(ordered, F.lit(1))["label"].alias("first"), F.when(F.size(ordered) > 1, F.element_at(ordered, -1)["label"]).alias("last"))
