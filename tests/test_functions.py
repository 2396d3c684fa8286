from __future__ import annotations

import datetime as dt
import math
import re
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gatherline import vocab
from gatherline.functions import dates, names, pages, places
from gatherline.functions.values import jaccard, round_even

D = dt.date


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def span(r):
    return (r.start, r.end)


def test_rounding_is_exact_at_every_tie(spark):
    values = [0.35, 2.675, 0.125, 0.375, 0.025, 1.005, 2.5, 3.5, 0.15, 0.25, -0.35, 1e-9, 123456.785] + [k / n for n in (8, 40, 60, 7) for k in range(n + 1)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 1, 2):
        got = df.select("v", round_even(F.col("v"), digits).alias("r")).collect()
        assert [r.r for r in got] == pytest.approx([round(v, digits) for v in values], abs=1e-12), digits


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(0, 1e6, allow_nan=False), min_size=1, max_size=200))
def test_rounding_of_any_number(spark, values):
    got = spark.createDataFrame([(float(v),) for v in values], "v double").select(round_even(F.col("v"), 2).alias("r")).collect()
    for v, r in zip(values, got, strict=True):
        assert abs(Fraction(r.r) - Fraction(round(v, 2))) < Fraction(1, 10**9)


@pytest.mark.parametrize(
    "text, year, want",
    [
        ("Oct. 10th-11th, 2026", None, (D(2026, 10, 10), D(2026, 10, 11))),
        ("OCT 10, 2026", None, (D(2026, 10, 10), D(2026, 10, 10))),
        ("Sept. 4, 2026", None, (D(2026, 9, 4), D(2026, 9, 4))),
        ("October 31 & November 1, 2026", None, (D(2026, 10, 31), D(2026, 11, 1))),
        ("Dec 30 – Jan 2, 2027", None, (D(2027, 12, 30), D(2027, 12, 30))),
        ("Dec 30, 2026 - Jan 2, 2027", None, (D(2026, 12, 30), D(2027, 1, 2))),
        ("Jul 27-Aug 2", 2026, (D(2026, 7, 27), D(2026, 8, 2))),
        ("Feb 30, 2026", None, (None, None)),
        ("sometime in spring", 2026, (None, None)),
        (None, 2026, (None, None)),
    ],
)
def test_lenient_dates(spark, text, year, want):
    assert span(one(spark, dates.lenient_range(F.lit(text), year))) == want


@pytest.mark.parametrize(
    "text, year, want",
    [
        ("Oct 17, 2026", None, (D(2026, 10, 17), D(2026, 10, 17))),
        ("October 10-12, 2026", None, (D(2026, 10, 10), D(2026, 10, 12))),
        ("Sep 13 - Oct 18, 2026", None, (D(2026, 9, 13), D(2026, 10, 18))),
        ("Dec 30 - Jan 2, 2027", None, (D(2027, 12, 30), D(2027, 1, 2))),
        ("OCT 10, 2026", None, (None, None)),
        ("Sept. 4, 2026", None, (None, None)),
        ("Oct 3 - 4", 2026, (D(2026, 10, 3), D(2026, 10, 4))),
        ("Oct 3 - 4", None, (None, None)),
    ],
)
def test_strict_dates(spark, text, year, want):
    assert span(one(spark, dates.strict_range(F.lit(text), year))) == want


@pytest.mark.parametrize(
    "text, as_of, want",
    [
        ("Saturday, November 7th - 8th, 2026", "2026-10-22", [(D(2026, 11, 7), D(2026, 11, 8))]),
        ("Dec 30, 2026 - Jan 2, 2027", "2026-10-22", [(D(2026, 12, 30), D(2027, 1, 2))]),
        ("March 14 - 15", "2026-10-22", [(D(2027, 3, 14), D(2027, 3, 15))]),
        ("Nov. 14th / 15th, 2026", "2026-10-22", [(D(2026, 11, 14), D(2026, 11, 15))]),
        ("Dec. 5th & 6th, 2026", "2026-10-22", [(D(2026, 12, 5), D(2026, 12, 6))]),
        ("June 26th and 27th, 2027", "2026-10-22", [(D(2027, 6, 26), D(2027, 6, 27))]),
        ("MAY 9 - 10, 2027", "2026-10-22", [(D(2027, 5, 9), D(2027, 5, 10))]),
        ("January 9 - - January 10 2027", "2026-10-22", [(D(2027, 1, 9), D(2027, 1, 10))]),
        ("May 30 - 31,2026", "2026-05-22", [(D(2026, 5, 30), D(2026, 5, 31))]),
        ("Dec 14 then Sunday, December 14, 2025", "2026-10-29", [(D(2025, 12, 14), D(2025, 12, 14))] * 2),
        ("on 11/7 - 11/8", "2026-10-22", [(D(2026, 11, 7), D(2026, 11, 8))]),
        ("3/1/27", "2026-10-22", [(D(2027, 3, 1), D(2027, 3, 1))]),
        ("nothing", "2026-10-22", []),
    ],
)
def test_dates_in_text(spark, text, as_of, want):
    assert [span(r) for r in one(spark, dates.find_ranges(F.lit(text), as_of))] == want


def test_ages_teams_and_times(spark):
    ages = lambda t, y, floor=None: one(spark, dates.grad_years(F.lit(t), F.lit(y), None if floor is None else F.lit(floor)))
    assert ages("U14 boys", 2026)[1:] == (2031, 2031, "boys")
    assert ages("18U-8U/12th-1st grade", 2026)[1:3] == (2027, 2038)
    assert ages("2026 (3); 2029 (5)", 2026, 2027)[:3] == ("2029", 2029, 2029)
    assert ages("HS Varsity", 2027)[1:3] == (2028, 2031)
    assert ages("Men's open", 2027)[0] == "Adult"
    assert ages("girls and boys", 2027)[3] == "coed"
    teams = lambda t: one(spark, dates.team_int(F.lit(t)))
    assert [teams(x) for x in ("97 college coaches", " 1,024 ", "48.0", "-3", "0", "", None)] == [None, 1024, 48, None, 0, None, None]
    assert one(spark, dates.team_count(F.lit("Team cap: 64"))) == 64 and one(spark, dates.team_count(F.lit("limited to 3 teams"))) is None
    assert tuple(one(spark, dates.clock_times(F.lit("8:00 AM to 5:30 PM")))) == ("8:00 AM", "5:30 PM")
    assert tuple(one(spark, dates.clock_times(F.lit("at 9am")))) == ("9:00 AM", None)


def test_places(spark):
    town = lambda t: tuple(one(spark, places.town_and_state(F.lit(t))))
    assert town("Farm State College, NY") == ("Farm State College", "NY")
    assert town("Net Complex, Cary NC") == ("Net Complex, Cary", "NC")
    assert town("Elm Falls, New Jersey") == ("Elm Falls", "NJ")
    assert town("Elm Falls, NC.") == ("Elm Falls", "NC")
    assert town("Nowhere") == ("Nowhere", None)
    listed = lambda t: tuple(one(spark, places.listed_town(F.lit(t))))
    assert listed("Elmhocken, PA 19428, PA") == ("Elmhocken", "PA")
    assert listed("Fort Elm, PA, PA") == ("Fort Elm", "PA")
    assert listed("Wayside Rd. Oak Falls, NJ") == ("Oak Falls", "NJ")
    assert listed("PA") == (None, "PA")
    assert one(spark, places.address_town(F.lit("701 Oak Ave, Elmville,, WA 98531"))) == "Elmville, WA"
    assert one(spark, places.address_key(F.lit("1100 Cedar Lane, Elm Town"))) == one(spark, places.address_key(F.lit("1100 Cedar Ln, Elm Town 21015")))
    assert one(spark, places.town_states(F.lit("ST. ELMO, UT and Oak Falls, Florida"))) == ["St. Elmo, UT", "Oak Falls, FL"]
    assert one(spark, places.region(F.lit("md"))) == "Mid-Atlantic" and one(spark, places.region(F.lit(None))) == "Other"
    far = one(spark, places.km(F.lit(40.0), F.lit(-75.0), F.lit(41.0), F.lit(-75.0)))
    assert math.isclose(far, 111.19, rel_tol=1e-3)


def test_names(spark):
    tokens = lambda f, t: set(one(spark, f(F.lit(t))))
    assert one(spark, names.link_name(F.lit("2026 5th Annual Otter Cup (Boys) | Day 1"))) == "otter cup"
    assert tokens(names.identity_tokens, "Boys Red Otter Fall Classic HS") == {"red", "otter"}
    assert tokens(names.level_tokens, "Otter High School Cup") == {"hs"} and tokens(names.level_tokens, "Otter MS") == {"middle"}
    assert one(spark, names.edition_name(F.lit("PT Fall Challenge - 2025"))) == one(spark, names.edition_name(F.lit("Prime Time Fall Challenge")))
    assert one(spark, names.core_organizer(F.lit("Otter Events LLC"))) == "otter" and one(spark, names.core_organizer(F.lit(""))) is None
    assert one(spark, names.link_organizer(F.lit(None))) == ""
    assert one(spark, names.gender_class(F.lit("Boys & Girls Cup"))) == "coed"
    assert one(spark, names.sport_class(F.lit("field hockey cup"))) == "hockey" and one(spark, names.sport_class(F.lit("field hockey cup"), in_order=False)) == "field hockey"
    assert one(spark, names.venue_match(F.lit("Otter Sports Complex"), F.lit("Otter Training Center"))) is True
    assert one(spark, names.venue_match(F.lit("Otter & Elm"), F.lit("Otter"))) is False
    assert one(spark, names.venue_match(F.lit("TBD"), F.lit("Otter"))) is None
    assert one(spark, names.loose_venue(F.lit("HBSC"), F.lit("Harbor Bay Sports Complex"))) is True
    assert one(spark, names.loose_venue(F.lit("Hoover Met Complex"), F.lit("Hoover Metropolitan Complex"))) is True
    assert one(spark, names.is_real_venue(F.lit("DE and PA"))) is False
    assert [one(spark, names.club_from_team(F.lit(t))) for t in ("3d NE 2028 Red", "CT Lightning Gold-Wright", "Aces 18-Cahill", "M&amp;D Blue", "TBD")] == ["3d NE", "CT Lightning", "Aces", "M&D", None]


def test_pages(spark):
    html = """<html><title> A &amp; B </title><script>var x="<a href='no'>";</script><a class=z href="/events/1">Fall <b>Cup</b></a><a href='mailto:Info@mail.test'>write</a>
    <p>Vendor coordinator: booth@mail.test</p><p>Call (201) 555-0123 or 201.555.0123</p><img src="logo@2x.png"></html>"""
    assert one(spark, pages.page_title(F.lit(html))) == "A & B"
    assert [tuple(r) for r in one(spark, pages.links(F.lit(html)))][-2:] == [("/events/1", "Fall Cup"), ("mailto:Info@mail.test", "write")]
    assert one(spark, pages.emails(F.lit(html))) == ["info@mail.test", "booth@mail.test"]
    assert one(spark, pages.phones(F.lit("Call (201) 555-0123 or 201.555.0123, not 1234567890123"))) == ["(201) 555-0123"]
    assert one(spark, pages.vendor_email(F.lit("info@mail.test and then, for vendors: booth@mail.test"))) == "booth@mail.test"
    assert one(spark, pages.page_lines(F.lit("<p>one</p><p>two<br>three</p>"))) == ["one", "two", "three"]
    assert one(spark, pages.registered_domain(F.lit("https://www.a.otter.co.uk/x"))) == "otter.co.uk"
    assert [r.value for r in one(spark, pages.spots(F.lit("😀ab ab"), "ab"))] == ["ab", "ab"] and one(spark, pages.spots(F.lit("😀ab ab"), "ab"))[1].start == 4


@settings(max_examples=15, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=2)), st.sets(st.text("abc", min_size=1, max_size=2)))
def test_jaccard_is_symmetric_and_bounded(spark, a, b):
    df = spark.createDataFrame([(sorted(a), sorted(b))], "a array<string>, b array<string>")
    x, y = df.select(jaccard(F.col("a"), F.col("b")).alias("x"), jaccard(F.col("b"), F.col("a")).alias("y")).first()
    assert x == y and 0 <= x <= 1
    assert x == (len(a & b) / len(a | b) if a and b else 0)


def test_guarded_patterns_match_alike():
    """A guard changes no match: every signal on every text, and on texts that its alternatives begin and end."""
    from gatherline.functions.patterns import alternatives, guarded

    texts = ["", "county fairgrounds by the lake", "admission: $5", "$12 per person at the gate", "tickets from $9", "10 x 10 tent required", "no resale", "rt. 9", "20% of sales", "free to attend", "main st fair", "\u00e9 bandstand", "12 % of gross"]
    for _, pattern, _ in vocab.FESTIVAL_SIGNALS:
        some = texts + [a.replace("\\b", "").replace("?", "") for a in alternatives(pattern)]
        quick = guarded(pattern)
        assert quick != pattern
        assert [bool(re.search(pattern, t)) for t in some] == [bool(re.search(quick, t)) for t in some], pattern
    for open_ended in ("a?b|c", r"\d*x", "(?:ab)?c", "x|.y", r"\d{0,2}z"):
        assert guarded(open_ended) == open_ended


def test_reasons_of_the_festival_fit(spark):
    from gatherline.operators.scores import festival_fit

    tags = F.array(*map(F.lit, ("family", "alcohol", "indoor")))
    day = lambda x: F.lit(x).cast("date")
    got = one(spark, festival_fit(F.lit("12th Annual Harvest"), F.lit(""), tags, F.lit(500.0), day("2026-10-03"), day("2026-10-04"), day("2026-09-20"), F.lit(2), F.lit(None).cast("int"), F.lit(None).cast("int"), day("2026-09-01")))
    assert sorted(got.reasons) == sorted(["family +15", "indoor -8", "fee-over-400 -12", "seasonal +10", "yearly +6", "several days +5"])
    assert got.fit == 40 + 15 - 8 - 12 + 10 + 6 + 5 and got.excluded is None
    private = one(spark, festival_fit(F.lit("Gala"), F.lit(""), tags, F.lit(None).cast("double"), day("2026-10-03"), day("2026-10-04"), day("2026-09-20"), F.lit(2), F.lit(None).cast("int"), F.lit(None).cast("int"), day("2026-09-01")))
    assert private.fit is None and private.reasons is None and private.excluded
