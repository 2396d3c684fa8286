from __future__ import annotations

import datetime as dt

import pytest

from gatherline.operators import layouts

D = dt.date
#: A page of each layout, and its events: name, start, end, place, ages.
FIXTURES = {
    "mlt": (["Events", "Tournament", "Carolina Box Championship", "February 6th-7th, 2026", "Oak Arena, NC", "Boys", "2030-2033", "Showcase", "Otter Showcase", "November 14, 2026", "Elm Park, NJ", "Girls", "2031/2032"], [("Carolina Box Championship", D(2027, 2, 6), D(2027, 2, 7), "Oak Arena, NC", "2030-2033"), ("Otter Showcase", D(2026, 11, 14), D(2026, 11, 14), "Elm Park, NJ", "2031/2032")]),
    "apex": (["Boys Tournaments", "Fall Faceoff", "October 24 - 25, 2026", "2030", "2029", "Location", "Cedar Grounds 1 Oak Rd Newark, DE 19716", "Past Events", "Old Cup", "May 2, 2026", "Elm, NJ"], [("Fall Faceoff", D(2026, 10, 24), D(2026, 10, 25), "Cedar Grounds 1 Oak Rd Newark, DE"[-10:], "2030")]),
    "buku": (["October 24-25, 2026", "Santa Otter", "Fall Brawl", "Santa Barbara, CA", "View Event", "November 7, 2026", "Desert Duel", "View Event", "Footer, CA"], [("Santa Otter Fall Brawl", D(2026, 10, 24), D(2026, 10, 25), "Santa Barbara, CA", None), ("Desert Duel", D(2026, 11, 7), D(2026, 11, 7), None, None)]),
    "pll": (["High Peaks Sixes", "OCTOBER 10-11, 2026   |   LAKE PLACID, NY", "BOYS 2035-2028", "Find Out More"], [("High Peaks Sixes", D(2026, 10, 10), D(2026, 10, 11), "LAKE PLACID, NY", "2035-2028")]),
    "trilogy": (["Boys Tournaments", "Midwest Momentum OCT 24 - 25, 2026 | OH", "Prospect Showcase NOV 7, 2026 | NJ | GIRLS"], [("Midwest Momentum", D(2026, 10, 24), D(2026, 10, 25), "OH", None), ("Prospect Showcase", D(2026, 11, 7), D(2026, 11, 7), "NJ", None)]),
    "victory": (["October 24 & 25, 2026", "VICTORY FALL CLASSIC", "Frederica, DE", "View Event", "Friday, June 18, 2027", "Learn More", "Junior Showcase", "Elm Falls, NJ"], [("Victory Fall Classic", D(2026, 10, 24), D(2026, 10, 25), "Frederica, DE", None), ("Junior Showcase", D(2027, 6, 18), D(2027, 6, 18), "Elm Falls, NJ", None)]),
    "hogans": (["Harvest Shootout", "Join us on November 7-8, 2026 for games", "Glen Burnie, MD", "U13, U15"], [("Harvest Shootout", D(2026, 11, 7), D(2026, 11, 8), "Glen Burnie, MD", "U13, U15")]),
    "ml8": (["THE SPOTLIGHT", "October", "October", "17", "&", "18", "2026", "Frederica, DE", "GOLD RUSH", "December", "December", "5", "&", "2026"], [("The Spotlight", D(2026, 10, 17), D(2026, 10, 18), "Frederica, DE", None), ("Gold Rush", D(2026, 12, 5), D(2026, 12, 5), None, None)]),
    "primetime": (["Prime Fall Challenge", "October 17, 2026", "Ridgefield, CT", "2030-2034", "Launch Cup", "November 1, 2026", "Natick, MA"], [("Prime Fall Challenge", D(2026, 10, 17), D(2026, 10, 17), "Ridgefield, CT", "2030-2034"), ("Launch Cup", D(2026, 11, 1), D(2026, 11, 1), "Natick, MA", None)]),
    "adrenaline": (["Nov", "07", "Gold Cup", "2027 - 2032", "Frederica, DE", "Boys Only", "Dec", "05", "Ice Cup", "Elm Falls, NJ"], [("Gold Cup", D(2026, 11, 7), D(2026, 11, 7), "Frederica, DE", "2027 - 2032"), ("Ice Cup", D(2026, 12, 5), D(2026, 12, 5), "Elm Falls, NJ", None)]),
    "nlf": (["Futures Invitational", "Dates: October 3 - 4, 2026", "River Park, Elm Falls, NJ 01234"], [("Futures Invitational", D(2026, 10, 3), D(2026, 10, 4), "Elm Falls, NJ", None)]),
}


@pytest.fixture(scope="module")
def got(spark):
    rows = [(i, k, lines) for i, (k, (lines, _)) in enumerate(FIXTURES.items())]
    rows += [(100, "buku", []), (101, "buku", None), (102, "unknown", ["October 24-25, 2026", "Cup"]), (103, None, ["x"]), (104, "pll", ["no anchor here"]), (105, "primetime", ["Twice Cup", "May 1, 2027", "Elm, NJ", "TWICE CUP", "May 1, 2027", "Oak, NJ"])]
    table = spark.createDataFrame(rows, "page_id long, layout string, lines array<string>").selectExpr("*", "'x' AS name", "'y' AS start", "'z' AS anchor_")
    return layouts.layout_events(table.select("page_id", "layout", "lines"), "2026-09-01").collect()


@pytest.mark.parametrize("layout", [*FIXTURES])
def test_layout(got, layout):
    found = [(r.name, r.start, r.end, r.place, r.ages) for r in sorted(got, key=lambda r: r.line_no) if r.layout == layout and r.page_id < 100]
    want = FIXTURES[layout][1]
    if layout == "apex":
        want = [(n, s, e, "Newark, DE", a) for n, s, e, _, a in want]
        found = [(n, s, e, p[-10:], a) for n, s, e, p, a in found]
    assert found == want


def test_years_repeats_and_odd_pages(got):
    assert [r.note for r in got if r.name == "Carolina Box Championship"] == ["listed as 2026"]
    assert [(r.name, r.place) for r in got if r.page_id == 105] == [("Twice Cup", "Elm, NJ")]
    assert not [r for r in got if 100 <= r.page_id < 105]
    genders = {r.name: r.gender for r in got}
    assert genders["Otter Showcase"] == "girls" and genders["High Peaks Sixes"] == "boys"
