from __future__ import annotations

import datetime as dt

import pytest

from gatherline.operators import site_walk

D = dt.date
FOOT = "<footer>Otter Events, PO Box 905 Sparta, NJ 07871</footer>"
PAGES = {
    "https://otter.test/": "<title>Otter Events</title><h1>Otter Events</h1><a href='/tournaments'>Tournaments</a><a href='/about'>About us</a><a href='/sponsors'>Sponsors</a><a href='/news/event-recap'>Event recap news</a><a href='https://tourneymachine.com/x'>Register</a><a href='https://other.test/events'>Events of others</a><p>Mail <a href='mailto:info@otter.test'>us</a> or someone@gmail.com</p>" + FOOT,
    "https://otter.test/tournaments/": "<h1>Tournaments</h1><div><h3>Harvest Cup</h3><p>November 7-8, 2026</p><a href='/tournaments/harvest-cup'>Learn more</a></div><div><h3>Pine Classic</h3><p>Nov 14, 2026</p><p>Salem, MA</p></div><a href='/tournaments/winter-slam'>Winter Slam</a><a href='/tournaments/harvest-cup'>again</a><a href='/tournaments/not-landed'>none</a>" + FOOT,
    "https://otter.test/tournaments/harvest-cup": "<h1>Harvest Cup</h1><p>November 7-8, 2026</p><p>Venue: Oak Park</p><p>Elm Falls, NJ</p><p>48 teams, boys 2030-2033</p>" + FOOT,
    "https://otter.test/tournaments/winter-slam": "<title>Winter Slam | Otter Events</title><p>January 9, 2027</p><p>Elm Falls, NJ</p>" + FOOT,
    "https://otter.test/about": "<p>Call (201) 555-0123</p>",
    "https://otter.test/sponsors": "<p>Vendors and sponsors: write to booths@otter.test</p>",
    "https://otter.test/news/event-recap": "<h1>Old Cup</h1><p>December 1, 2026</p>",
    "https://stale.test": "<a href='/events'>Events</a>",
    "https://stale.test/events": "<div><h3>Granite Shootout</h3><p>October 3, 2025</p><a href='/events/granite-shootout'>Details</a></div>",
    "https://stale.test/events/granite-shootout": "<h1>Granite Shootout</h1><p>October 10, 2026</p>",
    "https://empty.test/": None,
    "https://mill.test/": "<script type='application/ld+json'>{\"@type\":\"SportsEvent\",\"name\":\"Mill Bash\",\"startDate\":\"2026-12-05\",\"location\":{\"name\":\"Mill Arena\",\"address\":{\"addressLocality\":\"Dover\",\"addressRegion\":\"DE\"}}}</script>",
}
SITES = [("Otter Events", "https://otter.test", True), ("Stale Org", "https://stale.test/", False), ("Empty Org", "https://empty.test/", None), ("Gone Org", "https://gone.test/", True), ("Mill Org", "https://mill.test", False)]


@pytest.fixture(scope="module")
def crawled(spark):
    sites = spark.createDataFrame(SITES, "organizer string, home string, qualifies boolean")
    pages = spark.createDataFrame([*PAGES.items(), ("https://otter.test/about/", "<p>a copy</p>")], "url string, html string")
    return [df.collect() for df in site_walk.crawl(sites, pages, "2026-09-01")]


def test_pages_are_visited_by_role(crawled):
    visits, _, _ = crawled
    got = {(r.key.removeprefix("https://"), r.role, r.round) for r in visits}
    assert got == {
        ("otter.test", "home", 0), ("otter.test/tournaments", "event", 1), ("otter.test/about", "contact", 1), ("otter.test/sponsors", "vendor", 1),
        ("otter.test/tournaments/harvest-cup", "child", 2), ("otter.test/tournaments/winter-slam", "child", 2),
        ("stale.test", "home", 0), ("stale.test/events", "event", 1), ("stale.test/events/granite-shootout", "child", 2), ("empty.test", "home", 0), ("mill.test", "home", 0),
    }


def test_events_are_merged_and_placed(crawled):
    _, events, _ = crawled
    got = {r.name: r for r in events}
    assert {n: (r.organizer, r.start, r.end) for n, r in got.items()} == {
        "Harvest Cup": ("Otter Events", D(2026, 11, 7), D(2026, 11, 8)),
        "Pine Classic": ("Otter Events", D(2026, 11, 14), D(2026, 11, 14)),
        "Winter Slam": ("Otter Events", D(2027, 1, 9), D(2027, 1, 9)),
        "Granite Shootout": ("Stale Org", D(2026, 10, 10), D(2026, 10, 10)),
        "Mill Bash": ("Mill Org", D(2026, 12, 5), D(2026, 12, 5)),
    }
    cup = got["Harvest Cup"]
    assert (cup.venue, cup.city_states, cup.gender, cup.page) == ("Oak Park", ["Elm Falls, NJ"], "boys", "https://otter.test/tournaments/harvest-cup") and int(cup.teams) == 48
    # The office in the footer is no event's town.
    assert got["Pine Classic"].city_states == ["Salem, MA"] and got["Winter Slam"].city_states == ["Elm Falls, NJ"]
    assert (got["Mill Bash"].venue, got["Mill Bash"].city_states) == ("Mill Arena", ["Dover, DE"])


def test_contacts_prefer_the_home_page_and_the_own_domain(crawled):
    got = {r.organizer: r for r in crawled[2]}
    otter = got["Otter Events"]
    assert (otter.main_email, otter.main_phone, otter.vendor_email, otter.vendor_page) == ("info@otter.test", "(201) 555-0123", "booths@otter.test", "https://otter.test/sponsors")
    assert set(got) == {"Otter Events", "Stale Org", "Empty Org", "Mill Org"} and got["Stale Org"].vendor_email is None


def test_the_walk_is_that_of_a_plain_loop(spark):
    """A web of pages with many links of each kind, against a queue over dictionaries."""
    import random

    rng = random.Random(4)
    pages, homes = {}, []
    for s in range(6):
        site = f"https://s{s}.test"
        homes.append((f"Org {s}", site, False))
        paths = [f"/events/e{i}" for i in range(4)] + [f"/showcase-{i}" for i in range(8)] + [f"/contact/{i}" for i in range(4)] + [f"/vendors/{i}" for i in range(3)] + [f"/showcase-{i}/day{j}" for i in range(8) for j in range(3)] + ["/schedule?y=1"]
        for p in ["", *paths]:
            if p == "" or rng.random() < 0.8:
                pages[site + p] = [site + q for q in rng.sample(paths, rng.randrange(4, 20))]
    kinds = lambda u: "vendor" if "vendors" in u else "contact" if "contact" in u else "event"
    want = set()
    for org, home, _ in homes:
        seen = {home: ("home", 0)}
        out = list(dict.fromkeys(pages[home]))
        rank = lambda u: (u.split("?")[0].count("/") - 2, "?" in u, "showcase" not in u and "event" not in u, len(u), out.index(u))
        picked = [*[(u, "event") for u in sorted([u for u in out if kinds(u) == "event"], key=rank)[:6]], *[(u, "contact") for u in [u for u in out if kinds(u) == "contact"][:2]], *[(u, "vendor") for u in [u for u in out if kinds(u) == "vendor"][:1]]]
        for u, role in picked:
            if u in pages:
                seen.setdefault(u, (role, 1))
        for u, (role, turn) in [*seen.items()]:
            if role == "event" and turn == 1:
                base = u.split("?")[0] + "/"
                below = [v for v in dict.fromkeys(pages[u]) if v.startswith(base) and "/" not in v[len(base) :] and "?" not in v]
                for v in below[:15]:
                    if v in pages:
                        seen.setdefault(v, ("child", 2))
        want |= {(org, u, role, turn) for u, (role, turn) in seen.items()}
    table = spark.createDataFrame([(u, "".join(f"<a href='{v}'>x</a>" for v in out)) for u, out in pages.items()], "url string, html string")
    visits, _, _ = site_walk.crawl(spark.createDataFrame(homes, "organizer string, home string, qualifies boolean"), table, "2026-09-01")
    assert {tuple(r) for r in visits.collect()} == want


def test_nothing_landed(spark):
    sites = spark.createDataFrame(SITES, "organizer string, home string, qualifies boolean")
    pages = spark.createDataFrame([], "url string, html string")
    assert [df.count() for df in site_walk.crawl(sites, pages, "2026-09-01")] == [0, 0, 0]
