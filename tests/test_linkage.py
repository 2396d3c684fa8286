from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gatherline.operators import cleanse, editions, linkage, settle
from gatherline.plans.scratch import Scratch
from gatherline.queries.base import events

D = dt.date
SCHEMA = "ord long, sport string, organizer string, name string, start_date date, end_date date, venue string, city string, state string, gender string, event_type string, source_type string, collector string, fingerprint string, team_count string, flags array<string>"


def row(ord, name="Otter Cup", organizer="Org", start=D(2026, 5, 2), end=None, venue="Otter Park", city=None, state="NJ", gender=None, kind=None, source="organizer_site", sport=None, teams=None, flags=()):
    return (ord, sport, organizer, name, start, end, venue, city, state, gender, kind, source, None, f"f{ord}", teams, list(flags))


def verdicts(spark, rows):
    df = linkage.prepare(spark.createDataFrame(rows, SCHEMA))
    one = df.select("ord", F.struct(*df.columns).alias("x"))
    two = one.select(F.col("ord").alias("ord2"), F.col("x").alias("y"))
    return {(r.ord, r.ord2): r.v for r in one.join(two, F.col("ord") < F.col("ord2")).select("ord", "ord2", linkage.verdict("x", "y").alias("v")).collect()}


def test_verdict_reasons(spark):
    base = row(0)
    cases = {
        "different_sport": row(1, sport="soccer"),
        "different_organizer": row(1, organizer="Other"),
        "dates_disjoint": row(1, start=D(2026, 5, 4)),
        "different_state": row(1, state="PA"),
        "venue_match": row(1, venue="Otter Sports Complex", start=D(2026, 5, 3)),
        "multi_site_distinct_venue": row(1, venue="Elm Park"),
        "venue_match_but_different_level": row(1, name="Otter Cup HS"),
        "venue_match_but_different_event": row(1, name="Lucky Draw"),
    }
    for want, other in cases.items():
        assert verdicts(spark, [base, other]) == {(0, 1): want}
    boys, girls = row(0, gender="boys"), row(1, gender="girls")
    assert verdicts(spark, [boys, girls])[0, 1] == "different_gender"
    assert verdicts(spark, [row(0, kind="camp"), row(1, kind="league")])[0, 1] == "venue_match_but_different_event_type"
    assert verdicts(spark, [row(0, venue="TBD", city="Oakville"), row(1, city="North Oakville")])[0, 1] == "city_match_venue_unknown"
    assert verdicts(spark, [row(0, venue=None, city="Oakville"), row(1, city="Elm")])[0, 1] == "different_city"
    assert verdicts(spark, [row(0, venue=None), row(1)])[0, 1] == "name_match_no_location"
    assert verdicts(spark, [row(0, venue=None, name="Cup"), row(1, name="Bash")])[0, 1] == "no_location_no_name_match"
    assert verdicts(spark, [row(0, start=None), row(1)])[0, 1] == "dates_disjoint"


def greedy(rows, same) -> dict:
    """Plain leader clustering in arrival order within month blocks."""
    blocks = defaultdict(list)
    for r in rows:
        blocks[r["block"]].append(r)
    out = {}
    for block in blocks.values():
        leads = []
        for r in block:
            for lead in leads:
                if same(lead["ord"], r["ord"]):
                    out[r["ord"]] = lead["ord"]
                    break
            else:
                leads.append(r)
                out[r["ord"]] = r["ord"]
    return out


@pytest.fixture(params=[settle.WHOLE, 4], ids=["components", "rounds"])
def way(request, monkeypatch):
    """Components settled whole in tasks, or, where they may hold four pairs only, worn down by rounds."""
    monkeypatch.setattr(settle, "WHOLE", request.param)


@pytest.mark.parametrize("seed", [1, 2])
def test_leaders_equal_a_greedy_pass(spark, seed, way):
    rng = random.Random(seed)
    n = 120
    pairs = {(a, b) for _ in range(260) for a, b in [sorted(rng.sample(range(n), 2))]} | {(i, i + 1) for i in range(60, 100)}
    got = linkage.leaders(spark.range(n).withColumnRenamed("id", "ord"), spark.createDataFrame(sorted(pairs), "a long, b long"), Scratch(spark, "test"))
    want = greedy([{"ord": i, "block": 0} for i in range(n)], lambda a, b: (a, b) in pairs)
    assert {r.ord: r.leader for r in got.collect()} == want and got.count() == n


def test_chain_is_not_a_component(spark):
    # A~B~C but not A~C: the third row opens its own cluster.
    rows = [row(0, start=D(2026, 5, 2)), row(1, start=D(2026, 5, 3)), row(2, start=D(2026, 5, 4))]
    got = {r.ord: r.cluster for r in linkage.cluster(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {0: 0, 1: 0, 2: 2}


def test_month_blocks_split_and_can_be_joined(spark):
    df = spark.createDataFrame([row(0, start=D(2026, 10, 31)), row(1, start=D(2026, 11, 1))], SCHEMA)
    assert {r.ord: r.cluster for r in linkage.cluster(df).collect()} == {0: 0, 1: 1}
    assert {r.ord: r.cluster for r in linkage.cluster(df, across_months=True).collect()} == {0: 0, 1: 0}


def test_clusters_of_derived_events_equal_a_greedy_pass(spark, way):
    ev = events(spark, "/root/testdata/sf0.001").withColumns({"flags": F.array().cast("array<string>"), "organizer": F.lit("Org"), "state": F.lit("NJ")})
    ev = ev.withColumn("start_date", F.when(F.col("start_date").isNotNull(), F.expr("DATE'2026-05-01' + CAST(customer % 40 AS INT)"))).withColumn("end_date", F.date_add("start_date", (F.col("ord") % 3).cast("int"))).where("ord < 260").cache()
    got = {r.ord: r.cluster for r in linkage.cluster(ev).collect()}
    reasons = verdicts_of(ev)
    rows = [{"ord": r.ord, "block": str(r.start_date)[:7]} for r in ev.orderBy("ord").collect()]
    assert got == greedy(rows, lambda a, b: reasons[a, b])


def verdicts_of(df):
    p = linkage.prepare(df)
    one = p.select("ord", F.struct(*p.columns).alias("x"))
    two = one.select(F.col("ord").alias("o2"), F.col("x").alias("y"))
    return {(r.ord, r.o2): r.ok for r in one.join(two, F.col("ord") < F.col("o2")).select("ord", "o2", linkage.is_match(linkage.verdict("x", "y")).alias("ok")).collect()}


def test_merge_prefers_the_organizers_site(spark):
    rows = [row(0, source="tourney_machine", teams="48", venue="", flags=["b"]), row(1, source="organizer_site", teams="", venue="Otter Park", flags=["a"], start=D(2026, 5, 1)), row(2, source=None, teams="50", end=D(2026, 5, 4))]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("cluster", F.lit(0))
    (m,) = linkage.merge(df).collect()
    assert (m.venue, m.team_count, m.start_date, m.end_date, m.flags, m.source_count, m.team_count_variants) == ("Otter Park", "48", D(2026, 5, 1), D(2026, 5, 4), ["a", "b", "corroborated"], 3, ["48", "50"])


def test_sources_that_disagree_on_sites(spark):
    rows = [("g", "x", "elm"), ("g", "x", "oak"), ("g", "y", "elm"), ("h", "x", "elm"), ("h", "y", "elm"), ("i", "x", None)]
    got = {(r.event_group, r.source): (r.sites, r.missing, r.mismatch) for r in linkage.site_sets(spark.createDataFrame(rows, "event_group string, source string, site string")).collect()}
    assert got["g", "y"] == (["elm"], ["oak"], True) and got["g", "x"] == (["elm", "oak"], [], True)
    assert got["h", "x"][2] is False and got["i", "x"] == (["(unspecified)"], [], False)


EDITION = "ord long, name string, start date, state string, organizer string, sites array<string>, points array<struct<lat:double,lng:double>>, teams int, gender string, name_series int"


def edition(name, start, state, point=None, org=None, sites=(), teams=None, gender=None, series=1):
    return (name, dt.date.fromisoformat(start), state, org, list(sites), [point] if point else [], teams, gender, series)


EDITIONS = [
    (edition("Otter Brawl 2025", "2026-11-01", "MD", (39.0, -76.7), sites=["bb"], teams=87, series=3), edition("Otter Brawl – Site 2", "2026-11-08", "MD", (39.0, -76.7), org="Org", sites=["bb"]), {"confirmed", "review"}),
    (edition("PT Fall Challenge - 2025", "2026-10-17", "CT", (41.24, -73.52), sites=["pt"]), edition("Prime Time Fall Challenge", "2026-10-17", "CT", (41.24, -73.52), org="PT", sites=["pt"]), {"confirmed"}),
    (edition("2025 Iron Lake Fall Cup", "2026-11-07", "NY", (40.8, -73.2), sites=["il"]), edition("Iron Lake Youth Fall Cup", "2026-11-14", "NY", (40.8, -73.2), org="Org", sites=["il"]), {"confirmed"}),
    (edition("Harvestfest 2025", "2026-10-24", "NY", (40.7, -73.6), sites=["mf"], teams=93, gender="boys"), edition("Harvestfest", "2026-10-31", "NY", (40.7, -73.6), org="Org", sites=["mf"], gender="boys"), {"confirmed"}),
    (edition("OTTER GIRLS SOPHOMORE SELECT 2025", "2026-11-01", "NJ", (40.5, -74.6), sites=["ip"]), edition("Boys Sophomore Select", "2026-10-17", "NJ", (40.5, -74.6), org="Org", sites=["ip"]), {"no_match"}),
    (edition("Town Turkey Shootout", "2026-11-21", "VA", (37.4, -77.6), sites=["rc"]), edition("Fall Classic – Site 1", "2026-11-21", "VA", (37.4, -77.6), org="Org", sites=["rc"]), {"no_match"}),
    (edition("Snow Bear League Elmville - Boys", "2026-12-06", "NC", (35.1, -80.7), sites=["m"]), edition("2026 Elmville Fall Classic", "2026-10-24", "NC", (35.1, -80.7), org="Org", sites=["m"]), {"no_match"}),
    (edition("Fall Brawl 2025", "2026-11-01", "MD", (39.0, -76.7), series=3), edition("2025 Fall Brawl", "2026-10-04", "NY", (42.9, -77.3), series=3), {"no_match"}),
]


def test_edition_decisions(spark):
    rows = []
    for i, (a, b, _) in enumerate(EDITIONS):
        rows += [(2 * i, *a), (2 * i + 1, *b)]
    e = editions.prepare(spark.createDataFrame(rows, EDITION))
    x = e.where("ord % 2 = 0").select((F.col("ord") / 2).cast("int").alias("i"), F.struct(*e.columns).alias("x"))
    y = e.where("ord % 2 = 1").select(((F.col("ord") - 1) / 2).cast("int").alias("i"), F.struct(*e.columns).alias("y"))
    got = {r.i: r.r for r in x.join(y, "i").select("i", editions.edition_score("x", "y").alias("r")).collect()}
    for i, (a, b, allowed) in enumerate(EDITIONS):
        assert got[i].decision in allowed, (a[0], b[0], got[i])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_assignment_equals_a_greedy_pass(spark, seed, way):
    rng = random.Random(seed)
    pairs = sorted({(rng.randrange(40), rng.randrange(40)) for _ in range(300)})
    rows = [(a, b, float(rng.randrange(6)), i) for i, (a, b) in enumerate(pairs)]
    got = {(r.a, r.b) for r in editions.assign(spark.createDataFrame(rows, "a long, b long, score double, n long"), "a", "b", "score", "n").collect()}
    want, left, right = set(), set(), set()
    for a, b, _, _ in sorted(rows, key=lambda r: (-r[2], r[3])):
        if a not in left and b not in right:
            want.add((a, b))
            left.add(a)
            right.add(b)
    assert got == want


def taken_in_order(rows):
    want, left, right = set(), set(), set()
    for a, b, _, _ in sorted(rows, key=lambda r: (-r[2], r[3])):
        if a not in left and b not in right:
            want.add((a, b))
            left.add(a)
            right.add(b)
    return want


PAIRS = "a long, b long, score double, n long"


def test_assignment_settles_a_block_of_equal_scores_whole(spark):
    # 1,200 x 1,100 pairs of one score, more than a task takes: one mutual pair a round, so over 1,000 rounds without the queues.
    one, other = spark.range(1200).withColumnRenamed("id", "a"), spark.range(1100).withColumnRenamed("id", "b")
    rows = one.crossJoin(other).selectExpr("a", "b", "7D AS score", "a * 1000000000 + b AS n")
    got = {(r.a, r.b) for r in editions.assign(rows, "a", "b", "score", "n").collect()}
    assert got == {(i, i) for i in range(1100)}


@pytest.mark.parametrize("seed", [1, 2])
def test_assignment_of_tied_blocks_equals_a_greedy_pass(spark, seed, way):
    # Blocks that share sides, three scores.
    rng = random.Random(seed)
    score = {(x, y): float(rng.randrange(3)) for x in range(4) for y in range(4) if rng.random() < 0.8}
    rows = [(a, b, score[a % 4, b % 4], a * 1000 + b) for a in range(60) for b in range(50) if (a % 4, b % 4) in score]
    got = {(r.a, r.b) for r in editions.assign(spark.createDataFrame(rows, PAIRS), "a", "b", "score", "n").collect()}
    assert got == taken_in_order(rows)


@pytest.mark.parametrize("n, whole", [(200_000, settle.WHOLE), (16, 4)])
def test_long_chains(spark, monkeypatch, n, whole):
    """Each pair waits for the one before it: a round for each link, unless the component is settled whole."""
    monkeypatch.setattr(settle, "WHOLE", whole)
    chain = spark.range(n).selectExpr("id DIV 2 AS a", "(id + 1) DIV 2 AS b", "1D AS score", "id AS n")
    got = editions.assign(chain, "a", "b", "score", "n")
    assert got.count() == n // 2 and got.where("a <> b").count() == 0
    pairs = spark.range(n - 1).selectExpr("id AS a", "id + 1 AS b")
    led = linkage.leaders(spark.range(n).withColumnRenamed("id", "ord"), pairs, Scratch(spark, "test"))
    assert led.count() == n and led.where("leader <> ord - ord % 2").count() == 0


def test_followers_of_known_leaders_are_no_component(spark, monkeypatch):
    """One leader with many followers is as many components as followers: nothing is left to rounds."""
    monkeypatch.setattr(settle, "WHOLE", 4)
    left = []
    monkeypatch.setattr(linkage, "settled", lambda *a: (out := settle.settled(*a), left.append(out[1].count()))[0])
    pairs = spark.range(1, 5_000).selectExpr("0L AS a", "id AS b")
    led = linkage.leaders(spark.range(5_000).withColumnRenamed("id", "ord"), pairs, Scratch(spark, "test"))
    assert led.where("leader <> 0").count() == 0 and led.count() == 5_000 and left == [0]


def test_components_are_those_of_a_plain_search(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(1_000, 1_300)]
    up = {i: i for e in edges for i in e}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in edges:
        up[root(a)] = root(b)
    got = {r.node: r.component for r in settle.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test"), "c").collect()}
    tied = {i for a, b in edges if a != b for i in (a, b)}
    assert set(got) == tied
    assert all((got[i] == got[j]) == (root(i) == root(j)) for i in tied for j in list(tied)[::7])


def test_no_pairs_reach_the_driver(spark, monkeypatch):
    """Whatever the passes collect is small, however many pairs there are."""
    seen = []
    for name in ("collect", "toArrow", "toPandas", "toLocalIterator"):
        kind = type(spark.range(1))
        real = getattr(kind, name)
        monkeypatch.setattr(kind, name, lambda self, *a, real=real, **k: (out := real(self, *a, **k), seen.append(len(out) if hasattr(out, "__len__") else 1_001))[0])
    rng = random.Random(1)
    pairs = spark.createDataFrame([(rng.randrange(3_000), 3_000 + rng.randrange(3_000), float(rng.randrange(9)), i) for i in range(6_000)], PAIRS)
    editions.assign(pairs, "a", "b", "score", "n").write.format("noop").mode("overwrite").save()
    linkage.leaders(spark.range(6_000).withColumnRenamed("id", "ord"), pairs, Scratch(spark, "test")).write.format("noop").mode("overwrite").save()
    assert all(n <= 1_000 for n in seen)


def test_assignment_of_nothing(spark):
    assert editions.assign(spark.createDataFrame([], "a long, b long, score double, n long"), "a", "b", "score", "n").count() == 0


def test_bucketed_join_equals_all_pairs(spark):
    rng = random.Random(4)
    rows = [(i, rng.randrange(3), D(2026, 1, 1) + dt.timedelta(rng.randrange(300))) for i in range(150)]
    df = spark.createDataFrame(rows, "i long, k int, d date")
    got = {(r.i, r.i_r) for r in editions.within_days(df, df, ["k"], "d", "d", 9).collect()}
    assert got == {(a[0], b[0]) for a in rows for b in rows if a[1] == b[1] and abs((a[2] - b[2]).days) <= 9}


def test_validation_and_keep_best(spark):
    schema = "ord long, name string, sport string, start_date date, end_date date, state string, gender string, fingerprint string, venue string, city string, age_range string, team_count string"
    rows = [
        (0, "ab", "s", D(2026, 1, 1), None, "NJ", "boys", "f", None, None, None, None),
        (1, "Cup", None, D(2026, 1, 1), None, "NJ", "boys", "f", None, None, None, None),
        (2, "Cup", "s", None, None, "NJ", "boys", "f", None, None, None, None),
        (3, "Cup", "s", D(2026, 1, 1), D(2025, 12, 30), "", "unknown", "f", "v", None, None, None),
        (4, "Cup", "s", D(2029, 1, 1), D(2029, 1, 20), "NJ", "boys", "f", "v", None, None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    got = {r.ord: (r.accepted, r.flags, r.end_date) for r in cleanse.validate(df, "2026-06-01").collect()}
    assert got[0][1] == ["no_name"] and got[1][1] == ["no_sport"] and got[2][1] == ["no_date"]
    assert got[3] == (True, ["stale_date:2026-01-01", "end_before_start", "no_state", "gender_unknown"], D(2026, 1, 1))
    assert got[4][1] == ["far_future", "long_span"]
    assert [r.ord for r in cleanse.keep_best(df, ["fingerprint"]).collect()] == [4]  # most filled fields, counting the state and the end


def test_site_groups_are_assigned_as_by_a_greedy_pass(spark, way):
    rng = random.Random(8)
    listings = [(b, f"g{rng.randrange(12)}") for b in range(40)]
    pairs = [(a, b, float(rng.randrange(4, 12)), a * 1000 + b) for a in range(20) for b in range(40) if rng.random() < 0.3]
    group, best = dict(listings), {}
    for a, b, score, _ in pairs:
        if (a, group[b]) not in best or score > best[a, group[b]][1]:
            best[a, group[b]] = (b, score)
    want, used = set(), (set(), set())
    for (a, g), (b, score) in sorted(best.items(), key=lambda x: -x[1][1]):
        if a not in used[0] and g not in used[1]:
            used[0].add(a)
            used[1].add(g)
            want.add((a, g, b, score))
    got = editions.assign_site_groups(spark.createDataFrame(pairs, "a long, b long, score double, first long"), spark.createDataFrame(listings, "b long, group_key string"))
    assert {tuple(r) for r in got.collect()} == want


@pytest.mark.parametrize("across", [False, True])
def test_matching_pairs_are_all_pairs_that_fit_each_once(spark, across):
    """Random rows near a month's end against the verdict over all pairs of them."""
    rng, rows = random.Random(8), []
    for i in range(90):
        start = rng.choice([None, D(2026, 10, 29) + dt.timedelta(days=rng.randrange(6))])
        rows.append((i, "lacrosse", rng.choice(["Pin", "Elm"]), start, start and start + dt.timedelta(days=rng.randrange(3)), rng.choice(["NJ", "PA", ""]), "boys", rng.choice(["Oak Hill Park", "Oak Hill", "Elm Hill Oak", "", None]), "Oakville", rng.choice(["Otter Cup", "Otter Bash"]), "tournament"))
    schema = "ord long, sport string, organizer string, start_date date, end_date date, state string, gender string, venue string, city string, name string, event_type string"
    rows = linkage.prepare(spark.createDataFrame(rows, schema))
    x = rows.where("start_date IS NOT NULL").select("ord", "start_date", F.struct(*linkage.READ).alias("r"))
    month = lambda s: F.date_trunc("month", f"{s}.start_date")
    both = x.alias("a").join(x.alias("b"), (F.col("a.ord") < F.col("b.ord")) & (F.lit(across) | (month("a") == month("b"))))
    want = both.select(F.col("a.ord").alias("a"), F.col("b.ord").alias("b"), linkage.verdict("a.r", "b.r").alias("reason")).where(linkage.is_match(F.col("reason")))
    got = linkage.matching_pairs(rows, across_months=across)
    assert sorted(map(tuple, got.select("a", "b", "reason").collect())) == sorted(map(tuple, want.collect())) != []
