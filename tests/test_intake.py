from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from gatherline.operators import gate, rollups, scores
from gatherline.sources import landed, sinks
from gatherline.streaming import flows


def test_json_lines_and_quarantine(spark, tmp_path):
    (tmp_path / "R1.jsonl").write_text('{"id": 1, "name": "a"}\n{broken\n\n')
    (tmp_path / "R2.jsonl").write_text('{"id": 2, "name": null, "extra": 5}\n')
    good, bad = landed.json_lines(spark, f"{tmp_path}/R*.jsonl", "id long, name string")
    assert {(r.id, r.name) for r in good.collect()} == {(1, "a"), (2, None)} and [r.value for r in bad.collect()] == ["{broken"]


def test_seed_sites(spark, tmp_path):
    (tmp_path / "seed.json").write_text(json.dumps({"_note": "x", "A": "https://a.test", "B": {"website": "https://b.test", "pages": ["https://b.test/e", "ftp://no"]}, "C": "none"}))
    got = {r.name: (r.website, r.pages) for r in landed.seed_sites(spark, f"{tmp_path}/seed.json").collect()}
    assert got == {"A": ("https://a.test", []), "B": ("https://b.test", ["https://b.test/e"])}


def test_last_known_values_and_replay(spark):
    rows = spark.createDataFrame([("k", "a", True, 1), ("k", None, False, 2), ("j", "b", None, 3)], "key string, v string, w boolean, ord long")
    got = {r.key: (r.v, r.w) for r in sinks.last_known(rows, "key").collect()}
    assert got == {"k": ("a", False), "j": ("b", None)}  # an explicit false overwrites, a null does not
    stored = spark.createDataFrame([("k", "old", True, 7), ("z", "z", True, 8)], "key string, v string, w boolean, other int")
    once = sinks.upsert(stored, rows, "key")
    assert sorted(once.collect(), key=str) == sorted(sinks.upsert(once, rows, "key").collect(), key=str)
    assert {r.key: (r.v, r.w, r.other) for r in once.collect()} == {"k": ("a", False, 7), "z": ("z", True, 8), "j": ("b", None, None)}


def test_partial_updates_set_no_defaults(spark):
    stored = spark.createDataFrame([("k", "a", 1), ("j", "b", 2)], "key string, v string, n int")
    out = sinks.update_fields(stored, spark.createDataFrame([("k", None), ("new", 5)], "key string, n int"), "key")
    assert {tuple(r) for r in out.collect()} == {("k", "a", 1), ("j", "b", 2)}


def test_gate_is_three_valued(spark):
    rows = [(1, 40, 2, "soccer", ["A, MA"], dt.date(2026, 7, 1)), (2, 40, None, None, ["A, MA"], dt.date(2026, 7, 1)), (3, 40, 2, "soccer", ["A, MA"], None), (4, 5, 2, None, ["A, MA"], None), (5, 40, 2, "soccer", [], dt.date(2026, 7, 1)), (6, 40, 2, "soccer", ["A, TX", "B, NH"], dt.date(2026, 7, 1)), (7, 40, 2, "soccer", ["A, MA"], dt.date(2026, 5, 1))]
    df = spark.createDataFrame(rows, "id int, team_count int, days int, sport string, city_states array<string>, start_date date").withColumn("sent_at", F.lit(None).cast("timestamp"))
    out = gate.gate(df, gate.default_rules(spark), "2026-06-01")
    assert {r.id: r.gate_passed for r in out.collect()} == {1: True, 2: None, 3: None, 4: False, 5: False, 6: True, 7: False}
    assert {r.id for r in gate.queue(out).collect()} == {1, 6}


def test_schedule_profile_and_quality(spark):
    def game(event, day, minute, field):
        return (event, dt.date(2026, 5, day), minute, "site", field)

    full = [game("two", d, m, f) for d in (2, 3) for f in ("a", "b") for m in range(480, 1020, 60)]
    early = [game("early", 2, m, f) for f in ("a", "b") for m in range(480, 1020, 60)] + [game("early", 3, m, "a") for m in (480, 540)]
    lone = [game("lone", 2, 600, "a")]
    g = spark.createDataFrame(full + early + lone, "event string, date date, minute int, site string, field string")
    assert {r.event: r.game_length for r in scores.game_length(g, ["event"]).collect()} == {"two": 60, "early": 60, "lone": 60}
    days = scores.schedule_days(g, ["event"])
    got = {r.event: r for r in scores.schedule_quality(days.where("site IS NULL"), ["event"]).collect()}
    assert (got["two"].schedule_quality, got["two"].last_day_end, got["two"].full_day_all_days) == (100, "17:00", True)
    assert got["early"].schedule_quality < 40 and got["early"].last_day_late_field_share == 0.0
    assert (got["lone"].day_count, got["lone"].day1_hours, got["lone"].schedule_quality) == (1, 1.0, 31)


def test_weather_arrays_and_json_ld(spark):
    series = spark.createDataFrame([("p", ["2026-05-01", "bad"], [1.0, 2.0])], "place string, time array<string>, rain_mm array<double>")
    assert {(r.day, r.rain_mm) for r in landed.weather_rows(series).collect()} == {(dt.date(2026, 5, 1), 1.0), (None, 2.0)}
    ld = json.dumps([{"@type": ["Event"], "name": "A  Cup", "startDate": "2026-05-02T10:00"}, {"itemListElement": [{"item": {"@type": "Festival", "name": "B", "startDate": "nope", "endDate": "2026-05-03"}}]}])
    pages = spark.createDataFrame([(1, f'<script type="application/ld+json">{ld}</script>'), (2, "<p>none</p>")], "page_id long, html string")
    got = {(r.name, r.start_date, r.end_date) for r in landed.json_ld_events(pages).collect()}
    assert got == {("A Cup", dt.date(2026, 5, 2), dt.date(2026, 5, 2)), ("B", None, dt.date(2026, 5, 3))}


def test_partial_scrapes_retire_nothing(spark):
    shown = spark.createDataFrame([("a", f"e{i}") for i in range(4)] + [("b", f"e{i}") for i in range(20)], "source string, event string")
    scraped = spark.createDataFrame([("a", "e0")] + [("b", f"e{i}") for i in range(18)], "source string, event string")
    assert {(r.source, r.event): r.gone for r in rollups.retire(shown, scraped).collect()} == {("a", "e1"): False, ("a", "e2"): False, ("a", "e3"): False, ("b", "e18"): True, ("b", "e19"): True}


def test_shards_deal_all_rows_once(spark):
    df = spark.range(101).withColumn("id", F.col("id") * 3)
    parts = [[r.id for r in rollups.shard(df, "id", i, 4).collect()] for i in (1, 2, 3, 4)]
    assert sorted(sum(parts, [])) == [3 * i for i in range(101)] and sorted(parts[1]) == [3 * i for i in range(1, 101, 4)]


def test_streamed_windows_equal_the_table(spark, tmp_path):
    table = spark.createDataFrame([(dt.datetime(2026, 5, 1, h, 10 * m), "x", float(h)) for h in range(6) for m in range(3)], "ts timestamp, kind string, value double")
    table.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(table.schema).parquet(f"{tmp_path}/in")
    query = flows.windowed_counts(stream, "ts", ["kind"], "2 hours", late="1 day").writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert sorted(spark.table("windows").collect()) == sorted(flows.windowed_counts(table, "ts", ["kind"], "2 hours").collect())


def test_streamed_upsert_is_idempotent(spark, tmp_path):
    rows = spark.createDataFrame([("k", "a"), ("j", "b")], "key string, v string")
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    flows.upsert_stream(stream, f"{tmp_path}/out", "key", f"{tmp_path}/c1").awaitTermination(60)
    spark.createDataFrame([("k", "new")], "key string, v string").write.mode("append").parquet(f"{tmp_path}/in")
    flows.upsert_stream(stream, f"{tmp_path}/out", "key", f"{tmp_path}/c1").awaitTermination(60)
    assert {tuple(r) for r in flows.current(spark, f"{tmp_path}/out").collect()} == {("k", "new"), ("j", "b")}


def test_a_batch_rewrites_its_own_buckets_only(spark, tmp_path):
    """Rows written follow the batch; a lost checkpoint replays all batches and keeps the rows; old files go."""
    from pathlib import Path

    table = spark.range(2_000).selectExpr("CAST(id AS STRING) AS key", "'old' AS v", "CAST(NULL AS STRING) AS w")
    table.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(table.schema).parquet(f"{tmp_path}/in")
    run = lambda c: flows.upsert_stream(stream, f"{tmp_path}/out", "key", f"{tmp_path}/{c}").awaitTermination(120)
    run("c1")
    spark.createDataFrame([("7", "new", None), ("9", None, "w")], "key string, v string, w string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run("c1")
    want = {(str(i), "new" if i == 7 else "old", "w" if i == 9 else None) for i in range(2_000)}
    assert {tuple(r) for r in flows.current(spark, f"{tmp_path}/out").select("key", "v", "w").collect()} == want
    written = spark.read.parquet(f"{tmp_path}/out/data/version=2").count()
    assert 2 <= written < 200  # two buckets of 64
    run("c2")  # another checkpoint: everything again
    assert {tuple(r) for r in flows.current(spark, f"{tmp_path}/out").select("key", "v", "w").collect()} == want
    assert len([*Path(f"{tmp_path}/out/manifest").glob("version=*")]) == 2
    # A version without its mark is no version.
    Path(f"{tmp_path}/out/manifest/version=99").mkdir()
    assert flows.current(spark, f"{tmp_path}/out").count() == 2_000
    assert flows.current(spark, f"{tmp_path}/none") is None


def test_ranked_links(spark):
    html = '<a href="/about">About</a><a href="/events/fall">Fall</a><a href="/events/fall">again</a><a href="?p=2">more</a><a href="mailto:x@mail.test">m</a>'
    got = [(r.rank, r.href, r.kind) for r in landed.ranked_links(spark.createDataFrame([(1, html)], "page_id long, html string")).orderBy("rank").collect()]
    assert got == [(1, "/events/fall", "event"), (2, "/about", "page"), (3, "?p=2", "query")]


def test_gaps_of_all_landed_ids(spark):
    ids = spark.range(5, 60_000).where("id NOT IN (7, 45000, 59998)")
    assert sorted(r.id for r in landed.gaps(ids, "id", 2).collect()) == [7, 45_000, 59_998, 60_000, 60_001]
    assert landed.gaps(ids.limit(0), "id", 2).count() == 0


def test_seed_of_many_lines(spark, tmp_path):
    rows = spark.range(1000).selectExpr("""to_json(map(concat(CASE WHEN id % 3 = 0 THEN '_' ELSE '' END, 'c', id), concat('https://', id, '.test'))) AS value""")
    rows.repartition(3).write.text(f"{tmp_path}/seed")
    got = {(r.name, r.website) for r in landed.seed_sites(spark, f"{tmp_path}/seed", lines=True).collect()}
    assert got == {(f"c{i}", f"https://{i}.test") for i in range(1000) if i % 3}


def test_ranked_links_of_a_long_page(spark):
    html = "".join(f'<a href="/events/{i}">Event {i}</a>' for i in range(1500))
    page = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert {r.href for r in landed.ranked_links(page).collect()} == {f"/events/{i}" for i in range(1500)}
    assert landed.ranked_links(page, 10).count() == 10


def test_document_hints(spark):
    rows = [
        (1, "hosted by the Otter Club Inc. mail Info@Otter.org, info@otter.org or x@gmail.com; http://www.otter.org/rules www.elm.org"),
        (2, "presented by Pine Valley Lacrosse"), (3, None), (4, ""), (5, "register at https://www.tourneymachine.com/x or www.events.leagueapps.com"), (6, "see www.b.org and www.a.org"), (7, "hosted by nobody in particular"),
    ]
    got = {(r.doc_id, r.rank): (r.domain, r.emails, r.addresses, r.hosted_by, r.confidence) for r in landed.document_hints(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS rank", "'y' AS domain")).collect()}
    assert got == {
        (1, 1): ("otter.org", ["info@otter.org"], 1, ["Otter Club Inc"], 0.6), (1, 2): ("elm.org", [], 1, ["Otter Club Inc"], 0.45),
        (2, 1): (None, [], 0, ["Pine Valley Lacrosse"], 0.4), (6, 1): ("a.org", [], 1, [], 0.45), (6, 2): ("b.org", [], 1, [], 0.45),
    }


def test_climatology_makes_days_once_and_broadcasts_none(spark):
    day = lambda n: dt.date(2024, 3, 1) + dt.timedelta(days=n)
    weather = spark.createDataFrame([(1, day(n), float(n % 4), 60.0 + n, 3600.0 * (n % 9), None) for n in range(60)], "place long, day date, rain_mm double, high_f double, sun_seconds double, radiation_mj double")
    events = spark.createDataFrame([("a", 1, day(10), day(11)), ("a", 1, day(30), day(31)), ("b", 1, day(10), None), ("c", 2, day(10), None)], "id string, place long, start date, end date")
    out = scores.climatology(weather, events, ["id"], 2024, 2024, 2)
    windows = {"a": (2, [*range(8, 14), *range(28, 34)]), "b": (1, [*range(8, 13)])}
    got = {r.id: r for r in out.collect()}
    assert set(got) == set(windows)
    for k, (span, days) in windows.items():
        p = sum(n % 4 > 2.5 for n in days) / len(days)
        assert got[k].sample_days == len(days) and got[k].p_rain_day == round(p, 2) and got[k].p_rain_event == round(1 - (1 - p) ** span, 2)
        assert got[k].expected_high_f == round(sum(60 + n for n in days) / len(days)) and got[k].uv_index_est is None
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("HashAggregate") > 2
