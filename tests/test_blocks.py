"""Greedy passes settle whole blocks without making their pairs, also where rows repeat, do not fit themselves, or know no place."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gatherline.operators import linkage, report, settle
from gatherline.queries.base import events
from test_linkage import greedy, verdicts_of


@pytest.fixture
def crowd(spark):
    """One organiser's events in forty days: spans that end before they start, no places, other sexes, types and levels."""
    ev = events(spark, "/root/testdata/sf0.001").where("ord < 320").withColumns({"flags": F.array().cast("array<string>"), "organizer": F.lit("Org")})
    start = F.expr("DATE'2026-05-01' + CAST(customer % 40 AS INT)")
    return ev.withColumn("end_date", F.when(F.col("end_date").isNotNull(), F.date_add(start, F.datediff("end_date", "start_date")))).withColumn("start_date", F.when(F.col("start_date").isNotNull(), start)).cache()


def test_clusters_without_pairs(spark, crowd, monkeypatch):
    # Rows equal in FIELDS are one class also where they do not fit themselves: the plain pass is over classes.
    one = crowd.dropDuplicates(linkage.FIELDS)
    reasons = verdicts_of(one)
    rows = [{"ord": r.ord, "block": (str(r.start_date)[:7], r.sport or "lacrosse")} for r in one.orderBy("ord").collect()]
    want = greedy(rows, lambda a, b: reasons[a, b])
    assert 1 < len(set(want.values())) < len(want)
    monkeypatch.setattr(linkage, "matching_pairs", None)  # no pairs are made
    assert {r.ord: r.cluster for r in linkage.cluster(one).collect()} == want


@pytest.mark.parametrize("across", [False, True])
def test_blocks_equal_pairs(spark, crowd, monkeypatch, across):
    whole = {r.ord: r.cluster for r in linkage.cluster(crowd, across).collect()}
    plain = linkage.settled_blocks

    def few(*args):
        with monkeypatch.context() as m:
            m.setattr(settle, "WHOLE", 3)  # larger blocks go by pairs
            return plain(*args)

    monkeypatch.setattr(linkage, "settled_blocks", few)
    assert {r.ord: r.cluster for r in linkage.cluster(crowd, across).collect()} == whole


def _crowded(spark, rows, crowd):
    """Rows of few dates, so that blocks are large; states, sources and fillings are null or blank in turn."""
    return rows(crowd.withColumn("start_date", F.expr("DATE'2026-05-01' + CAST(customer % 4 AS INT)")))


def test_cross_organizer_without_pairs(spark, crowd, monkeypatch):
    make = lambda ev: ev.select(F.col("ord").alias("id"), F.nullif("collector", F.lit("")).alias("source"), F.lit("Org").alias("organizer"), "name", F.col("start_date").alias("start"), F.lit(None).cast("date").alias("end"), "state", F.expr("nullif(ord % 5, 3)").alias("filled"))
    rows = _crowded(spark, make, crowd).localCheckpoint()
    pairs = report.cross_organizer_pairs(rows).select("a", "b", "loser").collect()
    lost: set = set()
    for a, b, loser in sorted(pairs):
        if a not in lost and b not in lost:
            lost.add(loser)
    assert 1 < len(lost) < rows.count()
    with monkeypatch.context() as m:
        m.setattr(report, "cross_organizer_pairs", None)  # no pairs are made
        assert {r.id for r in report.cross_organizer_duplicates(rows).collect()} == lost
    # An id that stands on two dates ties them together: those go by pairs.
    twice = rows.unionByName(rows.where("id = 5").withColumn("start", F.date_add("start", 1)))
    tied: set = set()
    for a, b, loser in sorted(report.cross_organizer_pairs(twice).select("a", "b", "loser").collect()):
        if a not in tied and b not in tied:
            tied.add(loser)
    assert {r.id for r in report.cross_organizer_duplicates(twice).collect()} == tied


def test_same_page_without_pairs(spark, crowd, monkeypatch):
    make = lambda ev: ev.where("name <> ''").select(F.col("ord").alias("id"), F.expr("nullif('Org', CASE WHEN ord % 40 = 0 THEN 'Org' END)").alias("organizer"), F.expr("nullif(CAST(customer % 9 AS STRING), '4')").alias("page"), "name", F.col("start_date").alias("start"), F.col("end_date").alias("end"), "venue", "city")
    rows = _crowded(spark, make, crowd).localCheckpoint()
    by_pairs, plain = [], report._page_pairs
    with monkeypatch.context() as m:
        m.setattr(settle, "WHOLE", 2)
        m.setattr(report, "_page_pairs", lambda large: by_pairs.append(1) or plain(large))
        m.setattr(report, "leaders", lambda nodes, pairs, scratch: spark.createDataFrame(_follow(nodes, pairs), "ord long, leader long"))
        want = sorted(report.same_page_merge(rows, ["venue"]).collect(), key=str)
    monkeypatch.setattr(report, "_page_pairs", None)  # no pairs are made
    assert by_pairs and sorted(report.same_page_merge(rows, ["venue"]).collect(), key=str) == want and 1 < len(want) < rows.count()


def _follow(nodes, pairs):
    pairs = {(r.a, r.b) for r in pairs.collect()}
    return list(greedy([{"ord": r.ord, "block": 0} for r in nodes.orderBy("ord").collect()], lambda a, b: (a, b) in pairs).items())
