"""Pairs of editions are scored once for a pair of classes, on tables that hold copies of every edition."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from gatherline.operators import editions, report, settle
from gatherline.queries import ORACLES, QUERIES, matching
from gatherline.queries.base import listed_parts

PART = "/root/testdata/sf0.001/part.parquet"
COPIES = 4


@pytest.fixture(scope="module")
def copies(tmp_path_factory):
    root = tmp_path_factory.mktemp("copies")
    # Keys moved by 240 keep all that the editions are made of.
    duckdb.sql(f"COPY (SELECT t.* REPLACE (p_partkey + 240 * i AS p_partkey) FROM (SELECT * FROM '{PART}' WHERE p_partkey < 240) t, range({COPIES}) r(i)) TO '{root}/part.parquet'")
    return str(root)


@pytest.mark.parametrize("run", [editions.RUN, 3], ids=["whole", "runs"])
@pytest.mark.parametrize("name", ["sco_01_edition_score", "sco_02_pair_adjust", "sco_02_level_adjust"])
def test_copies_are_scored_once(spark, copies, monkeypatch, name, run):
    monkeypatch.setattr(editions, "RUN", run, raising=False)
    scored, plain = [], matching._scored
    monkeypatch.setattr(matching, "_scored", lambda *sides: scored.append(plain(*sides)) or scored[-1])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{copies}/part.parquet'")
    columns = sorted(c for c in QUERIES[name](spark, copies).columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]}) ORDER BY a, b").fetchall()
    got = [tuple(r) for r in QUERIES[name](spark, copies).select(*columns).orderBy("a", "b").collect()]
    assert got == want and got
    assert scored[-1].count() * COPIES**2 == len(got) if run > COPIES else scored[-1].count() < len(got)


def _numbered(spark, copies):
    return matching.edition_pairs(spark, copies).where("r.decision <> 'no_match'").withColumn("first", F.col("a") * 1_000_000_000 + F.col("b"))


def test_groups_of_copies(spark, copies, monkeypatch):
    p = _numbered(spark, copies)
    month = lambda c: F.concat_ws("|", F.col(f"{c}.organizer"), F.date_format(f"{c}.start", "yyyy-MM"))
    rows = p.select(month("x").alias("app_group"), month("x_r").alias("site_group"), F.col("a").alias("app"), F.col("b").alias("site"), "r.score", F.col("first").alias("tie"))
    want = report.assign_groups(rows).select("site", "app", "score").collect()
    assert 1 < len(want)
    monkeypatch.setattr(matching, "edition_pairs", None)  # pairs of rows are not made
    assert sorted(QUERIES["ded_11_assign_groups"](spark, copies).collect()) == sorted(want)


@pytest.mark.parametrize("whole", [settle.WHOLE, 4], ids=["components", "rounds"])
def test_assignment_of_copies(spark, copies, monkeypatch, whole):
    groups = editions.site_groups(listed_parts(spark, copies).where("ord % 2 = 1")).select(F.col("ord").alias("b"), "group_key")
    want = editions.assign_site_groups(_numbered(spark, copies).select("a", "b", "r.score", "first"), groups).select("a", "b", "score").collect()
    assert 1 < len(want)
    monkeypatch.setattr(settle, "WHOLE", whole)
    monkeypatch.setattr(matching, "edition_pairs", None)  # pairs of rows are not made
    assert sorted(QUERIES["ded_10_assign"](spark, copies).collect()) == sorted(want)
