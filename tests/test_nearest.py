"""Best links, nearest rows and nearest places against plain loops; copies add no pairs."""

from __future__ import annotations

import math
import random

import duckdb
from pyspark.sql import functions as F

from gatherline.operators import nearby, rollups


def joined_rows(df) -> int:
    """Rows that the joins of a plan made when it ran."""
    rows, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        if name.endswith("Join") and node.metrics().contains("numOutputRows"):
            rows += node.metrics().apply("numOutputRows").value()
        todo.extend(node.children().apply(i) for i in range(node.children().size()))
    return rows


def test_best_links_of_copies(spark, tmp_path):
    from gatherline.queries import QUERIES

    names = ["red ring", "ring red", "red old bolt", "old bolt", "blue nut", None]
    rows = [(k, names[k // 2 % 6], "B1" if k % 10 else "B2") for k in range(3000)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    out = QUERIES["joi_08_best_link"](spark, str(tmp_path))
    got = {r.a: r.link for r in out.collect()}
    want = {}
    odd = [(k, set((n or "").split()), b) for k, n, b in rows if k % 2]
    best: dict = {}
    for a, n, brand in rows:
        words = frozenset((n or "").split())
        if a % 2 or not words:
            continue
        if (words, brand) not in best:
            hits = [(-len(words & w) / len(words), b) for b, w, br in odd if br == brand and len(words & w) / len(words) >= 0.6]
            best[words, brand] = min(hits)[1] if hits else None
        if best[words, brand] is not None:
            want[a] = best[words, brand]
    assert got == want and joined_rows(out) < 10 * len(rows)


def test_nearest_other_equals_all_pairs(spark):
    rng = random.Random(7)
    rows = [(k, rng.choice("xyz"), rng.randint(1, 9), float(rng.randint(1, 3))) for k in range(300)] + [(900, "lone", 1, 1.0)]
    out = rollups.nearest_other(spark.createDataFrame(rows, "id long, g string, size int, price double"), ["g"], "id", "size", -F.col("price"))
    want = {a: min((abs(s - s2), -p2, b) for b, g2, s2, p2 in rows if g2 == g and b != a)[2] for a, g, s, _ in rows if g != "lone"}
    assert {r.a: r.b for r in out.collect()} == want and joined_rows(out) < 5 * len(rows)


def test_nearest_km_equals_all_pairs(spark):
    rng = random.Random(5)
    place = lambda: (rng.uniform(-89, 89), rng.choice([rng.uniform(-180, 180), 179.9, -179.9, rng.uniform(20, 21)]))
    left = [(k, k % 3, *place()) for k in range(300)] + [(999, 7, 0.0, 0.0)]
    right = [(k % 2, *place()) for k in range(200)] + [(2, 80.0, 10.0)]
    out = nearby.nearest_km(spark.createDataFrame(left, "id long, n int, lat double, lng double"), spark.createDataFrame(right, "n int, lat double, lng double"), "n")

    def far(a, b, c, d):
        r = math.pi / 180
        h = math.sin((c - a) * r / 2) ** 2 + math.cos(a * r) * math.cos(c * r) * math.sin((d - b) * r / 2) ** 2
        return 12742 * math.asin(math.sqrt(h))

    got = {r.id: r.km for r in out.collect()}
    want = {k: min(far(a, b, c, d) for m, c, d in right if m == n) for k, n, a, b in left if n != 7}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_copies_of_editions_add_no_pairs(spark, tmp_path):
    from gatherline.queries import ORACLES, QUERIES

    rows = [(k + 240 * i, f"{'red' if k % 3 else 'blue'} ring", "B", 1 + k % 5) for k in range(24) for i in range(40)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS FROM '{tmp_path}/part.parquet/*.parquet'")
    for name in ("ded_03_best_edition", "ded_18_annotate"):
        out = QUERIES[name](spark, str(tmp_path))
        got = sorted(tuple(r) for r in out.collect())
        assert got and got == sorted(con.execute(ORACLES[name]).fetchall()) and joined_rows(out) < 10 * len(rows)
