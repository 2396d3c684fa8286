"""Pairs of one event-site are made in whole units inside tasks, also where blocks are cut into days and shards."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gatherline.operators import linkage
from test_blocks import crowd  # noqa: F401


@pytest.mark.parametrize("across", [False, True])
def test_pairs_of_cut_blocks(spark, crowd, monkeypatch, across):  # noqa: F811
    rows = linkage.prepare(crowd.where("ord < 160").dropDuplicates(linkage.FIELDS)).where("start_date IS NOT NULL").cache()
    x = rows.select(F.struct(*linkage.READ).alias("r"))
    month = lambda s: F.date_trunc("month", f"{s}.start_date")
    both = x.select(F.col("r").alias("a")).join(x.select(F.col("r").alias("b")), (F.col("a.ord") < F.col("b.ord")) & (F.lit(across) | (month("a") == month("b"))))
    judged = both.select(F.col("a.ord").alias("a"), F.col("b.ord").alias("b"), linkage.verdict("a", "b").alias("reason"))
    want = sorted(map(tuple, judged.where(linkage.is_match(F.col("reason"))).collect()))
    assert {r for *_, r in want} == set(linkage.REASONS)
    monkeypatch.setattr(linkage, "verdict", None)  # no pair is judged by itself
    for unit in (linkage.UNIT, 12):
        monkeypatch.setattr(linkage, "UNIT", unit)
        assert sorted(map(tuple, linkage.matching_pairs(rows, across).select("a", "b", "reason").collect())) == want


def test_pairs_are_given_out_in_strides(spark, crowd, monkeypatch):  # noqa: F811
    zero = F.lit(0)
    rows = linkage._alike(linkage.prepare(crowd), False).select("*", zero.alias("day"), zero.alias("xs"), zero.alias("ys"), F.lit(True).alias("x"), F.lit(True).alias("y")).toPandas()
    told = lambda frames: sorted(zip(*(sum((f[c].tolist() for f in frames), []) for c in ("a", "b", "code"))))
    (whole,) = linkage._unit_pairs(iter([rows]))
    monkeypatch.setattr(linkage, "STRIDE", 50)
    parts = list(linkage._unit_pairs(iter([rows[:100], rows[:0], rows[100:]])))
    assert told(parts) == told([whole]) and len(parts) > 5 and max(map(len, parts)) <= 320
    assert list(linkage._unit_pairs(iter([rows[:0]]))) == []
