from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from gatherline.llm import veccodes

SCHEMA = "vec_id long, embedding array<double>, label int"
NAN = float("nan")


def by_hand(rows, rounds=6):
    """(vec_id, code, error, label_error) and the digest, in Python integers, every round over all parts anew."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1])
    cut = [i * width // 8 for i in range(9)]
    fit = [r for r in kept if len(r[1]) == width]
    books = [[r[1][cut[p] : cut[p + 1]] for r in kept[:16] if len(r[1]) == width] for p in range(8)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), e) for e, y in enumerate(book))
    for _ in range(rounds):
        for p in range(8):
            parts = defaultdict(list)
            for _, v, _ in fit:
                x = v[cut[p] : cut[p + 1]]
                parts[near(x, books[p])[1]].append(x)
            books[p] = [[sum(c) // len(c) for c in zip(*parts[e], strict=True)] if parts[e] else y for e, y in enumerate(books[p])]
    out, labels = [], defaultdict(int)
    for i, v, label in kept:
        found = [near(v[cut[p] : cut[p + 1]], books[p]) for p in range(8)] if len(v) == width else []
        error = sum(d for d, _ in found) if found else None
        error = error if error is not None and error < 1 << 63 else None
        labels[label] += error or 0
        out.append((i, "".join(f"{e:02x}" for _, e in found) if found else None, error, label))
    digest = hashlib.sha256(",".join(str(x) for book in books for y in book for x in y).encode()).hexdigest()
    return sorted(((i, c, e, labels[label] if labels[label] < 1 << 63 else None) for i, c, e, label in out), key=str), digest


def coded(df):
    rows = veccodes.report(df).collect()
    assert len({r.codebooks_sha256 for r in rows}) == 1
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in rows), key=str), rows[0].codebooks_sha256


def test_codes_are_those_of_plain_rounds(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert coded(table) == by_hand([(r.vec_id, r.embedding, r.label) for r in table.collect()])


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=24).round(2).tolist(), int(i % 3) if i % 5 else None) for i in range(3, 120)]
    rows += [(1, None, 1), (2, [NAN] * 24, 1), (0, [float("inf")] + [0.0] * 23, 2), (-1, [None] + [0.0] * 23, 2)]
    rows += rows[5:9] + [(None, [0.5] * 24, 1), (200, [0.0] * 24, 7), (201, [0.0] * 24, 7), (300, [1.0] * 8, 1), (301, [], 1)]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *[f"'{n}' AS {n}" for n in ("row", "ints", "code", "was", "error", "part", "entry", "of", "total", "place", "amount")])
    assert coded(table) == by_hand(rows)
    assert veccodes.report(table.limit(0)).count() == 0
    assert veccodes.report(table.where("vec_id = 2")).count() == 0


@pytest.mark.parametrize("width", [8, 3, 13])
def test_few_vectors_of_any_width(spark, width):
    rng = np.random.default_rng(width)
    rows = [(i, rng.normal(size=width).tolist(), 1) for i in range(9)]
    assert coded(spark.createDataFrame(rows, SCHEMA)) == by_hand(rows)


def test_ties_go_to_the_lower_entry_and_unused_entries_stay(spark):
    rows = [(i, [float(i % 2)] * 8, None) for i in range(40)]  # equal entries: all but the first two stay unused
    got, digest = coded(spark.createDataFrame(rows, SCHEMA))
    assert (got, digest) == by_hand(rows) and {c for _, c, _, _ in got} == {"00" * 8, "01" * 8}


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=16) * 10.0 ** (i % 9)).tolist(), i % 2) for i in range(60)]
    assert coded(spark.createDataFrame(rows, SCHEMA)) == by_hand(rows)


def test_only_moved_parts_are_sent(spark):
    """Contributions follow the moves, whatever the number of vectors that stay."""
    near = [(i, [float(i % 16)] * 8, 0) for i in range(4_000)]
    state = spark.createDataFrame([(i, [int(4096 * x) for x in v], None) for i, v, _ in near], "row long, ints array<long>, code binary")
    books = [np.array([[4096 * e] for e in range(16)])] * 8
    one = veccodes._assign(state, books, 8).cache()
    assert veccodes._moves(one, 8).count() == 8 * 16 * 2 - 8  # counts and sums; the sums of entry 0 are 0
    two = veccodes._assign(one.drop("was"), books, 8)
    assert veccodes._moves(two, 8).count() == 0
    moved = [b.copy() for b in books]
    moved[2][5] = 4096 * 100  # entry 5's parts at position 2 move to a neighbour
    three = veccodes._moves(veccodes._assign(one.drop("was"), moved, 8), 8).collect()
    assert {(r.part, r.entry, int(r.amount)) for r in three if r.place < 0} == {(2, 5, -250), (2, 4, 250)}


def test_decoded_vectors_are_near(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    made = veccodes.compress(table)
    errors = {r.vec_id: r.error for r in made.rows.collect()}
    first = {r.vec_id: np.floor(np.array(r.embedding) * 4096) for r in table.collect()}
    for r in made.decode().collect():
        assert ((np.array(r.embedding) * 4096 - first[r.vec_id]) ** 2).sum() == errors[r.vec_id]
