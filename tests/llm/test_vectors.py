from __future__ import annotations

import numpy as np
import pytest

from gatherline.llm import ann, embdedup

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN = float("nan")


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")


@pytest.fixture(scope="module")
def odd_vectors(spark):
    rows = [(0, [1.0, 0.0], 1), (20, [0.0, 0.0], 1), (40, None, 1), (60, [NAN, 1.0], 1), (80, [None, 1.0], 1), (100, [float("inf"), 1.0], 1), (5, [1.0, 0.01], 1), (6, [1.0, 0.0], 1), (7, [1.0, 0.0], 2), (8, [1.0, 0.0], None), (9, [], 1), (10, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1)]
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", *[f"'{n}' AS {n}" for n in ("block", "rep", "copies", "keys", "width", "links", "key", "other", "low", "curve", "asks")])


def usable(v) -> bool:
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute_links(rows, threshold=0.93):
    """(vec_id, links, component, kept) of every row."""
    up, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    good = [(i, np.array(r.embedding, float), r.label) for i, r in enumerate(rows) if usable(r.embedding) and r.label is not None]
    for k, (i, a, la) in enumerate(good):
        for j, b, lb in good[k + 1 :]:
            if la == lb and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                links[i] += 1
                links[j] += 1
                up[root(j)] = root(i)
    name = {}
    for i, r in enumerate(rows):
        if r.vec_id is not None:
            name[root(i)] = min(name.get(root(i), r.vec_id), r.vec_id)
    named = [name.get(root(i)) for i in range(len(rows))]
    return sorted(((r.vec_id, n, c, r.vec_id is not None and c == r.vec_id) for r, n, c in zip(rows, links, named, strict=True)), key=str)


def linked(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embdedup.link(df).collect()), key=str)


def test_links_match_brute_force(table):
    some = table.where("vec_id < 700")
    assert linked(some) == brute_links(some.collect())


def clusters(spark, n, each=12, seed=1):
    """n groups of vectors about far centres, some of them equal, in three labels."""
    rng, rows = np.random.default_rng(seed), []
    for g in range(n):
        centre = rng.normal(size=24)
        for k in range(each):
            v = centre if k < 4 else centre + rng.normal(size=24) * 0.3
            rows.append((len(rows) * 3, [float(np.float32(x)) for x in v], g % 3))
    return spark.createDataFrame(rows, SCHEMA)


def test_small_blocks_and_copies(spark, monkeypatch):
    monkeypatch.setattr(embdedup, "BLOCK", 16)
    df = clusters(spark, 20)
    assert linked(df) == brute_links(df.collect())


def test_far_blocks_never_meet(spark, monkeypatch):
    """Of all pairs of blocks few meet once clusters are larger than blocks; no link is lost."""
    monkeypatch.setattr(embdedup, "BLOCK", 16)
    made, table = {}, embdedup.Scratch.table

    def noted(self, df, name, *more):
        out = table(self, df, name, *more)
        made[name] = out.count()
        return out

    monkeypatch.setattr(embdedup.Scratch, "table", noted)
    df = clusters(spark, 18, each=60)
    assert linked(df) == brute_links(df.collect())
    per_label = made["ranges"] / 3
    share = made["met"] / (3 * per_label * (per_label + 1) / 2)
    print("pairs of blocks that meet", share)
    assert share < 0.5


def test_link_odd_rows(spark, odd_vectors):
    assert linked(odd_vectors) == brute_links(odd_vectors.collect())
    assert embdedup.link(spark.createDataFrame([], SCHEMA)).count() == 0
    repeated = spark.createDataFrame([(4, [1.0, 0.0], 1), (4, [0.0, 1.0], 1), (2, [0.0, 1.0], 1), (4, [0.0, 1.0], 1)], SCHEMA)
    assert linked(repeated) == brute_links(repeated.collect())


def brute_search(rows, every=20, k=20):
    """(query row, [(score, vec_id)]) of every asking row against all other rows of its length."""
    good = [(r.vec_id, np.array(r.embedding, float)) for r in rows if r.vec_id is not None and usable(r.embedding)]
    out = []
    for at, (i, q) in enumerate(good):
        if i % every == 0:
            near = sorted((-float((v * q).sum()), j) for n, (j, v) in enumerate(good) if n != at and len(v) == len(q))[:k]
            out.append((i, [(-s, j) for s, j in near]))
    return out


def lists(got) -> dict:
    """Found rows by query id, each checked for its order."""
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append(r)
    for found in by.values():
        assert [r.rank for r in found] == list(range(1, len(found) + 1))
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
    return by


def recall(want, by) -> float:
    assert {i for i, near in want if near} == by.keys()
    hits = 0
    for i, near in want:
        exact = {j: s for s, j in near}
        found = by[i]
        assert len(found) == len(near)
        assert all(r.score == pytest.approx(exact[r.vec_id], abs=1e-12) for r in found if r.vec_id in exact)
        hits += len({r.vec_id for r in found} & exact.keys())
    return hits / sum(len(near) for _, near in want)


@pytest.fixture
def windows(monkeypatch):
    """The curves and windows that searches chose."""
    chosen, choose = [], ann._choose
    monkeypatch.setattr(ann, "_choose", lambda *a: chosen.append(choose(*a)) or chosen[-1])
    return chosen


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_search_recall_and_order(spark, windows, sf):
    table = spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet")
    got = recall(brute_search(table.collect()), lists(ann.search(table).collect()))
    (made,) = windows
    print("recall", got, "curves", len(made.borders), "reach", made.reach, "of", len(made.borders[0]) + 1, "compared", made.share)
    assert len(made.borders) >= ann.LEAST_CURVES and len(made.borders[0]) + 1 > made.reach + 1
    assert got >= 0.9


def test_windows_are_narrow_where_vectors_cluster(spark, monkeypatch, windows):
    monkeypatch.setattr(ann, "BLOCK", 64)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 32))
    data = (centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 32)) * 0.4).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(data)], SCHEMA)
    got = recall(brute_search(df.collect(), every=100), lists(ann.search(df, every=100).collect()))
    print("recall", got, "compared", windows[0].share)
    assert got >= 0.9 and windows[0].share < 0.7


def test_copies_ties_and_repeated_ids(spark):
    """A vector that a third of the rows share, equal scores of different vectors, ids that several rows have."""
    rng, rows = np.random.default_rng(3), []
    for i in range(300):
        v = [1.0, 2.0, 0.0] if i % 3 == 0 else [2.0, 1.0, float(i % 5)] if i % 3 == 1 else [float(x) for x in rng.integers(-3, 4, 3)]
        rows.append((i, v, 0))
    rows += [(40, [3.0, 0.0, 1.0], 0), (41, [5.0, 5.0, 5.0], 0), (41, [5.0, 5.0, 5.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute_search(df.collect())
    got = lists_of(ann.search(df).collect())
    kept = sorted((i, [j for _, j in near]) for i, near in want)
    assert sum(len(set(a[1]) & set(b[1])) for a, b in zip(kept, got, strict=True)) >= 0.9 * 20 * len(kept)
    # The rows that share the frequent vector are found by their smallest ids.
    hot = [i for i, v, _ in rows if v == [1.0, 2.0, 0.0]]
    for i, near in got:
        seen = [j for j in near if j in hot]
        assert seen == [j for j in hot if j != i][: len(seen)]


def lists_of(got) -> list:
    """(query id, ids in order) of each list; an id that two rows share has two."""
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, {}).setdefault(r.rank, []).append(r.vec_id)
    return sorted((i, [ids[k] for _, ids in sorted(ranks.items())]) for i, ranks in by.items() for k in range(len(ranks[1])))


def test_search_odd_rows(spark, odd_vectors):
    got = lists(ann.search(odd_vectors).collect())
    assert {i: [r.vec_id for r in found] for i, found in got.items()} == {0: [5, 6, 7, 8]}
    assert ann.search(spark.createDataFrame([], SCHEMA)).count() == 0
    lengths = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [1.0, 1.0], 1), (20, [1.0, 0.0, 2.0], 1), (2, [0.5, 0.0, 1.0], 1)], SCHEMA)
    assert {i: [r.vec_id for r in found] for i, found in lists(ann.search(lengths).collect()).items()} == {0: [1], 20: [2]}


def test_hilbert_curve_visits_neighbours():
    grid = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    keys = ann.hilbert_keys(grid, 3)
    assert sorted(keys) == list(range(512))
    steps = np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()
