from __future__ import annotations

import random
import re

import numpy as np

from gatherline.llm import minhash
from gatherline.llm.blocks import U64
from gatherline.plans.scratch import Scratch

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text: str | None, width: int) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(SMALL))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows: list[tuple[int, str | None]], width: int, percent: int = 80) -> dict[int, tuple[int, int]]:
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    up = {i: i for i, _ in rows}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1 :]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return {i: (len(s), root(i)) for i, s in sets}


def test_large_lumps_match_brute_force(spark, monkeypatch):
    """Tiles of every kind: small lumps, keys of long chains, and blocks of keys with many members, bounded in shingles."""
    rng = random.Random(9)
    page = [f"p{i}" for i in range(60)]
    rows = []
    for k in range(140):  # pages of one template: not alike, but many share keys
        rows.append((len(rows), " ".join(page[: 44 + k % 17] + [f"u{k}x{j}" for j in range(rng.randrange(6, 24))])))
    words = [f"c{rng.randrange(2000)}" for _ in range(90)]
    for _ in range(80):  # a chain
        rows.append((len(rows), " ".join(words)))
        for _ in range(6):
            words[rng.randrange(len(words))] = f"c{rng.randrange(2000)}"
    monkeypatch.setattr(minhash, "BLOCK", 12)
    check(spark, rows)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 300)
    check(spark, rows, width=1)


def check(spark, rows, width=2):
    got = minhash.group(spark.createDataFrame(rows, "doc_id long, text string"), width).collect()
    want = brute(rows, width)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_real_documents_match_brute_force(spark, documents):
    check(spark, [(r.doc_id, r.text) for r in documents.collect()])


def test_chains_groups_and_borderline_pairs(spark):
    rng, rows = random.Random(5), []
    for family in range(6):
        words = [f"w{rng.randrange(3000)}" for _ in range(120)]
        for _ in range(25):  # a random walk: neighbours are near, the ends are far
            rows.append((len(rows) * 7 % 1009 + family, " ".join(words)))
            for _ in range(rng.randrange(0, 9)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(3000)}"
    rows = list({i: (i, t) for i, t in rows}.values())
    check(spark, rows)
    check(spark, rows, width=5)


def test_exact_border_counts(spark):
    a = [f"a{i}" for i in range(10)]
    rows = [(1, " ".join(a)), (2, " ".join(a[:9])), (3, " ".join(a[:7])), (4, "A0 a1"), (5, "a0\ta1"), (6, "solo"), (7, "SOLO"), (8, None), (9, "")]
    check(spark, rows)


def test_odd_rows(spark, odd, none):
    got = minhash.group(odd, width=2)
    assert got.count() == odd.count()
    rows = {r.doc_id: r for r in got.collect()}
    assert [rows[i].n_shingles for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert rows[6].component_id == 5 and not rows[6].kept
    assert rows[None].component_id is None and not rows[None].kept
    assert minhash.group(none).count() == 0


def test_rows_that_share_an_id_or_have_none(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(20)) for x in "abc")
    rows = [(5, a), (3, a + " more"), (5, b), (9, b), (None, c), (None, c), (12, c), (None, "alone stands this text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in minhash.group(df, width=2).collect()}
    assert got == {(5, 3), (3, 3), (9, 3), (None, 12), (12, 12), (None, None)}
    kept = sorted(((r.doc_id, r.text) for r in minhash.deduplicate(df, width=2).collect()), key=str)
    assert kept == sorted([(3, a + " more"), (5, b), (12, c), (None, "alone stands this text")], key=str)


def test_deduplicate_keeps_columns_and_one_of_each(odd, none):
    out = minhash.deduplicate(odd)
    assert out.columns == odd.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(map(str, [1, 2, 3, 4, 5, 7, 8, 9, 10, None]))
    assert minhash.deduplicate(none).count() == 0


def test_every_bin_fills_and_agreement_estimates_similarity():
    rng = np.random.default_rng(3)
    one = np.unique(rng.integers(0, 1 << 63, 3, dtype=np.int64).view(U64))
    assert (minhash.sketch(one, np.array([0, len(one)])) < np.iinfo(np.uint64).max).all()
    errors = []
    for _ in range(40):
        pool = np.unique(rng.integers(0, 1 << 63, 300, dtype=np.int64).view(U64))
        a, b = pool[:250], pool[50:]
        s = minhash.sketch(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        errors.append((s[0] == s[1]).mean() - 200 / 300)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_result_does_not_depend_on_partitions(spark, documents):
    one = minhash.group(documents.repartition(1)).select("doc_id", "component_id").collect()
    many = minhash.group(documents.repartition(13)).select("doc_id", "component_id").collect()
    assert sorted(one) == sorted(many)


def test_members_of_keys_are_not_joined_row_by_row(spark, monkeypatch):
    """A large group of near copies shares most keys: sizes come with the members, lumps by the keys' leaders."""
    rng = random.Random(4)
    page = [f"p{i}" for i in range(60)]
    rows = []
    for k in range(60):
        words = list(page)
        for _ in range(1 + k % 3):
            words[rng.randrange(60)] = f"x{rng.randrange(1000)}"
        rows.append((k, " ".join(words)))
    plans, plain = {}, Scratch.table
    monkeypatch.setattr(Scratch, "table", lambda self, df, name, *more: plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString()) and plain(self, df, name, *more))
    check(spark, rows)
    assert "Join LeftSemi" in plans["mixed"] and "Join Inner" not in plans["mixed"]
    assert "Join Inner, (leader#" in plans["key-sizes"] and "Join Inner, (rep#" not in plans["key-sizes"]
