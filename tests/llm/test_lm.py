from __future__ import annotations

import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest

from gatherline.llm import lm

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text: str | None) -> list[str]:
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(SMALL)), "\n"]


def is_held(i: int | None) -> bool:
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def brute(rows):
    """Base figures, and the interpolated score with weights learned on the same deleted counts."""
    one, two = Counter(), Counter()
    for i, t in rows:
        if not is_held(i):
            words = tokens(t)
            one.update(words)
            two.update(zip(["\n", *words], words))
    n, v, ends = sum(one.values()), len(one), one["\n"]
    cells = Counter()
    for i, t in rows:
        if not is_held(i):
            words = tokens(t)
            for a, b in zip(["\n", *words], words):
                u = one[a] - 1
                d = (two[a, b] - 1) / u if u > 0 else 0.0
                cells[int(lm.context(np.array([u]))[0]), int(lm.level(np.array([d]))[0]), int(lm.level(np.array([(one[b] - 1) / max(n - 1, 1)]))[0])] += 1
    keys = np.array([(c * lm.LEVELS + x) * lm.LEVELS + y for c, x, y in cells], np.int64)
    weights = lm.learn(keys, np.array([*cells.values()], float), v)
    out = []
    for i, t in rows:
        words = tokens(t)
        base, total = 0.0, 0.0
        for a, b in zip(["\n", *words], words):
            base += log10((one[b] + 1) / (n + v + 1))
            w = weights[int(lm.context(np.array([one[a]]))[0])]
            total += log10(w[0] * (two[a, b] / one[a] if one[a] else 0.0) + w[1] * one[b] / max(n, 1) + w[2] / (v + 1))
        out.append((i, is_held(i), len(words), sum(one[w] > 0 for w in words), n, base, total))
    return out


def checked(got, rows):
    """Every row against brute force; rows that repeat an id are told apart by their figures."""
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(got, key=order), sorted(brute(rows), key=order)
    assert len(got) == len(want)
    for r, w in zip(got, want, strict=True):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:5]
        assert r.base_score == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert r.score == pytest.approx(w[6], rel=1e-9)


def test_matches_brute_force(documents):
    checked(lm.score(documents).collect(), [(r.doc_id, r.text) for r in documents.collect()])


def test_slices_are_never_more_than_items(documents, monkeypatch):
    """Many shards and many buckets: no empty slices, and the same scores."""
    monkeypatch.setattr(lm, "SHARD_BYTES", 10_000)
    monkeypatch.setattr(lm, "BUCKET_ITEMS", 50)
    encoded = lm.shards(documents, 7, 2).cache()
    items = encoded.agg({"items": "sum"}).first()[0]
    slices = lm.ask(encoded, -(-items // 50))
    assert slices.count() <= items and slices.where("keys = X''").count() == 0
    encoded.unpersist()
    some = documents.where("doc_id < 60")
    checked(lm.score(some).collect(), [(r.doc_id, r.text) for r in some.collect()])


def test_beats_the_base_on_held_out_texts(documents):
    rows = lm.score(documents).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_shards_and_buckets_do_not_change_scores(spark, documents, monkeypatch):
    whole = {r.doc_id: r.score for r in lm.score(documents).collect()}
    monkeypatch.setattr(lm, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(lm, "BUCKET_ITEMS", 5_000)
    small = {r.doc_id: r.score for r in lm.score(documents.repartition(5)).collect()}
    assert whole.keys() == small.keys()
    assert all(small[k] == pytest.approx(whole[k], rel=1e-9) for k in whole)


def test_odd_rows(odd, none):
    got = lm.score(odd).collect()
    checked(got, [(r.doc_id, r.text) for r in odd.collect()])
    empty = {r.doc_id: r for r in got if r.doc_id in (1, 2, 3)}
    assert all(r.n_tokens == 1 for r in empty.values())
    assert sum(r.doc_id is None for r in got) == 1 and all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert lm.score(none).count() == 0


def test_without_training_documents(spark):
    held = next(i for i in range(1000) if is_held(i))
    (r,) = lm.score(spark.createDataFrame([(held, "some words")], "doc_id long, text string")).collect()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0) and np.isfinite(r.score)
