from __future__ import annotations

import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest

from gatherline.llm import bestfit
from tests.llm.test_tokens import BYTE, library, strange_texts


def checked(rows: list, got: list) -> int:
    """Sequences of a packing in which every id lies in one piece, only long documents are cut, and offsets are gapless."""
    made = library(BYTE)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert len(pieces) == len(rows)
    for i, t in rows:
        ids = [*made.encode(t or "", add_special_tokens=False).ids, 0]
        at = 0
        for k, r in enumerate(sorted(pieces[i], key=lambda r: r.piece)):
            part = ids[at : at + r.length]
            assert (r.piece, r.start, r.doc_tokens, r.ids_crc32) == (k, at, len(ids), zlib.crc32(struct.pack(f"<{len(part)}I", *part))), repr(t)[:200]
            assert k == 0 or r.length == bestfit.SEQUENCE
            at += r.length
        assert at == len(ids) and (len(ids) > bestfit.SEQUENCE or len(pieces[i]) == 1)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= bestfit.SEQUENCE
    return len(sequences)


def plain_best_fit(lengths: list[int], capacity: int) -> int:
    gaps: list[int] = []
    for s in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= s]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - s)
        else:
            gaps.append(capacity - s)
    return len(gaps)


def test_few_sequences_on_real_lengths(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()] + [(10_000 + i, t) for i, t in enumerate(strange_texts(300, 7))]
    got = bestfit.pack(spark.createDataFrame(rows, "doc_id long, text string"), BYTE).collect()
    n, lengths = checked(rows, got), [r.length for r in got]
    assert n <= plain_best_fit(lengths, bestfit.SEQUENCE) + 1 and n <= -(-sum(lengths) // bestfit.SEQUENCE) + 2


def test_odd_rows(spark, odd, none):
    rows = [(i, r.text) for i, r in enumerate(odd.collect())]
    checked(rows, bestfit.pack(spark.createDataFrame(rows, "doc_id long, text string"), BYTE).collect())
    got = bestfit.pack(odd, BYTE)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    kept = got.collect()
    assert [r.doc_id for r in kept].count(6) == 2 and sum(r.doc_id is None for r in kept) == 1
    assert len({(r.sequence_id, r.offset) for r in kept}) == len(kept)
    assert bestfit.pack(none, BYTE).count() == 0


def test_documents_at_the_border(spark):
    """2047 to 2049 and 4096 ids with the end: cut only beyond a sequence, the first piece takes what is over."""
    word = " the"
    rows = [(n, word * (n - 1)) for n in (1, 2, 2047, 2048, 2049, 4096, 4097)]
    got = bestfit.pack(spark.createDataFrame(rows, "doc_id long, text string"), BYTE).collect()
    checked(rows, got)
    assert {i: [r.length for r in sorted(got, key=lambda r: r.piece) if r.doc_id == i] for i, _ in rows} == {1: [1], 2: [2], 2047: [2047], 2048: [2048], 2049: [1, 2048], 4096: [2048, 2048], 4097: [1, 2048, 2048]}


def test_packing_repeats_itself(documents):
    a, b = (sorted(bestfit.pack(documents, BYTE).collect()) for _ in range(2))
    assert a == b


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_the_demand_exactly(seed):
    rng = np.random.default_rng(seed)
    sizes = np.sort(rng.choice(np.arange(1, 257), 90, replace=False))
    demand = rng.integers(1, [3, 50, 5_000, 2][seed], 90)
    runs = bestfit.plan(sizes, demand, 256)
    held = defaultdict(int)
    for filling, copies in runs:
        assert copies > 0 and sum(s * k for s, k in filling) <= 256
        for s, k in filling:
            held[s] += k * copies
    assert held == dict(zip(sizes.tolist(), demand.tolist(), strict=True))
    n, bound = sum(k for _, k in runs), sizes @ demand / 256
    print("sequences", n, "bound", bound)
    assert n <= 1.005 * plain_best_fit(np.repeat(sizes, np.minimum(demand, 50)).tolist(), 256) + 1 if demand.max() <= 50 else 1.12 * bound
    places = bestfit.spans(runs)
    for s, d in zip(sizes.tolist(), demand.tolist(), strict=True):  # every rank has a place of its own
        starts, first, times, base = places[s]
        rank = np.arange(d)
        k = np.searchsorted(starts, rank, "right") - 1
        copy, slot = np.divmod(rank - starts[k], times[k])
        assert len({*zip((first[k] + copy).tolist(), (base[k] + slot * s).tolist(), strict=True)}) == d


def test_program_where_gaps_cannot_be_filled():
    """Lengths over half a sequence stand alone; thirds and two thirds meet: the program finds the optimum."""
    runs = bestfit.plan(np.array([100, 156, 200]), np.array([1000, 1000, 500]), 256)
    assert sum(k for _, k in runs) == 1500


@pytest.mark.parametrize("seed", range(20))
def test_configuration_is_the_best(seed):
    rng = np.random.default_rng(seed)
    sizes, demand, prices = rng.integers(1, 20, 5), rng.integers(1, 4, 5), rng.random(5)
    grid = np.stack(np.meshgrid(*[np.arange(d + 1) for d in demand], indexing="ij"), axis=-1).reshape(-1, 5)
    best = (grid[grid @ sizes <= 40] @ prices).max()
    found = bestfit.configuration(prices, sizes, demand, 40)
    assert sum(sizes[j] * k for j, k in found) <= 40 and all(k <= demand[j] for j, k in found)
    assert sum(prices[j] * k for j, k in found) == pytest.approx(best)
