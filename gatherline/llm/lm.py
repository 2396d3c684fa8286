"""Language-model scores by deleted interpolation.

Bigram, unigram and uniform estimates are mixed with weights that depend on how often the context occurred; the
weights are learned by expectation-maximisation on deleted counts, where every training token is scored by the counts
of all the others.

Counts are gathered over the whole corpus. Documents are encoded into shards of bounded size; each shard asks for the
counts of its distinct words and bigrams, sorted by hash and sent as packed slices to hash buckets; a bucket adds up
what all shards have and answers every shard in the order it asked. A shuffled row is a packed slice, so neither a
frequent word nor a large corpus makes any task large; slices without items are not sent, so that there are never more
of them than items, however many shards and buckets there are. Only the histogram for the mixture weights, of bounded
size, reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatherline.llm.blocks import LOWER, U64, blocks, mix, words
from gatherline.llm.training import fold
from gatherline.llm.wordhash import word_names
from gatherline.plans.scratch import Scratch

#: Text bytes of a shard (one document more at most), and distinct items of a bucket.
SHARD_BYTES = 12 << 20
BUCKET_ITEMS = 2_000_000
END = U64(0x243F6A8885A308D3)
#: Context-frequency classes (powers of two), and levels of the estimates in the histogram (half powers of two).
CONTEXTS, LEVELS = 20, 64
ROUNDS = 60
FLOOR = 1e-7
#: Tasks' worth of shard numbers that buckets send their sums to.
SPREAD = 1024


_ZSTD = pa.Codec("zstd", 3)


def planes(values: np.ndarray, width: int = 4) -> bytes:
    """Bytes of unsigned integers of ``width`` bytes, most alike together, compressed."""
    raw = np.ascontiguousarray(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True) if raw else b""


def unplanes(data: bytes, width: int = 4) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64 if width == 4 else U64)
    raw = _ZSTD.decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)
    out = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(f"<u{width}").ravel()
    return out.astype(np.int64) if width == 4 else out


def steps(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as the steps between them."""
    return planes(np.diff(keys, prepend=U64(0)), 8)


def unsteps(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data, 8), dtype=U64)


def bigrams(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it; a document's first token follows an end."""
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[np.cumsum(lengths) - lengths] = END
    return mix(before * U64(0x9E3779B97F4A7C15) + hashes)


def counted(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, each key's place among them, and how often it stands in training tokens."""
    unique, place = np.unique(keys, return_inverse=True)
    return unique, place, np.bincount(place, train, len(unique)).astype(np.int64)


def cut(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where the slices of sorted keys for each bucket begin; one place more at the end."""
    bucket = ((keys >> U64(32)) * U64(buckets)) >> U64(32)
    return np.searchsorted(bucket, np.arange(buckets + 1, dtype=U64))


def shards(documents: DataFrame, modulus: int, held: int) -> DataFrame:
    """Encoded documents: one row a shard with ids, fold, token numbers, distinct word hashes and tokens as their indexes."""

    def emit(part: list, number: int) -> pa.RecordBatch:
        ids, nameless, out, lengths, hashes = (np.concatenate(x) for x in zip(*part, strict=True))
        unique, place = np.unique(hashes, return_inverse=True)
        order = np.argsort(-np.bincount(place), kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        shard = (TaskContext.get().partitionId() << 32) + number
        items = len(unique) + len(np.unique(bigrams(hashes, lengths)))
        columns = [pa.array([x], pa.int64()) for x in (shard, items, int(lengths[~out].sum()))]
        columns += [pa.array([b], pa.binary()) for b in (ids.astype("<i8").tobytes(), np.packbits(nameless).tobytes(), out.astype(np.uint8).tobytes(), planes(lengths), unique[order].tobytes(), planes(rank[place]))]
        return pa.record_batch(columns, names)

    names = ["shard", "items", "train", "ids", "nameless", "held", "lengths", "words", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, size, number = [], 0, 0
        for batch in batches:
            nameless, named = batch.column(0).is_null().to_numpy(zero_copy_only=False), batch.column(0).fill_null(0).to_numpy()
            out = batch.column(1).to_numpy(zero_copy_only=False)
            for low, high, data, offsets in blocks(batch.column(2)):
                data = LOWER[data]
                starts, ends, firsts = words(data, offsets)
                n = np.diff(firsts)
                hashes = np.full(len(starts) + len(n), END, U64)
                hashes[np.arange(len(starts)) + np.repeat(np.arange(len(n)), n)] = word_names(data, starts, ends)
                part.append((named[low:high], nameless[low:high], out[low:high], n + 1, hashes))
                size += len(data) + 8 * len(n)
                if size >= SHARD_BYTES:
                    yield emit(part, number)
                    part, size, number = [], 0, number + 1
        if part:
            yield emit(part, number)

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", modulus) == held).alias("held"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "shard long, items long, train long, ids binary, nameless binary, held binary, lengths binary, words binary, tokens binary")


class Shard:
    """A shard's row, unpacked."""

    def __init__(self, row):
        self.ids, self.held = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["held"], np.uint8).astype(bool)
        self.lengths, self.tokens = unplanes(row["lengths"]), unplanes(row["tokens"])
        self.words = np.frombuffer(row["words"], U64)
        self.train = np.repeat(~self.held, self.lengths).astype(float)

    def items(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Words, then bigrams, as counted() has them."""
        hashes = self.words[self.tokens]
        yield counted(hashes, self.train)
        yield counted(bigrams(hashes, self.lengths), self.train)


def ask(encoded: DataFrame, buckets: int) -> DataFrame:
    """Packed slices of each shard's items: bucket, shard, kind, keys, counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for kind, (unique, _, times) in enumerate(Shard(row).items()):
                    at = cut(unique, buckets)
                    some = np.flatnonzero(np.diff(at))
                    yield pa.record_batch(
                        [
                            pa.array(some, pa.int32()),
                            pa.array(np.full(len(some), row["shard"]), pa.int64()),
                            pa.array(np.full(len(some), kind), pa.int32()),
                            pa.array([steps(unique[at[k] : at[k + 1]]) for k in some], pa.binary()),
                            pa.array([planes(times[at[k] : at[k + 1]]) for k in some], pa.binary()),
                        ],
                        ["bucket", "shard", "kind", "keys", "counts"],
                    )

    return encoded.mapInArrow(run, "bucket int, shard long, kind int, keys binary, counts binary")


def answer(rows: pd.DataFrame) -> pd.DataFrame:
    """A bucket's total counts in the order each shard asked; and its number of known words, under a shard number below 0."""
    out, bucket = [], int(rows["bucket"].iloc[0])
    for kind, part in rows.groupby("kind"):
        keys = [unsteps(k) for k in part["keys"]]
        times = [unplanes(c) for c in part["counts"]]
        unique, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, np.concatenate(times), len(unique)).astype(np.int64)
        at = 0
        for shard, k in zip(part["shard"], keys, strict=True):
            out.append((shard, kind, bucket, planes(total[place[at : at + len(k)]]), 0))
            at += len(k)
        if kind == 0:
            out.append((-1 - bucket % SPREAD, kind, bucket, b"", int((total > 0).sum())))
    return pd.DataFrame(out, columns=["shard", "kind", "bucket", "counts", "known"])


def level(p: np.ndarray) -> np.ndarray:
    """0 for no chance, else 1 for certain and one more for each half power of two below."""
    return np.where(p > 0, np.minimum(LEVELS - 1, 1 + np.round(-2 * np.log2(np.maximum(p, 1e-300)))), 0).astype(np.int64)


def context(count: np.ndarray) -> np.ndarray:
    return np.minimum(CONTEXTS - 1, np.where(count > 0, 1 + np.floor(np.log2(np.maximum(count, 1))), 0)).astype(np.int64)


def _before(values: np.ndarray, lengths: np.ndarray, ends: int) -> np.ndarray:
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[np.cumsum(lengths) - lengths] = ends
    return out


def resolve(left: pd.DataFrame, right: pd.DataFrame, n: int) -> pd.DataFrame:
    """A shard with its answers: per document the base figures, per token the counts, and the deleted-count histogram.

    Without a shard the answers are buckets' numbers of known words, which are added up.
    """
    if not len(left):
        empty = dict.fromkeys(["ids", "nameless", "held", "lengths", "known", "base", "one", "two"], [b""])
        return pd.DataFrame(empty | {"ends": [0], "v": [int(right["known"].sum())], "cells": [[]], "times": [[]]})
    row = left.iloc[0]
    shard = Shard(row)
    found = []
    for kind, (_, place, _) in enumerate(shard.items()):
        part = right[right["kind"] == kind].sort_values("bucket")
        found.append(np.concatenate([unplanes(c) for c in part["counts"]])[place])
    one, two = found
    ends = int(one[np.cumsum(shard.lengths)[0] - 1])
    over = _before(one, shard.lengths, ends)
    train = shard.train > 0
    # Deleted counts: each training token is taken from the counts that judge it.
    c, d, u = one[train] - 1, two[train] - 1, over[train] - 1
    cell = (context(u) * LEVELS + level(np.where(u > 0, d / np.maximum(u, 1), 0))) * LEVELS + level(c / max(n - 1, 1))
    cells, times = np.unique(cell, return_counts=True)
    firsts = np.concatenate([[0], np.cumsum(shard.lengths)])
    known = np.add.reduceat((one > 0).astype(np.int64), firsts[:-1])
    base = np.add.reduceat(np.log10(one + 1), firsts[:-1])
    return pd.DataFrame(
        {
            "ids": [row["ids"]], "nameless": [row["nameless"]], "held": [row["held"]], "lengths": [row["lengths"]], "known": [planes(known)],
            "base": [base.tobytes()], "one": [planes(one)], "two": [planes(two)], "ends": [ends], "v": [0],
            "cells": [cells.tolist()], "times": [times.tolist()],
        }
    )


RESOLVED = "ids binary, nameless binary, held binary, lengths binary, known binary, base binary, one binary, two binary, ends long, v long, cells array<long>, times array<long>"


def learn(cells: np.ndarray, times: np.ndarray, v: int) -> np.ndarray:
    """Mixture weights (bigram, unigram, uniform) of every context class, by expectation-maximisation."""
    weights = np.tile([0.4, 0.55, 0.05], (CONTEXTS, 1))
    if len(cells):
        which, two, one = cells // (LEVELS * LEVELS), cells // LEVELS % LEVELS, cells % LEVELS
        chance = lambda x: np.where(x > 0, 2.0 ** (-(x - 1) / 2), 0)
        p = np.stack([chance(two), chance(one), np.full(len(cells), 1 / (v + 1))], axis=1)
        for _ in range(ROUNDS):
            share = weights[which] * p
            share *= (times / share.sum(axis=1))[:, None]
            total = np.stack([np.bincount(which, share[:, k], CONTEXTS) for k in range(3)], axis=1)
            seen = total.sum(axis=1) > 0
            weights[seen] = np.maximum(total[seen] / total[seen].sum(axis=1, keepdims=True), FLOOR)
        weights /= weights.sum(axis=1, keepdims=True)
    return weights


def score(documents: DataFrame, modulus: int = 7, held: int = 2) -> DataFrame:
    """Scores every document under a model of those outside the held-out fold.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. A null or empty text is the end token
    alone; a null id counts as the empty text when the fold is told. Rows are kept one for one; repeated rows count each
    time. With no training documents every token is unknown and only the uniform estimate is left. Other columns are
    not read; an empty table gives no rows.
    """
    scratch = Scratch(documents.sparkSession, "lm")
    encoded = scratch.table(shards(documents, modulus, held), "shards", "zstd")
    size = encoded.agg(F.sum("items").alias("items"), F.sum("train").alias("train")).first()
    buckets, n = max(8, -(-(size["items"] or 0) // BUCKET_ITEMS)), size.train or 0
    answers = ask(encoded, buckets).groupBy("bucket").applyInPandas(answer, "shard long, kind int, bucket int, counts binary, known long")
    joined = encoded.drop("items", "train").groupBy("shard").cogroup(answers.groupBy("shard")).applyInPandas(lambda left, right: resolve(left, right, n), RESOLVED)
    resolved = scratch.table(joined, "resolved", "zstd")
    pairs = resolved.select(F.explode(F.arrays_zip("cells", "times")).alias("x")).groupBy("x.cells").agg(F.sum("x.times").alias("times"))
    histogram = pairs.collect()  # at most CONTEXTS * LEVELS * LEVELS rows
    v = resolved.agg(F.sum("v")).first()[0] or 0
    weights = learn(np.array([r.cells for r in histogram], np.int64), np.array([r.times for r in histogram], float), v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths, one, two = unplanes(row["lengths"]), unplanes(row["one"]), unplanes(row["two"])
                over = _before(one, lengths, row["ends"])
                w = weights[context(over)]
                p = w[:, 0] * np.where(over > 0, two / np.maximum(over, 1), 0) + w[:, 1] * one / max(n, 1) + w[:, 2] / (v + 1)
                firsts = np.cumsum(lengths) - lengths
                nameless = np.unpackbits(np.frombuffer(row["nameless"], np.uint8), count=len(lengths)).astype(bool)
                yield pa.record_batch(
                    [
                        pa.array(np.frombuffer(row["ids"], "<i8"), mask=nameless),
                        pa.array(np.frombuffer(row["held"], np.uint8).astype(bool)),
                        pa.array(lengths),
                        pa.array(unplanes(row["known"])),
                        pa.array(np.full(len(lengths), n, np.int64)),
                        pa.array(np.frombuffer(row["base"]) - lengths * np.log10(n + v + 1)),
                        pa.array(np.add.reduceat(np.log10(p), firsts)),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    fields = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return resolved.where(F.length("lengths") > 0).drop("cells", "times").mapInArrow(run, fields)
