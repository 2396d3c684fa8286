"""Vector codes by delta-maintained Lloyd rounds.

Components become integers, a vector is cut into ``PARTS`` consecutive parts, and each part position has a codebook of
at most ``ENTRIES`` entries. A round gives every part to its nearest entry and makes each entry the floored mean of its
parts. Assignments of the round before are kept in the table of vectors, and every entry's running sum and count are
integers, so a part that stays where it was says nothing: only a part that moves takes its components from one entry
and gives them to another. Those contributions are added up within a task before they are shuffled, so a round moves at
most one row for each task and entry that changed. All sums are exact, whatever the order they are added in.

The driver holds codebooks, sums and counts: ``ENTRIES`` vectors each. A round without moves ends the rounds, since all
later ones would repeat it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatherline.plans.scratch import Scratch

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Quantised components beyond this stay at it, so that sums fit 38 digits.
LARGEST = 1 << 52
#: Components of a stretch of vectors that a task works on at once.
STRETCH = 1 << 18
LONG = (1 << 63) - 1


def usable(vector: str) -> F.Column:
    """Not null and without null or non-finite components."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def quantised(vectors: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(vectors.astype(float) * SCALE), -LARGEST, LARGEST).astype(np.int64)


def borders(width: int) -> list[int]:
    """Where parts begin, and the end; parts differ by one component where the width is no multiple of PARTS."""
    return [i * width // PARTS for i in range(PARTS + 1)]


def nearest(part: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row, the lower of equals, and its squared distance (Python integers where a long is too short)."""
    top = int(max(np.abs(part).max(initial=0), np.abs(book).max(initial=0)))
    if 4 * top * top * max(1, part.shape[1]) < 1 << 52:  # products and sums are exact in doubles
        x, y = part.astype(float), book.astype(float)
        distance = ((x * x).sum(axis=1)[:, None] - 2 * (x @ y.T) + (y * y).sum(axis=1)[None, :]).astype(np.int64)
    else:
        apart = part.astype(object)[:, None, :] - book.astype(object)[None, :, :]
        distance = (apart * apart).sum(axis=2)
    code = distance.argmin(axis=1)
    return code, distance[np.arange(len(part)), code]


def _stretches(batch: pa.RecordBatch, column: int, width: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end row, vectors) of a batch whose vectors all have ``width`` components."""
    step = max(1, STRETCH // max(1, width))
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), width)
    for low in range(0, len(batch), step):
        yield low, min(len(batch), low + step), values[low : low + step]


def _assign(vectors: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    """The vectors with ``was``, the assignment so far, and ``code``, the one by these codebooks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = borders(width)
        for batch in batches:
            codes = [np.stack([nearest(v[:, at[p] : at[p + 1]], books[p])[0] for p in range(PARTS)], axis=1).astype(np.uint8) for _, _, v in _stretches(batch, 1, width)]
            code = pa.array([c.tobytes() for part in codes for c in part], pa.binary())
            yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), code], ["row", "ints", "was", "code"])

    return vectors.select("row", "ints", F.col("code").alias("was")).mapInArrow(run, "row long, ints array<long>, was binary, code binary")


def _moves(vectors: DataFrame, width: int) -> DataFrame:
    """Per part and entry what moved parts add to count and sums: part, entry, place (-1: the count), amount."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = borders(width)
        sums, times, there = np.zeros((ENTRIES, width), object), np.zeros((PARTS, ENTRIES), np.int64), np.zeros((PARTS, ENTRIES), bool)
        for batch in batches:
            was = batch.column(1).to_pylist()
            now = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, PARTS)
            before = np.frombuffer(b"".join(w or b"\xff" * PARTS for w in was), np.uint8).reshape(-1, PARTS)
            for low, high, values in _stretches(batch, 0, width):
                for p in range(PARTS):
                    old, new = before[low:high, p], now[low:high, p]
                    moved = old != new
                    if not moved.any():
                        continue
                    part = values[moved, at[p] : at[p + 1]]
                    for entry, sign in ((new[moved], 1), (old[moved], -1)):
                        for e in np.unique(entry[entry < ENTRIES]).tolist():
                            mine = part[entry == e]
                            # A stretch has at most 2**18 components of at most 2**52: two halves add up within a long.
                            sums[e, at[p] : at[p + 1]] += sign * (((mine >> 26).sum(axis=0).astype(object) << 26) + (mine & ((1 << 26) - 1)).sum(axis=0))
                            times[p, e] += sign * len(mine)
                            there[p, e] = True
        rows = [(p, e, k, str(a)) for p, e in zip(*np.nonzero(there), strict=True) for k, a in [(-1, times[p, e]), *((i, sums[e, i]) for i in range(at[p], at[p + 1]))]]
        if rows:
            part, entry, place, amount = zip(*rows, strict=True)
            yield pa.record_batch([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(place, pa.int32()), pa.array(amount)], ["part", "entry", "place", "amount"])

    moved = vectors.where("was IS NULL OR was <> code").select("ints", "was", "code")
    found = moved.mapInArrow(run, "part int, entry int, place int, amount string").withColumn("amount", F.col("amount").cast("decimal(38,0)"))
    return found.groupBy("part", "entry", "place").agg(F.sum("amount").alias("amount")).where("amount <> 0")


@dataclass
class Coded:
    """Codes of a table of vectors: rows (vec_id, label, code, error) and the codebooks, one array of entries for each part."""

    rows: DataFrame
    books: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 of all entries' components in decimal, by part, entry and place."""
        return hashlib.sha256(",".join(str(int(x)) for book in self.books for x in book.ravel()).encode()).hexdigest()

    def decode(self) -> DataFrame:
        """vec_id and the vector that its code stands for, in the scale of the originals."""
        books = self.books

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                vectors = [None if c is None else np.concatenate([books[p][int(c[2 * p : 2 * p + 2], 16)] for p in range(PARTS)]) / SCALE for c in batch.column(1).to_pylist()]
                yield pa.record_batch([batch.column(0), pa.array(vectors, pa.list_(pa.float64()))], ["vec_id", "embedding"])

        kind = dict(self.rows.dtypes)["vec_id"]
        return self.rows.select("vec_id", "code").mapInArrow(run, f"vec_id {kind}, embedding array<double>")


def compress(embeddings: DataFrame, rounds: int = ROUNDS) -> Coded:
    """Codebooks of all vectors, and every vector's code (two hex digits a part) and squared error.

    Vectors that are null or hold null or non-finite components are dropped. Codebooks start as the parts of the
    ENTRIES smallest vec_ids (null ids last, ties by vector; fewer vectors make fewer entries). Rows that repeat an id
    are vectors of their own. Vectors whose length is not that of the smallest id's belong to no codebook and have a null
    code and error. An error that does not fit a long is null. Other columns are not read; an empty table gives no rows.
    """
    scratch = Scratch(embeddings.sparkSession, "veccodes")
    kept = embeddings.where(usable("embedding")).select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"), F.monotonically_increasing_id().alias("row"))
    clipped = lambda x: F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), F.floor(x * SCALE).cast("double"))).cast("long")
    kept = scratch.table(kept.withColumn("ints", F.transform("embedding", clipped)), "kept")
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "embedding").select("ints").limit(ENTRIES).collect()
    if not first:
        return Coded(kept.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")), [np.zeros((0, 0), np.int64)] * PARTS)
    width = len(first[0].ints)
    at = borders(width)
    start = np.array([r.ints for r in first if len(r.ints) == width], np.int64).reshape(-1, width)
    books = [start[:, at[p] : at[p + 1]] for p in range(PARTS)]
    fit = F.size("ints") == width
    state = kept.where(fit).select("row", "ints", F.lit(None).cast("binary").alias("code"))
    sums, times = np.zeros((ENTRIES, width), object), np.zeros((PARTS, ENTRIES), object)
    for turn in range(rounds):
        state = scratch.table(_assign(state, books, width), f"round-{turn}")
        scratch.drop(f"round-{turn - 1}")
        moves = _moves(state, width).collect()  # at most ENTRIES * (width + PARTS) rows
        for r in moves:
            if r.place < 0:
                times[r.part, r.entry] += int(r.amount)
            else:
                sums[r.entry, r.place] += int(r.amount)
        fresh = [b.copy() for b in books]
        for p in range(PARTS):
            for e in range(len(books[p])):
                if times[p, e]:
                    fresh[p][e] = [int(s) // int(times[p, e]) for s in sums[e, at[p] : at[p + 1]]]
        still = all((a == b).all() for a, b in zip(books, fresh, strict=True))
        books = fresh
        if still:
            break

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = [], []
            for _, _, values in _stretches(batch, 2, width):
                found = [nearest(values[:, at[p] : at[p + 1]], books[p]) for p in range(PARTS)]
                codes += [c.tobytes().hex() for c in np.stack([f[0] for f in found], axis=1).astype(np.uint8)]
                total = sum(f[1].astype(object) for f in found)
                errors += [e if e <= LONG else None for e in total.tolist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(errors, pa.int64())], ["vec_id", "label", "code", "error"])

    kinds = dict(kept.dtypes)
    coded = kept.where(fit).select("vec_id", "label", "ints").mapInArrow(final, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")
    rest = kept.where(~fit).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return Coded(scratch.table(coded.unionByName(rest), "coded"), books)


def report(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error (error over equal labels, nulls together; null beyond a long) and the digest of the codebooks; odd rows as in compress()."""
    coded = compress(embeddings)
    total = coded.rows.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    total = total.select(F.col("label").alias("of"), F.when(F.col("total") <= LONG, F.col("total")).cast("long").alias("label_error"))
    joined = coded.rows.join(total, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(coded.digest()).alias("codebooks_sha256"))


def _floor_div(a: str, b: str) -> str:
    return f"(({a}) - (((({a}) % ({b})) + ({b})) % ({b}))) // ({b})"


def report_sql(rounds: int = ROUNDS) -> str:
    """The same in SQL, each round over all parts anew."""
    width = "(SELECT len(x) FROM kept ORDER BY vec_id LIMIT 1)"
    steps = [
        "kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"parts AS MATERIALIZED (SELECT vec_id, label, p, x[p * {width} // {PARTS} + 1:(p + 1) * {width} // {PARTS}] AS x FROM kept, range({PARTS}) r(p))",
        f"book0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS y FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {ENTRIES}))",
    ]
    for k in range(rounds + 1):
        distance = "list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        steps.append(f"near{k} AS MATERIALIZED (SELECT vec_id, any_value(label) AS label, p, any_value(x) AS x, min(({distance})::HUGEINT * {ENTRIES} + e) AS m FROM parts JOIN book{k} USING (p) GROUP BY vec_id, p)")
        if k < rounds:
            mean = _floor_div("sum(v)::HUGEINT", "count(*)")
            steps.append(f"mean{k} AS MATERIALIZED (SELECT p, e, list(CAST(m AS BIGINT) ORDER BY i) AS y FROM (SELECT p, e, i, {mean} AS m FROM (SELECT p, m % {ENTRIES} AS e, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM near{k}) GROUP BY p, e, i) GROUP BY p, e)")
            steps.append(f"book{k + 1} AS MATERIALIZED (SELECT b.p, b.e, COALESCE(n.y, b.y) AS y FROM book{k} b LEFT JOIN mean{k} n ON n.p = b.p AND n.e = b.e)")
    steps += [
        f"coded AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', CAST(m % {ENTRIES} AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(m // {ENTRIES}) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id)",
        f"digest AS (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})",
    ]
    return f"WITH {', '.join(steps)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, digest"
