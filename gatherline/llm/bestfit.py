"""Best-fit packing by the configuration linear program over exact lengths.

Documents longer than a sequence are cut into full pieces after a first, shorter one; all others stay whole. The
histogram of piece lengths (at most ``SEQUENCE`` classes, whatever the corpus) defines a covering program: choose
copies of configurations, multisets of lengths that fit one sequence, so that every class is covered. Multiplicative
weights solve it: a class's price falls exponentially with the share of it that is covered, a bounded knapsack dynamic
program finds the configuration of the greatest price, and a step covers part of its scarcest class. The fractional
copies are rounded down, best filled first and only those that are at least as full as the mean, and what they leave is
placed best-fit decreasing, also into gaps that configurations have. All of that works on counts.

Pieces of a class are ranked; runs of equal fillings take ranks in order, which fixes sequence and offset at once. Only
the histogram and the fillings pass through the driver, and pieces are shuffled once, without their ids.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatherline.llm.bpe import _text_blocks
from gatherline.llm.packing import byte_level
from gatherline.plans.scratch import Scratch

SEQUENCE = 2048
END_ID = 0
#: How fast a price falls with the share covered, and the part of its scarcest class that a step covers.
RATE, STEP = 4.0, 0.5
#: Classes that a round prices: of each band of neighbouring lengths those least covered.
BANDS, PER_BAND = 32, 4
#: The program stops when classes that hold this share of all ids are uncovered, or after so many rounds; what is then
#: uncovered goes to the best-fit stage with what rounding leaves, so nothing is lost.
UNCOVERED, MAX_ROUNDS = 0.03, 8000
#: Passes at most, and how near the bound by total length a pass need not be followed by another.
PASSES, NEAR = 2, 1.005

#: A filling is a tuple of (length, times), a plan a list of (filling, copies).
Filling = tuple[tuple[int, int], ...]


def pieces(documents: DataFrame, path: str, id_col: str, text_col: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, doc_tokens, the task and the piece's number among those of its length in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, end, part = byte_level(path), np.array([END_ID], "<u4").tobytes(), TaskContext.get().partitionId()
        seen = [0] * (SEQUENCE + 1)
        for batch in batches:
            for low, _, texts in _text_blocks(batch.column(1)):
                rows = []
                for k, ids in enumerate(code.encode(texts)):
                    ids += end
                    n = len(ids) // 4
                    at, step, piece = 0, (n - 1) % SEQUENCE + 1, 0
                    while at < n:
                        rows.append((low + k, piece, at, step, zlib.crc32(ids[4 * at : 4 * (at + step)]), n, seen[step]))
                        seen[step] += 1
                        at, step, piece = at + step, SEQUENCE, piece + 1
                row, piece, start, length, crc, total, local = (pa.array(x, pa.int64()) for x in zip(*rows, strict=True))
                yield pa.record_batch(
                    [batch.column(0).take(row), piece.cast(pa.int32()), start, length, crc, total, pa.array(np.full(len(rows), part, np.int32)), local],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "doc_tokens", "part", "local"],
                )

    source = documents.select(documents[id_col].alias("doc_id"), documents[text_col].cast("string").alias("t"))
    kind = dict(source.dtypes)["doc_id"]
    return source.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, doc_tokens long, part int, local long")


def configuration(prices: np.ndarray, sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """The multiset of sizes, none oftener than demanded, that fits the capacity at the greatest price: (index, times)."""
    best, taken = np.zeros(capacity + 1), []
    for j, (price, size, n) in enumerate(zip(prices.tolist(), sizes.tolist(), np.minimum(demand, capacity // sizes).tolist(), strict=True)):
        times = 1
        while n > 0:  # times 1, 2, 4, ... and the rest make up every number up to n
            times = min(times, n)
            width = size * times
            with_it = best[: capacity + 1 - width] + price * times
            better = with_it > best[width:]
            np.copyto(best[width:], with_it, where=better)
            taken.append((j, times, width, better))
            n, times = n - times, times * 2
    out, room = defaultdict(int), capacity
    for j, times, width, better in reversed(taken):
        if room >= width and better[room - width]:
            out[j] += times
            room -= width
    return sorted(out.items())


def fractional(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> dict[tuple[tuple[int, int], ...], float]:
    """Copies of configurations, as (class, times), that cover all but UNCOVERED of the demand, by multiplicative weights.

    Prices begin in proportion to length; where the program's value is not NEAR the bound by total length, a second pass
    begins with the first one's mean prices, which is worth most where large classes cannot be filled up.
    """
    base, ids, draw = sizes.astype(float), sizes * demand, np.random.default_rng(1)
    best: dict[tuple[tuple[int, int], ...], float] = {}
    for _ in range(PASSES):
        covered, copies, prices = np.zeros(len(sizes)), defaultdict(float), np.zeros(len(sizes))
        for _ in range(MAX_ROUNDS):
            if np.maximum(0, 1 - covered) @ ids <= UNCOVERED * ids.sum():
                break
            some = np.flatnonzero(covered < 1 - 1e-9)
            band = np.arange(len(some)) * BANDS // len(some)
            order = np.lexsort((covered[some] + 0.1 * draw.random(len(some)), band))
            rank = np.arange(len(some)) - np.searchsorted(band, band[order])
            some = np.sort(some[order[rank < PER_BAND]])[::-1]
            price = base * np.exp(-RATE * np.minimum(covered, 1))
            found = configuration(price[some], sizes[some], demand[some], capacity)
            at, times = some[[j for j, _ in found]], np.array([k for _, k in found])
            # Not beyond what the class nearest to its demand still lacks, but half a copy at least.
            step = min(STEP * (demand[at] / times).min(), max(STEP, ((1 - covered[at]) * demand[at] / times).min()))
            prices += step * price / (price[at] @ times)
            covered[at] += step * times / demand[at]
            copies[tuple(zip(at.tolist(), times.tolist(), strict=True))] += step
        if not best or sum(copies.values()) < sum(best.values()):
            best = copies
        if sum(copies.values()) * capacity <= NEAR * (1 - UNCOVERED) * ids.sum():
            break
        base = prices
    return best


def best_fit(left: dict[int, int], plan: list[tuple[Filling, int]], capacity: int) -> list[tuple[Filling, int]]:
    """The plan with the lengths that are left added, longest first, each into the smallest gap that takes it."""
    open_: dict[int, list[tuple[Filling, int]]] = defaultdict(list)
    for filling, copies in plan:
        open_[capacity - sum(s * k for s, k in filling)].append((filling, copies))
    gaps = sorted(open_)

    def put(filling: Filling, copies: int, gap: int) -> None:
        if gap not in open_:
            insort(gaps, gap)
        open_[gap].append((filling, copies))

    for size in sorted(left, reverse=True):
        n = left[size]
        while n:
            at = bisect_left(gaps, size)
            if at < len(gaps):
                gap = gaps[at]
                filling, copies = open_[gap].pop()
                if not open_[gap]:
                    del open_[gap], gaps[at]
                placed = min(n, copies)
                if copies > placed:
                    put(filling, copies - placed, gap)
                put((*filling, (size, 1)), placed, gap - size)
            else:
                each = min(n, capacity // size)
                placed = n // each * each
                put(((size, each),), n // each, capacity - each * size)
            n -= placed
    return [run for gap in gaps for run in open_[gap]]


def plan(sizes: np.ndarray, demand: np.ndarray, capacity: int = SEQUENCE) -> list[tuple[Filling, int]]:
    """Fillings with their copies that hold every length exactly as often as demanded."""
    full = sizes == capacity
    done = [(((capacity, 1),), int(n)) for n in demand[full]]
    sizes, demand = sizes[~full].astype(np.int64), demand[~full].astype(np.int64)
    left, rounded, copies = demand.copy(), [], fractional(sizes, demand, capacity)
    gap = {c: capacity - sum(int(sizes[j]) * k for j, k in c) for c in copies}
    mean = sum(gap[c] * x for c, x in copies.items()) / max(sum(copies.values()), 1e-12)
    for config in sorted(copies, key=lambda c: (gap[c], -copies[c], c)):
        if gap[config] > mean:
            break
        # A part of a copy counts as one where almost nothing is left open.
        n = max(int(copies[config] + 1e-9), int(4 * gap[config] <= mean))
        n = min([n, *(int(left[j]) // k for j, k in config)])
        if n:
            rounded.append((tuple((int(sizes[j]), k) for j, k in config), n))
            for j, k in config:
                left[j] -= n * k
    return done + best_fit({int(s): int(n) for s, n in zip(sizes, left, strict=True) if n}, rounded, capacity)


def spans(runs: list[tuple[Filling, int]]) -> dict[int, np.ndarray]:
    """For each length, by rank: the first rank of each run, its first sequence, times in a filling and offset there."""
    rows: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    sequence = 0
    for filling, copies in runs:
        offset = 0
        for size, times in filling:
            rows[size].append((taken[size], sequence, times, offset))
            taken[size] += times * copies
            offset += times * size
        sequence += copies
    return {s: np.array(r, np.int64).T for s, r in rows.items()}


def pack(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Places every document's ids in as few sequences of at most SEQUENCE as the method finds; one row per piece.

    Returns doc_id, piece, start, length, ids_crc32, doc_tokens, sequence_id, offset. Null and empty texts are documents
    of the end id alone; very long texts become full pieces after a shorter first one. A repeated row, or a row without
    an id, is packed each time it occurs. Equal lengths take places by input partition and place in it, so that the same
    files give the same packing. An empty table gives no rows; other columns are not read.
    """
    scratch = Scratch(documents.sparkSession, "bestfit")
    cut = scratch.table(pieces(documents, path, id_col, text_col), "pieces")
    counts = scratch.table(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "counts")
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).orderBy("length").collect()  # at most SEQUENCE rows
    places = spans(plan(np.array([r.length for r in histogram], np.int64), np.array([r.n for r in histogram], np.int64)))

    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranked = cut.join(counts.select("part", "length", F.coalesce(before, F.lit(0)).alias("before")), ["part", "length"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("local")).cast("long").alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (3, 6))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for size in np.unique(length):
                starts, first, times, base = places[int(size)]
                at = np.flatnonzero(length == size)
                k = np.searchsorted(starts, rank[at], "right") - 1
                copy, slot = np.divmod(rank[at] - starts[k], times[k])
                sequence[at], offset[at] = first[k] + copy, base[k] + slot * size
            yield pa.record_batch([*batch.columns[:6], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:6], "sequence_id", "offset"])

    kinds = ", ".join(f"{n} {t}" for n, t in ranked.dtypes if n != "rank")
    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long")
