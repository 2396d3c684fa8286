"""Packing of documents into fixed-length training sequences by cutting-stock column generation.

Documents are cut into full sequences and one remainder each. The remainders' lengths, rounded up to a multiple of
``GRAIN``, make a histogram of bounded size (a few hundred classes for any corpus); a linear program over packing
patterns is solved on it by column generation, where a knapsack dynamic program prices new patterns, and its solution
is rounded down, with what is left placed first-fit decreasing, all on counts. Every remainder has a rank in its
class, and pattern copies take ranks in order. Only the histogram and the patterns pass through the driver.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatherline.llm.bpe import _text_blocks, byte_symbols
from gatherline.llm.presplit import split
from gatherline.plans.scratch import Scratch

SEQUENCE = 2048
GRAIN = 8
END_ID = 1
#: Bytes of words and their ids that a task keeps; beyond that it starts afresh.
KEPT_BYTES = 96 << 20
#: The linear program stops when its value is this close to its lower bound.
GAP = 2e-4
MAX_COLUMNS = 4000


class ByteLevel:
    """Ids of whole texts for a byte-level BPE tokenizer file; words met before are looked up."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        vocab = spec["model"]["vocab"]
        value = {symbol: byte for byte, symbol in byte_symbols().items()}
        ranks = {bytes(value[c] for c in token): i for token, i in vocab.items() if token not in self.special}
        base = {token: i for token, i in ranks.items() if len(token) == 1}
        order = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        made = {bytes(value[c] for c in a + b): 256 + k for k, (a, b) in enumerate(order)}
        # Ranks must follow the merges' order; ids are restored afterwards.
        by_rank = {token: k for k, token in enumerate([*base, *made])}
        self.id_of = np.array([ranks[t] for t in by_rank], "<u4")
        self.code = tiktoken.Encoding("bytes", pat_str=r"[\s\S]+", mergeable_ranks=by_rank, special_tokens={})
        self.known: dict[str, bytes] = {}
        self.kept = 0

    def _learn(self, word: str) -> bytes:
        known = self.known[word] = self.id_of[self.code._encode_single_piece(word.encode())].tobytes()
        self.kept += 4 * len(word) + len(known) + 200
        return known

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian 32-bit integers."""
        if self.kept > KEPT_BYTES:
            self.known, self.kept = {}, 0
        pieces, layout = [], []
        for text in texts:
            row = []
            for k, part in enumerate(self.pattern.split(text) if self.pattern and "<|" in text else [text]):
                if k % 2:
                    row.append(-self.special[part] - 1)
                else:
                    row.append(len(pieces))
                    pieces.append(part)
            layout.append(row)
        words, order, firsts = split(pieces, blank_joins=True, single_numbers=False)
        coded = list(map(self.known.get, words))
        for i in [i for i, known in enumerate(coded) if known is None]:
            coded[i] = self._learn(words[i])
        order, first = order.tolist(), firsts.tolist()
        out = []
        for row in layout:
            ids = [np.array([-p - 1], "<u4").tobytes() if p < 0 else b"".join([coded[i] for i in order[first[p] : first[p + 1]]]) for p in row]
            out.append(b"".join(ids))
        return out


@lru_cache(maxsize=2)
def byte_level(path: str) -> ByteLevel:
    return ByteLevel(path)


def pieces(documents: DataFrame, path: str, id_col: str, text_col: str) -> DataFrame:
    """Each document's ids cut at multiples of SEQUENCE: doc_id, start, length, ids_crc32, doc_tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, end = byte_level(path), np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for low, _, texts in _text_blocks(batch.column(1)):
                at, start, length, crc, total = [], [], [], [], []
                for k, ids in enumerate(code.encode(texts)):
                    ids += end
                    for s in range(0, len(ids), 4 * SEQUENCE):
                        part = ids[s : s + 4 * SEQUENCE]
                        at.append(low + k)
                        start.append(s // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        total.append(len(ids) // 4)
                yield pa.record_batch([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    source = documents.select(documents[id_col].alias("doc_id"), documents[text_col].cast("string").alias("t"))
    kind = dict(source.dtypes)["doc_id"]
    return source.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def _knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best value of a multiset of sizes within the capacity, and how often each is taken."""
    best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fit = int(np.searchsorted(sizes, room, "right"))
        best[room] = best[room - 1]
        if fit:
            gain = best[room - sizes[:fit]] + values[:fit]
            k = int(gain.argmax())
            if gain[k] > best[room] + 1e-12:
                best[room], take[room] = gain[k], k
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if take[room] < 0:
            room -= 1
        else:
            pattern[take[room]] += 1
            room -= sizes[take[room]]
    return float(best[capacity]), pattern


def patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns (how often each size occurs in it) with their whole numbers of copies that meet the demand exactly or more."""
    m = len(sizes)
    if m == 0:
        return []
    sizes, demand = sizes.astype(np.int64), demand.astype(np.int64)
    columns = [np.where(np.arange(m) == j, capacity // sizes[j], 0) for j in range(m)]
    inverse = np.diag(1.0 / (capacity // sizes))
    level = inverse @ demand
    centre, bound = sizes / capacity, 0.0
    for _ in range(MAX_COLUMNS):
        prices = inverse.sum(axis=0)
        # Prices drawn towards the best feasible dual so far swing less; only the plain ones can prove the end.
        for drawn in (0.8, 0.4, 0.0):
            asked = drawn * centre + (1 - drawn) * prices
            value, pattern = _knapsack(asked, sizes, capacity)
            if demand @ asked / max(value, 1e-12) > bound:
                centre, bound = asked / value, demand @ asked / value
            if prices @ pattern > 1 + 1e-9:
                break
        else:
            break
        if level.sum() - bound <= GAP * level.sum():
            break
        way = inverse @ pattern
        up = way > 1e-9
        ratio = np.where(up, level / np.where(up, way, 1), np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        level -= step * way
        level[out] = step
        row = inverse[out] / way[out]
        inverse -= np.outer(way, row)
        inverse[out] = row
        columns[out] = pattern
    copies = np.floor(np.maximum(level, 0) + 1e-9).astype(np.int64)
    plan = [(c, int(k)) for c, k in zip(columns, copies, strict=True) if k > 0]
    left = demand - sum((c * k for c, k in plan), np.zeros(m, np.int64))
    left = np.maximum(left, 0)
    # What rounding leaves: largest first into one open sequence after another, copies of a filling at once.
    while left.any():
        room, filling = capacity, np.zeros(m, np.int64)
        for j in range(m - 1, -1, -1):
            n = min(int(left[j]), room // int(sizes[j]))
            filling[j] = n
            room -= n * int(sizes[j])
        used = filling > 0
        times = int((left[used] // filling[used]).min())
        plan.append((filling, times))
        left = left - filling * times
    return plan


def pack(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Places every document's ids in sequences of at most SEQUENCE; one row per piece.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Null and empty texts are documents of
    the end id alone; a repeated row is packed each time it occurs; an empty table gives no rows. Equal lengths are
    ranked by document, start and partition, so a repeated run gives the same packing of the same files.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "packing")
    grain = F.ceil(F.col("length") / GRAIN).cast("int")
    cut = scratch.table(pieces(documents, path, id_col, text_col).withColumns({"size": grain, "part": F.spark_partition_id()}), "pieces")
    counts = scratch.table(cut.groupBy("part", "size").count(), "counts")
    histogram = counts.groupBy("size").agg(F.sum("count").alias("n")).orderBy("size").collect()  # at most SEQUENCE / GRAIN rows
    sizes, demand = np.array([r.size for r in histogram], np.int64), np.array([r.n for r in histogram], np.int64)
    spans = _spans(sizes, patterns(sizes, demand, SEQUENCE // GRAIN))

    before = F.coalesce(F.sum("count").over(Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("part", "size", before.alias("before"))
    ranked = (
        cut.withColumn("local", F.row_number().over(Window.partitionBy("part", "size").orderBy("doc_id", "start", "ids_crc32")) - 1)
        .join(offsets, ["part", "size"])
        .withColumn("rank", (F.col("before") + F.col("local")).cast("long"))
        .drop("before", "local", "part")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("size", "rank"))
            sequence = np.zeros(len(size), np.int64)
            for s in np.unique(size):
                starts, first, per = spans[int(s)]
                at = np.flatnonzero(size == s)
                k = np.searchsorted(starts, rank[at], "right") - 1
                sequence[at] = first[k] + (rank[at] - starts[k]) // per[k]
            yield batch.append_column("sequence_id", pa.array(sequence))

    placed = ranked.mapInArrow(place, f"{', '.join(f'{n} {t}' for n, t in ranked.dtypes)}, sequence_id long")
    order = Window.partitionBy("sequence_id").orderBy(F.desc("size"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(F.sum("length").over(order), F.lit(0)).cast("long").alias("offset"))


def _spans(sizes: np.ndarray, plan: list[tuple[np.ndarray, int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each size the ranks at which its runs of pattern copies begin, their first sequence and their pieces a sequence."""
    rows: dict[int, list[tuple[int, int, int]]] = {int(s): [] for s in sizes}
    taken, sequence = dict.fromkeys(rows, 0), 0
    for pattern, copies in plan:
        for j in np.flatnonzero(pattern):
            s = int(sizes[j])
            rows[s].append((taken[s], sequence, int(pattern[j])))
            taken[s] += int(pattern[j]) * copies
        sequence += copies
    return {s: tuple(np.array(x, np.int64) for x in zip(*r, strict=True)) for s, r in rows.items() if r}
