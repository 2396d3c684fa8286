"""Near-duplicate documents by fast similarity sketching.

A document is its set of distinct word shingles, as 64-bit hashes. Its sketch has T bins: in round i every shingle is
thrown into a hashed bin with a value that starts at i, so later rounds only fill bins that are still empty; from
round T on, all shingles go to bin i - T, so 2T rounds fill every bin. Most sketches are full after a few rounds, and
bin-wise agreement estimates the Jaccard similarity with the concentration of independent samples. Bands of bins give
candidate keys.

Equal sets form one class and are looked at once. Within a key every class is compared with one leader, so the pairs
grow with the rows, not with the squares of groups; pairs are confirmed on full sets. Keys whose members are then not
all connected are settled exactly, in tiles bounded in classes and in shingles. Members of keys that hang together are
one tile where they are few. Else they are compared key by key, or block against block, whichever moves fewer sets;
blocks meet only where their set sizes are alike and their members are not yet known to be connected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatherline.llm.blocks import LOWER, U64, blocks, mix, words
from gatherline.llm.components import Forest, components
from gatherline.llm.wordhash import word_names
from gatherline.plans.scratch import Scratch

BANDS, ROWS = 40, 6
BINS = BANDS * ROWS
#: Similarity in hundredths from which documents are linked.
PERCENT = 80
#: Classes, and shingles in all, of a block of the exact comparison (one set more at most).
BLOCK, BLOCK_SHINGLES = 256, 1 << 21
COLUMNS = 1 << 14
_BLOCK = "struct<g:int,owner:bigint,part:int>"


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all documents of a block, in order, and the first of each document.

    A document with fewer than ``width`` words has its whole word sequence as one shingle; without words it has none.
    """
    data = LOWER[data]
    starts, ends, firsts = words(data, offsets)
    n = np.diff(firsts)
    word = word_names(data, starts, ends)
    doc = np.repeat(np.arange(len(n)), n)
    m = len(word) - width + 1
    found, owner = np.zeros(0, U64), np.zeros(0, np.int64)
    if m > 0:
        found = np.zeros(m, U64)
        for k in range(width):
            found = mix(found * U64(0x9E3779B97F4A7C15) + word[k : k + m])
        same = doc[:m] == doc[width - 1 :]
        found, owner = found[same], doc[:m][same]
    for i in np.flatnonzero((n > 0) & (n < width)):
        part = U64(0x5851F42D4C957F2D)
        for w in word[firsts[i] : firsts[i + 1]]:
            part = mix(np.array([part]) * U64(0x9E3779B97F4A7C15) + w)[0]
        found, owner = np.append(found, part), np.append(owner, i)
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return found[new], np.searchsorted(owner[new], np.arange(len(n) + 1))


def sketch(found: np.ndarray, firsts: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` values for each document that has shingles (other rows stay at the largest value)."""
    n = len(firsts) - 1
    size = np.diff(firsts)
    out = np.full(n * bins, np.iinfo(np.uint64).max, U64)
    doc = np.repeat(np.arange(n), size)
    open_docs = size > 0
    for turn in range(2 * bins):
        if not open_docs.any():
            break
        some = open_docs[doc]
        x, owner = found[some], doc[some]
        h = mix(x + U64((turn + 1) * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF))
        value = (U64(turn) << U64(40)) | (h & U64((1 << 40) - 1))
        place = ((h >> U64(40)) % U64(bins)).astype(np.int64) if turn < bins else np.full(len(x), turn - bins)
        np.minimum.at(out, owner * bins + place, value)
        full = (out.reshape(n, bins) != np.iinfo(np.uint64).max).all(axis=1)
        open_docs &= ~full
    return out.reshape(n, bins)


def band_keys(sketches: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band of each sketch; keys of different bands differ."""
    parts = sketches.reshape(len(sketches), bands, rows)
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=U64)), parts.shape[:2]).copy()
    for k in range(rows):
        key = mix(key * U64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key.view(np.int64)


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity: 100 * intersection >= percent * union."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def block_links(sets: list[np.ndarray], group: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between the two sides of a tile that join different groups, as few as connect the same documents.

    side: 1 first block only, 2 second block only, 3 both (a tile of a block with itself).
    """
    n = len(sets)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), size)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = times[column] > 1
    owner, column = owner[keep], np.cumsum(times > 1)[column[keep]] - 1
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    left, right = np.flatnonzero(side & 1), np.flatnonzero(side & 2)
    both = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        dense = np.zeros((n, COLUMNS), np.float32)
        dense[owner[a:b], column[a:b] - low] = 1
        both += dense[left] @ dense[right].T
    union = size[left][:, None] + size[right][None, :] - both
    ok = (100 * both >= percent * union) & (group[left][:, None] != group[right][None, :])
    forest, out = Forest(n), []
    where = {}
    for i, g in enumerate(group.tolist()):
        forest.join(where.setdefault(g, i), i)
    for i, j in zip(*np.nonzero(ok), strict=True):
        i, j = int(left[i]), int(right[j])
        if i != j and forest.join(i, j):
            out.append((i, j))
    return out


def sketches(documents: DataFrame, width: int) -> DataFrame:
    """doc_id, mark, n_shingles, digest of the set (null if empty) and band keys of every row of (doc_id, mark, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in blocks(batch.column(2), rows=4096):
                found, firsts = shingles(data, offsets, width)
                keys = band_keys(sketch(found, firsts))
                n = np.diff(firsts)
                digest = [hashlib.blake2b(found[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
                bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]), pa.int32()), pa.array(keys[n > 0].ravel()))
                yield pa.record_batch([*(batch.column(i).slice(low, high - low) for i in (0, 1)), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), bands], ["doc_id", "mark", "n_shingles", "digest", "bands"])

    return documents.mapInArrow(run, "doc_id long, mark binary, n_shingles long, digest binary, bands array<long>")


def full_sets(texts: DataFrame, width: int) -> DataFrame:
    """digest and the sorted shingle hashes, as bytes, of every row of (text) that has any; each set once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[bytes] = set()
        for batch in batches:
            for _, _, data, offsets in blocks(batch.column(0), rows=4096):
                found, firsts = shingles(data, offsets, width)
                sets = [found[a:b].tobytes() for a, b in zip(firsts[:-1], firsts[1:], strict=True) if b > a]
                some = {hashlib.blake2b(x, digest_size=16).digest(): x for x in sets}
                new = [(k, x) for k, x in some.items() if k not in done]
                done.update(some)
                yield pa.record_batch([pa.array([k for k, _ in new], pa.binary()), pa.array([x for _, x in new], pa.binary())], ["digest", "shingles"])

    return texts.mapInArrow(run, "digest binary, shingles binary").dropDuplicates(["digest"])


def _mark(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def _components(documents: DataFrame, width: int, percent: int, id_col: str, text_col: str, scratch: Scratch, same_id: bool) -> tuple[DataFrame, DataFrame]:
    """Rows (row, doc_id, mark, n_shingles, digest), and of every digest its component and the least doc_id in that.

    same_id: texts under one id hang together.
    """
    source = documents.select(F.col(id_col).cast("long").alias("doc_id"), _mark(F.col(text_col)).alias("mark"), F.col(text_col).cast("string").alias("text"))
    seen = scratch.table(sketches(source, width).withColumn("row", F.monotonically_increasing_id()), "sketches")
    usable = seen.where("digest IS NOT NULL")
    classes = usable.groupBy("digest").agg(F.min("row").alias("rep"), F.min("doc_id").alias("name"), F.min_by("doc_id", "row").alias("of"), F.first("bands").alias("bands"), F.first("n_shingles").alias("size"))
    classes = scratch.table(classes, "classes")
    keys = scratch.table(classes.select("rep", "size", F.explode("bands").alias("key")), "keys")
    leaders = keys.groupBy("key").agg(F.min("rep").alias("leader"), F.count("*").alias("n")).where("n > 1")
    leaders = scratch.table(leaders, "leaders")
    member = scratch.table(keys.join(leaders, "key").select("key", "n", "leader", "rep", "size"), "members")
    scratch.drop("keys")
    pairs = scratch.table(member.where("leader <> rep").select("leader", "rep").distinct(), "pairs")
    wanted = scratch.table(member.select("rep").distinct().join(classes.select("rep", "digest", "of"), "rep"), "wanted")
    texts = source.join(wanted.select("of").distinct(), F.col("doc_id").eqNullSafe(F.col("of")), "left_semi").select("text")
    sets = scratch.table(full_sets(texts, width).join(wanted.select("digest", "rep"), "digest").select("rep", "shingles"), "sets")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [alike(np.frombuffer(x, U64), np.frombuffer(y, U64), percent) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            keep = batch.filter(pa.array(ok, pa.bool_()))
            yield pa.record_batch([keep.column(0), keep.column(1)], ["a", "b"])

    one = pairs.join(sets.select("rep", F.col("shingles").alias("x")), "rep")
    two = one.join(sets.select(F.col("rep").alias("leader"), F.col("shingles").alias("y")), "leader")
    star = scratch.table(two.select("leader", "rep", "x", "y").mapInArrow(confirm, "a long, b long"), "star")
    if same_id:
        several = usable.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a <> b").select("doc_id")
        held = usable.join(several, "doc_id").select("doc_id", "digest").distinct().join(classes.select("digest", "rep"), "digest")
        held = scratch.table(held.select("doc_id", "rep"), "held")
        star = star.unionByName(held.join(held.groupBy("doc_id").agg(F.min("rep").alias("a")), "doc_id").select("a", F.col("rep").alias("b")))
    first = components(star, scratch, "first")
    rest = _settle(member, first, sets, scratch, percent)
    # What was settled joins whole components: only their names are linked.
    last = components(rest, scratch, "last").select(F.col("node").alias("component"), F.col("component").alias("further"))
    named = classes.select("digest", "rep", "name").join(first.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("digest", "name", F.coalesce("component", "rep").alias("component"), F.col("component").isNotNull().alias("near")).join(last, "component", "left")
    named = named.select("digest", "name", F.coalesce("further", "component").alias("component"), (F.col("near") | F.col("further").isNotNull()).alias("linked"))
    named = scratch.table(named, "linked")
    least = named.where("linked").groupBy("component").agg(F.min("name").alias("least"))
    named = named.join(least, "component", "left").select("digest", "component", F.when(F.col("linked"), F.col("least")).otherwise(F.col("name")).alias("least"))
    return seen.drop("bands"), scratch.table(named, "named")


def group(documents: DataFrame, width: int = 5, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups near-duplicate documents; one row per row of ``documents``.

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included), kept (doc_id =
    component_id). Texts that are null, empty or without words have no shingles and link with nothing. Rows that repeat
    an id are one document with all their texts' links. Rows without an id are linked as others are, give no name to a
    component (null if no row of it has an id) and are not kept. Other columns are not read; an empty table gives no rows.
    """
    scratch = Scratch(documents.sparkSession, "minhash")
    rows, named = _components(documents, width, percent, id_col, text_col, scratch, same_id=True)
    out = rows.join(named, "digest", "left").select("doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(False)))


def _settle(member: DataFrame, first: DataFrame, sets: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Components linked by pairs that the leaders missed: exact comparison among the members of keys that are not yet one component."""
    grouped = member.where("n > 2").join(first.withColumnRenamed("node", "rep"), "rep", "left").select("key", "n", "leader", "rep", "size", F.coalesce("component", "rep").alias("component"))
    grouped = scratch.table(grouped, "grouped")
    split = scratch.table(grouped.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key"), "split")
    mixed = scratch.table(grouped.join(split, "key", "left_semi"), "mixed")
    bounded = lambda n, items: (n <= BLOCK) & (items <= BLOCK_SHINGLES)
    tile = ["kind", "name", "low", "high"]
    whole = lambda df, kind, name: df.select(F.lit(kind).alias("kind"), F.col(name).alias("name"), F.lit(None).cast(_BLOCK).alias("low"), F.lit(None).cast(_BLOCK).alias("high"), F.lit(3).alias("side"), "rep", "component")
    # Keys that share members hang together as a lump.
    lumps = components(mixed.select(F.col("leader").alias("a"), F.col("rep").alias("b")), scratch, "lumps").select(F.col("node").alias("rep"), F.col("component").alias("lump"))
    docs = scratch.table(mixed.select("rep", "component", "size").distinct().join(lumps, "rep"), "docs")
    total = docs.groupBy("lump").agg(bounded(F.count("*"), F.sum("size")).alias("fits"))
    # Alike sets differ in size by a quarter at most (at 80 in a hundred): they lie in one class of sizes g, or in two
    # that are neighbours. A block holds members of one class; a large component has blocks of its own, the others share.
    g = F.floor(F.log("size") / F.lit(float(np.log(100 / percent) * (1 + 1e-9)))).cast("int")
    loose = docs.join(total, "lump").where("NOT fits").withColumn("g", g)
    sized = loose.groupBy("lump", "g", "component").agg(F.count("*").alias("n"), F.sum("size").alias("items"))
    sized = sized.withColumn("owner", F.when(~bounded(F.col("n"), F.col("items")), F.col("component")).otherwise(-1))
    sized = scratch.table(sized, "sized")
    parts = sized.groupBy("lump", "g", "owner").agg(F.ceil(F.greatest(F.sum("n") / BLOCK, F.sum("items") / BLOCK_SHINGLES)).cast("int").alias("parts"), F.sum("n").alias("n"))
    parts = scratch.table(parts, "parts")
    there = parts.select("lump", F.col("g").alias("h"), F.col("owner").alias("owner_2"), F.col("parts").alias("parts_2"))
    near = parts.withColumn("h", F.explode(F.array(F.col("g") - 1, F.col("g"), F.col("g") + 1))).join(there, ["lump", "h"]).where("owner = -1 OR owner <> owner_2")
    near = scratch.table(near, "near")
    by_blocks = near.groupBy("lump").agg(F.sum(F.col("n") * F.col("parts_2")).alias("moved"))
    # The same lump key by key, keys with the same members once.
    members = F.struct(F.count("*"), F.sum(F.xxhash64("rep").cast("decimal(20,0)")), F.min("rep"))
    keys = mixed.groupBy("key").agg(F.min("leader").alias("leader"), F.count("*").alias("n"), F.sum("size").alias("items"), members.alias("members"))
    # All of a key lies in the lump of its leader.
    keys = keys.join(lumps.join(by_blocks, "lump").withColumnRenamed("rep", "leader"), "leader")
    keys = scratch.table(keys.groupBy("members").agg(F.min("key").alias("key"), F.first("lump").alias("lump"), F.first("n").alias("n"), F.first("items").alias("items")).drop("members"), "key-sizes")
    by_keys = keys.groupBy("lump").agg(F.sum("n").alias("keyed"), F.min(bounded(F.col("n"), F.col("items"))).alias("all_fit"))
    way = scratch.table(by_blocks.join(by_keys, "lump").select("lump", (F.col("all_fit") & (F.col("keyed") < F.col("moved"))).alias("by_key")), "way")

    small = whole(docs.join(total.where("fits"), "lump"), 0, "lump")
    keyed = whole(mixed.join(keys.join(way.where("by_key"), "lump").select("key"), "key"), 1, "key")
    at = loose.join(way.where("NOT by_key"), "lump").join(sized.select("lump", "g", "component", "owner"), ["lump", "g", "component"])
    at = at.join(near.drop("n"), ["lump", "g", "owner"])
    block = F.pmod(F.when(F.col("owner") == -1, F.xxhash64("component")).otherwise(F.xxhash64("rep")), "parts").cast("int")
    mine = F.struct("g", "owner", block.alias("part")).cast(_BLOCK)
    at = at.withColumn("mine", mine).withColumn("part_2", F.explode(F.sequence(F.lit(0), F.col("parts_2") - 1)))
    theirs = F.struct(F.col("h").alias("g"), F.col("owner_2").alias("owner"), F.col("part_2").alias("part")).cast(_BLOCK)
    side = F.when(F.col("mine") == theirs, 3).when(F.col("mine") < theirs, 1).otherwise(2)
    blocked = at.select(F.lit(2).alias("kind"), F.col("lump").alias("name"), F.least("mine", theirs).alias("low"), F.greatest("mine", theirs).alias("high"), side.alias("side"), "rep", "component")
    tiles = small.unionByName(keyed).unionByName(blocked).join(sets, "rep")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep", ignore_index=True)
        group = rows["component"].to_numpy()
        found = block_links([np.frombuffer(s, U64) for s in rows["shingles"]], group, rows["side"].to_numpy(), percent)
        return pd.DataFrame([(group[i], group[j]) for i, j in found], columns=["a", "b"])

    return scratch.table(tiles.groupBy(*tile).applyInPandas(compare, "a long, b long"), "rest")


def deduplicate(documents: DataFrame, width: int = 5, percent: int = PERCENT) -> DataFrame:
    """The rows of ``documents`` that are kept: of each group of alike texts the one with the smallest id, of repeated rows one.

    Texts are told apart by themselves: a different text under the same id stays, and rows without an id are compared
    as others are (one is kept only where no row of its group has an id). Texts without words all stay.
    """
    scratch = Scratch(documents.sparkSession, "deduplicate")
    rows, named = _components(documents, width, percent, "doc_id", "text", scratch, same_id=False)
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark")
    kept = rows.join(named, "digest").groupBy("component").agg(F.min(order).alias("k")).select(F.col("k.doc_id").alias("__id"), F.col("k.mark").alias("__kept"))
    kept = scratch.table(kept, "kept")
    worded = F.coalesce(documents["text"].cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    marked = documents.where(worded).withColumn("__mark", _mark(F.col("text")))
    one = marked.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__mark") == F.col("__kept")), "left_semi").dropDuplicates(["doc_id", "__mark"])
    return one.select(*documents.columns).unionByName(documents.where(~worded))
