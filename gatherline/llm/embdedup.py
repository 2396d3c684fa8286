"""Near-duplicate embeddings: tiled comparison in principal-component order.

Vectors are scaled to unit length and turned so that the leading dimensions carry most of the variance. The vectors of
a label are put in order along a Hilbert curve through their leading components and cut into blocks. A block knows the
range of each leading component and of the suffix's norm; two blocks whose ranges lie so far apart that no cosine can
reach the threshold never meet. Those that remain are compared tile by tile: the inner products of the leading
dimensions are accumulated first, the rest is bounded by the product of the suffixes' norms, and a tile stops as soon
as no pair can reach the threshold. Pairs that survive are confirmed in double precision on the vectors as they came.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatherline.llm.components import Forest, components
from gatherline.llm.hilbert import hilbert_keys
from gatherline.operators.rollups import positions
from gatherline.plans.scratch import Scratch

THRESHOLD = 0.93
#: Vectors in a block; a tile holds two blocks.
BLOCK = 512
#: Leading components that blocks are ordered by and bounded in, and bits of each on the curve.
LEADING, BITS = 6, 6
#: Vectors that the rotation is fitted on at most; any rotation gives the same links.
ROTATION_SAMPLE = 4096
STEPS = 4


def usable(vector: str) -> F.Column:
    """Not null, not empty, no null or non-finite component, not all zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def tile_pairs(x: np.ndarray, y: np.ndarray, turn: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with cosine >= threshold between rows of x and rows of y."""
    norms = [np.sqrt((v * v).sum(axis=1)) for v in (x, y)]
    u, v = ((m / n[:, None]) @ turn for m, n in zip((x, y), norms, strict=True))
    width = u.shape[1]
    cuts = sorted({max(1, round(width * k / STEPS)) for k in range(1, STEPS + 1)} | {width})
    products, done = np.zeros((len(u), len(v))), 0
    for cut in cuts:
        products += u[:, done:cut] @ v[:, done:cut].T
        done = cut
        rest = np.sqrt((u[:, cut:] ** 2).sum(axis=1))[:, None] * np.sqrt((v[:, cut:] ** 2).sum(axis=1))[None, :]
        live = products + rest >= threshold - 1e-9
        if not live.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # Few left: finish those pairs alone.
        if cut < width and live.sum() * 8 < live.size:
            break
    left, right = np.nonzero(live)
    exact = (x[left] * y[right]).sum(axis=1) / (norms[0][left] * norms[1][right])
    keep = exact >= threshold
    return left[keep], right[keep]


def _blocks(classes: DataFrame, turns: dict[int, np.ndarray]) -> DataFrame:
    """rep, label, width, block and lead (leading components of the unit vector, then the norm of the rest) of each class.

    Blocks are numbered through along the curves of all labels, where a label's end cuts a block in two; positions come
    from counts per range partition.
    """

    def led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths, leads, keys = batch.column(1).to_numpy(), np.zeros((len(batch), LEADING + 1)), np.zeros(len(batch), np.int64)
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                data = np.stack(batch.column(2).take(pa.array(at)).to_numpy(zero_copy_only=False)).astype(float)
                turned = data / np.sqrt((data * data).sum(axis=1))[:, None] @ turns.get(int(width), np.eye(width))
                some = turned[:, :LEADING]
                leads[at, : some.shape[1]] = some
                leads[at, LEADING] = np.sqrt((turned[:, LEADING:] ** 2).sum(axis=1))
                keys[at] = hilbert_keys(np.clip((leads[at, :LEADING] + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64), BITS)
            yield pa.record_batch([batch.column(0), pa.array(keys), pa.array(list(leads), pa.list_(pa.float64()))], ["rep", "curve", "lead"])

    kind = dict(classes.dtypes)["rep"]
    keyed = classes.select("rep", "width", "embedding").mapInArrow(led, f"rep {kind}, curve long, lead array<double>")
    placed = positions(keyed.join(classes.select("rep", "label", "width"), "rep"), [F.col(c) for c in ("label", "width", "curve", "rep")], "at")
    return placed.select("rep", "label", "width", F.floor((F.col("at") - 1) / BLOCK).alias("block"), "lead")


def link(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links vectors of equal, non-null label whose cosine reaches ``threshold``.

    Returns vec_id, n_links, component_id (smallest vec_id reachable), kept (vec_id = component_id), one row per row.
    Null, empty, zero or non-finite vectors, null labels and vectors of different lengths link with nothing. Equal vectors
    are compared once and counted with their number. Rows that repeat an id are vectors of their own; rows without one
    link as others do, give a component no name and are not kept. Other columns are not read.
    """
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "embdedup")
    rows = scratch.table(embeddings.select("vec_id", "embedding", "label", F.monotonically_increasing_id().alias("row")), "rows")
    part = rows.where(usable("embedding") & F.col("label").isNotNull()).withColumn("width", F.size("embedding"))
    classes = scratch.table(part.groupBy("label", "width", "embedding").agg(F.min("row").alias("rep"), F.min("vec_id").alias("least"), F.count("*").alias("copies")), "classes")
    fitted = classes.orderBy(F.xxhash64("rep")).limit(ROTATION_SAMPLE).select("embedding").collect()
    turns: dict[int, np.ndarray] = {}
    for width in {len(r.embedding) for r in fitted}:
        m = np.array([r.embedding for r in fitted if len(r.embedding) == width], float)
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        turns[width] = np.linalg.eigh(m.T @ m)[1][:, ::-1]
    blocks = scratch.table(_blocks(classes, turns), "blocks")
    ranges = blocks.groupBy("label", "width", "block").agg(*[f(F.col("lead")[i]).alias(f"{n}{i}") for i in range(LEADING + 1) for n, f in (("low", F.min), ("high", F.max))])
    ranges = scratch.table(ranges, "ranges")
    a, b = ranges.alias("a"), ranges.alias("b")
    gap = lambda i: F.greatest(F.lit(0.0), F.col(f"a.low{i}") - F.col(f"b.high{i}"), F.col(f"b.low{i}") - F.col(f"a.high{i}"))
    # Unit vectors of cosine t lie sqrt(2 - 2t) apart; the ranges bound the distance of any two vectors from below.
    apart = sum((gap(i) * gap(i) for i in range(LEADING + 1)), F.lit(0.0))
    meets = (F.col("a.label") == F.col("b.label")) & (F.col("a.width") == F.col("b.width")) & (F.col("a.block") <= F.col("b.block")) & (apart <= 2 - 2 * threshold + 1e-6)
    met = a.join(b, meets).select("a.label", "a.width", F.col("a.block").alias("low"), F.col("b.block").alias("high"))
    met = scratch.table(met, "met")
    sent = met.withColumn("block", F.explode(F.array_distinct(F.array("low", "high"))))
    tiles = blocks.drop("lead").join(sent, ["label", "width", "block"]).join(classes.select("rep", "copies", "embedding"), "rep")

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        width, low, high = int(key[1]), int(key[2]), int(key[3])
        group = group.sort_values("rep", ignore_index=True)
        data = np.stack(group["embedding"].to_numpy()).astype(float)
        ids, copies, block = (group[c].to_numpy() for c in ("rep", "copies", "block"))
        turn = turns.get(width, np.eye(width))
        a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
        left, right = tile_pairs(data[a], data[b], turn, threshold)
        left, right = a[left], b[right]
        if low == high:
            above = left < right
            left, right = left[above], right[above]
        links = np.bincount(left, copies[right], len(ids)) + np.bincount(right, copies[left], len(ids))
        forest = Forest(len(ids))
        for i, j in zip(left.tolist(), right.tolist(), strict=True):
            forest.join(i, j)
        at = np.flatnonzero(links)
        return pd.DataFrame({"a": ids[at], "b": ids[[forest.root(i) for i in at.tolist()]] if len(at) else ids[at], "links": links[at].astype(np.int64)})

    found = tiles.groupBy("label", "width", "low", "high").applyInPandas(compare, "a long, b long, links long")
    found = scratch.table(found, "found")
    group = components(found.where("a <> b").select("a", "b"), scratch)
    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    summary = classes.select("rep", "least", "copies").join(links, "rep", "left").join(group.withColumnRenamed("node", "rep"), "rep", "left")
    summary = scratch.table(summary.select("rep", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component")), "summary")
    names = summary.groupBy("component").agg(F.min("least").alias("name"))
    member = scratch.table(part.join(classes.select("label", "width", "embedding", "rep"), ["label", "width", "embedding"]).select("row", "rep"), "member")
    linked = member.join(summary.join(names, "component").select("rep", "n_links", "name"), "rep").select("row", "n_links", "name")
    joined = rows.select("row", "vec_id").join(linked, "row", "left")
    out = joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("name")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(False)))
