"""Approximate nearest neighbours along shifted Hilbert curves.

Vectors are projected at random to a few dimensions, shifted, and put in the order of a Hilbert curve; several such
orderings are made. Each ordering is dealt by key range into blocks of like size; a query meets the blocks within its
window on every curve, and what the windows find is merged and reranked by exact inner products on the vectors as they
came. How wide the windows must be depends on the data: a bounded number of queries is first answered exactly, and of
the choices of curves and window that hold the wanted share of their true neighbours the cheapest is taken. Clustered
vectors need narrow windows at any size; vectors without structure need most of the table, as with any index.

Equal vectors are one class that is looked at once and stands for its rows with the smallest ids, so that a frequent
vector makes no block large and ties are broken exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatherline.llm.embdedup import usable
from gatherline.llm.hilbert import hilbert_keys
from gatherline.plans.scratch import Scratch

#: Orderings that are tried, and used at least.
CURVES, LEAST_CURVES = 10, 2
DIMENSIONS, BITS = 8, 4
#: Queries that are answered exactly to set the windows, and the share of their neighbours that these must hold.
PROBES, RECALL = 128, 0.94
#: Rows of a block at most, and blocks at least.
BLOCK, LEAST_BLOCKS = 4096, 48
SALT_BITS = 20


def projection(curve: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The curve's random orthonormal projection and its shift, the same in every task."""
    rng = np.random.default_rng([curve, width])
    return np.linalg.qr(rng.normal(size=(width, min(DIMENSIONS, width))))[0], rng.uniform(-0.5, 0.5, min(DIMENSIONS, width))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of an Arrow list column as rows of doubles."""
    return np.stack(column.to_numpy(zero_copy_only=False)).astype(float) if len(column) else np.zeros((0, width))


def best(names: np.ndarray, data: np.ndarray, query: np.ndarray, products: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the k rows of largest inner product, ties to the smaller name; products are approximate to rounding."""
    some = np.arange(len(names))
    if len(some) > k:
        least = np.partition(products, len(some) - k)[len(some) - k]
        some = np.flatnonzero(products >= least - 1e-9 * (1 + abs(least)))
    exact = (data[some] * query).sum(axis=1)
    order = np.lexsort((names[some], -exact))[:k]
    return some[order], exact[order]


@dataclass
class Curves:
    """The orderings in use: the borders between the blocks of each, and how many blocks to each side a window reaches."""

    borders: list[np.ndarray]
    reach: int

    @property
    def share(self) -> float:
        """Comparisons made, as a share of those of an exhaustive search."""
        met = [np.arange(len(b) + 1) for b in self.borders]
        return sum(float((np.minimum(at + self.reach, at[-1]) - np.maximum(at - self.reach, 0) + 1).mean() / len(at)) for at in met)


def _homes(borders: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(b, keys[:, c], "right") for c, b in enumerate(borders)], axis=1)


def _choose(keyed: DataFrame, borders: list[np.ndarray], k: int) -> Curves:
    """The number of curves and the reach, cheapest first, that hold RECALL of the true neighbours of PROBES queries.

    Every task keeps its k best classes for each probe, and of those the k best of all remain; only these reach the driver.
    """
    probes = keyed.where("asked").orderBy(F.xxhash64("class"), "class").limit(PROBES).select("class", "embedding", "keys").collect()
    if not probes:
        return Curves(borders[:LEAST_CURVES], 0)
    asked = np.array([r["class"] for r in probes], np.int64)
    queries = np.array([r.embedding for r in probes], float)

    def nearest(batches):
        ids, scores, home = np.zeros((len(asked), 0), np.int64), np.zeros((len(asked), 0)), np.zeros((len(asked), 0, len(borders)), np.int64)
        for batch in batches:
            if not len(batch):
                continue
            own = batch.column(0).to_numpy()
            products = queries @ matrix(batch.column(1), queries.shape[1]).T
            products[asked[:, None] == own[None, :]] = -np.inf
            at = _homes(borders, np.stack(batch.column(2).to_numpy(zero_copy_only=False)))
            ids = np.concatenate([ids, np.broadcast_to(own, products.shape)], axis=1)
            scores = np.concatenate([scores, products], axis=1)
            home = np.concatenate([home, np.broadcast_to(at, (len(asked), *at.shape))], axis=1)
            top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            ids, scores, home = (np.take_along_axis(x, top if x.ndim == 2 else top[:, :, None], axis=1) for x in (ids, scores, home))
        for i in range(len(asked)):
            fine = np.flatnonzero(np.isfinite(scores[i]))
            yield pa.record_batch([pa.array(np.full(len(fine), i, np.int32)), pa.array(ids[i][fine]), pa.array(scores[i][fine]), pa.array(home[i][fine].tolist(), pa.list_(pa.int64()))], ["probe", "class", "score", "home"])

    found = keyed.select("class", "embedding", "keys").mapInArrow(nearest, "probe int, class long, score double, home array<long>")
    order = Window.partitionBy("probe").orderBy(F.desc("score"), "class")
    rows = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).select("probe", "home").collect()  # PROBES * k at most
    if not rows:
        return Curves(borders[:LEAST_CURVES], 0)
    mine = _homes(borders, np.array([r["keys"] for r in probes], np.int64))
    away = np.minimum.accumulate(np.abs(np.array([r.home for r in rows]) - mine[[r.probe for r in rows]]), axis=1)
    choices = [Curves(borders[:c], int(np.quantile(away[:, c - 1], RECALL, method="inverted_cdf"))) for c in range(LEAST_CURVES, len(borders) + 1)]
    return min(choices, key=lambda x: x.share)


def order(classes: DataFrame, width: int, n: int, square: float, k: int, scratch: Scratch) -> tuple[DataFrame, Curves]:
    """Classes of one width with their keys on every curve, and the curves and windows that the data ask for."""
    scale = float(np.sqrt(max(square, 1e-300) / width))

    def keys(batches):
        for batch in batches:
            data, found = matrix(batch.column(3), width), []
            for c in range(CURVES):
                axes, shift = projection(c, width)
                cells = np.clip(((data @ axes / scale + shift + 3.5) / 7 * (1 << BITS)), 0, (1 << BITS) - 1).astype(np.int64)
                found.append(hilbert_keys(cells, BITS))
            yield batch.append_column("keys", pa.array(list(np.stack(found, axis=1)), pa.list_(pa.int64())))

    kind = dict(classes.dtypes)["embedding"]
    keyed = classes.select("class", "least", "asked", "embedding").mapInArrow(keys, f"class long, least long, asked boolean, embedding {kind}, keys array<long>")
    # Equal keys are spread by a hash, so that a dense cell fills several blocks.
    salt = F.pmod(F.xxhash64("class"), F.lit(1 << SALT_BITS))
    keyed = scratch.table(keyed.withColumn("keys", F.transform("keys", lambda x: F.shiftleft(x, SALT_BITS) + salt)), f"keyed-{width}")
    blocks = max(LEAST_BLOCKS, -(-n // BLOCK))
    shares = [i / blocks for i in range(1, blocks)]
    cuts = keyed.select(*[F.percentile_approx(F.col("keys")[c], shares, F.lit(max(10_000, 20 * blocks))) for c in range(CURVES)]).first()
    return keyed, _choose(keyed, [np.unique(q) for q in cuts], k)


def _hits(keyed: DataFrame, curves: Curves, width: int, every: int, k: int) -> DataFrame:
    """For each asked class the k best classes of each block that its windows meet: query, class, least, score.

    A group is one block with the queries of ``every`` home blocks beside one another, of which about one row in
    ``every`` asks: it holds about two blocks of rows, and every + 1 at most.
    """
    kind, reach, borders = dict(keyed.dtypes)["embedding"], curves.reach, curves.borders
    names = ["curve", "block", "part", "asks", "class", "least", "embedding"]

    def dealt(batches):
        for batch in batches:
            homes = _homes(borders, np.stack(batch.column(4).to_numpy(zero_copy_only=False))) if len(batch) else np.zeros((0, len(borders)), np.int64)
            asked = np.flatnonzero(batch.column(2).to_numpy(zero_copy_only=False))
            for c, border in enumerate(borders):
                home = homes[:, c]

                def sent(at, block, part, asks, c=c):
                    take = pa.array(at)
                    fixed = [np.full(len(at), c), block, part, np.full(len(at), asks)]
                    return pa.record_batch([*(pa.array(x.astype(np.int32)) for x in fixed), *(batch.column(i).take(take) for i in (0, 1, 3))], names)

                low, high = np.maximum(home - reach, 0) // every, np.minimum(home + reach, len(border)) // every
                for step in range(int((high - low).max(initial=0)) + 1):
                    at = np.flatnonzero(low + step <= high)
                    yield sent(at, home[at], low[at] + step, 0)
                for away in range(-reach, reach + 1):
                    near = home[asked] + away
                    at = asked[(near >= 0) & (near <= len(border))]
                    yield sent(at, home[at] + away, home[at] // every, 1)

    def window(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["asks"].to_numpy() == 1
        parts = []
        if asks.any() and not asks.all():
            name, least = group["class"].to_numpy(), group["least"].to_numpy()
            data = np.stack(group["embedding"].to_numpy()).astype(float)
            base, queries = np.flatnonzero(~asks), np.flatnonzero(asks)
            rows, ids = data[base], least[base]
            for low in range(0, len(queries), 256):
                some = queries[low : low + 256]
                products = data[some] @ rows.T
                for i, at in enumerate(some):
                    place, score = best(ids, rows, data[at], products[i], k)
                    parts.append((np.full(len(place), name[at]), name[base[place]], ids[place], score))
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
        return pd.DataFrame(dict(zip(["query", "class", "least", "score"], columns, strict=True)))

    spreadout = keyed.mapInArrow(dealt, f"curve int, block int, part int, asks int, class long, least long, embedding {kind}")
    return spreadout.groupBy("curve", "block", "part").applyInPandas(window, "query long, class long, least long, score double")


def search(embeddings: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """The k nearest of each row whose vec_id is divisible by ``every``, among all other rows.

    Returns query_id, rank, vec_id, score, in order of falling score, ties to the smaller vec_id. Null, empty, zero or
    non-finite vectors and null ids take no part. Vectors of different lengths have no inner product: each length is
    searched by itself. Rows that repeat an id are rows of their own: each is a candidate for all others, and each asks
    if its id does, so that such an id has as many lists. With fewer candidates than k all are returned; an empty table
    gives no rows.
    """
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "ann")
    rows = embeddings.where(F.col("vec_id").isNotNull() & usable("embedding"))
    rows = scratch.table(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.monotonically_increasing_id().alias("row")), "rows")
    asks = F.col("vec_id") % every == 0
    classes = rows.groupBy("embedding").agg(F.min("row").alias("class"), F.min("vec_id").alias("least"), F.max(asks).alias("asked"))
    classes = scratch.table(classes, "classes")
    members = scratch.table(rows.join(classes, "embedding").select("class", "row", "vec_id"), "members")
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    widths = classes.groupBy(F.size("embedding").alias("w")).agg(F.count("*").alias("n"), F.avg(square).alias("square")).collect()  # one row a length
    hits = None
    for w in widths:
        keyed, curves = order(classes.where(F.size("embedding") == w.w), w.w, w.n, w.square, k, scratch)
        some = _hits(keyed, curves, w.w, every, k + 1)
        hits = some if hits is None else hits.unionByName(some)
    if hits is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def first(df: DataFrame, by: str, n: int, *order: str) -> DataFrame:
        ranked = df.withColumn("n", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), *order)))
        return ranked.where(F.col("n") <= n).drop("n")

    # A class is found once on each curve at most; k + 1 classes hold the k + 1 best rows, the asking one included.
    near = first(hits, "query", CURVES * (k + 1), "least", "class").dropDuplicates(["query", "class"])
    near = first(near, "query", k + 1, "least", "class").select("query", "class", "score")
    nearest_rows = members.withColumn("n", F.row_number().over(Window.partitionBy("class").orderBy("vec_id", "row"))).where(F.col("n") <= k + 1).drop("n")
    lists = first(near.join(nearest_rows, "class"), "query", k + 1, "vec_id", "row")
    lists = lists.groupBy(F.col("query").alias("class")).agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("away"), "vec_id", "row"))).alias("near"))
    asking = members.where(asks).select("class", F.col("vec_id").alias("query_id"), F.col("row").alias("own"))
    others = F.slice(F.filter("near", lambda x: x["row"] != F.col("own")), 1, k)
    out = asking.join(lists, "class").select("query_id", F.posexplode(others).alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.away")).alias("score"))
