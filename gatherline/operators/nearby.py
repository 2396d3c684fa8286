"""Nearest places: a search over cells of the map that doubles them until the nearest is certain."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatherline.functions.places import km
from gatherline.plans.scratch import Scratch

#: Cells are 360 degrees / 2^k wide; from the finest to those so wide that all of a key is compared.
FINEST, WIDEST = 16, 2
_RADIUS = 6371.0


def nearest_km(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """``left`` with km: the distance to the nearest point of ``right`` of equal ``on``; rows whose key is not there go.

    left: ``on``, lat, lng and more; right: ``on``, lat, lng (degrees, -90 to 90 and -180 to 180). Equal points are
    searched once. A point meets those of its cell and the eight around it; its nearest is certain if it is no further
    than anything outside of them can be, else it waits for cells twice as wide. The first cells are so fine that those
    in use hold two points on average.
    """
    scratch = Scratch(left.sparkSession, "nearest")
    point = [on, "lat", "lng"]
    there = scratch.table(right.select(*point).where("lat IS NOT NULL AND lng IS NOT NULL").distinct(), "there")
    cell = lambda c, k: F.floor((F.col(c) + 180) / (360 / 2**k))
    levels = range(WIDEST + 1, FINEST + 1)
    held = there.agg(F.count("*"), *[F.approx_count_distinct(F.struct(on, cell("lat", k), cell("lng", k))) for k in levels]).first()  # one row
    k = next((k for k, n in zip(levels, held[1:], strict=True) if held[0] <= 2 * n), FINEST)
    wanted = left.select(*point).where("lat IS NOT NULL AND lng IS NOT NULL").distinct()
    still = scratch.table(wanted.join(there.select(on).distinct(), on, "left_semi"), "open")
    found = still.limit(0).withColumn("km", F.lit(0.0))
    while k > WIDEST and not still.isEmpty():
        wide = 360 / 2**k
        shifts = [F.lit(i) for i in (-1, 0, 1)]
        near = there.withColumnsRenamed({"lat": "_lat", "lng": "_lng"})
        near = near.withColumn("_i", F.explode(F.array(*[cell("_lat", k) + i for i in shifts]))).withColumn("_j", F.explode(F.array(*[F.pmod(cell("_lng", k) + i, F.lit(2**k)) for i in shifts])))
        mine = still.withColumns({"_i": cell("lat", k), "_j": F.pmod(cell("lng", k), F.lit(2**k))})
        hits = mine.join(near.hint("merge"), [on, "_i", "_j"], "left").groupBy(*point).agg(F.min(km(F.col("lat"), F.col("lng"), F.col("_lat"), F.col("_lng"))).alias("km"))
        # What is no neighbour lies a whole cell further north or south, or beyond a meridian a cell away.
        beyond = F.least(F.lit(math.radians(wide)), F.asin(F.cos(F.radians("lat")) * math.sin(math.radians(wide)))) * _RADIUS
        sure = F.coalesce(F.col("km") <= beyond * (1 - 1e-9), F.lit(False))
        told = scratch.table(hits.withColumn("_sure", sure), f"told-{k}")
        found = found.unionByName(told.where("_sure").drop("_sure"))
        still = told.where("NOT _sure").select(*point)
        k -= 1
    rest = still.join(there.withColumnsRenamed({"lat": "_lat", "lng": "_lng"}).hint("merge"), on).groupBy(*point).agg(F.min(km(F.col("lat"), F.col("lng"), F.col("_lat"), F.col("_lng"))).alias("km"))
    return left.join(found.unionByName(rest).hint("merge"), point)
