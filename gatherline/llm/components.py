"""Connected components of an edge table, by contraction.

In each round every node hooks onto its neighbour (or itself) that comes first in a hashed order, labels jump once, and
edges are rewritten between labels; loops and repeats go. A share of the nodes vanishes each round whatever the graph's
shape, so the edges that are joined shrink geometrically and rounds grow with the logarithm of the nodes. Then the
rounds' labels are composed, and each component is named by its least node. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatherline.plans.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, component) of every node in ``edges`` (columns a, b); component is the least node it reaches.

    Loops and repeated edges do no harm; no edges give no rows.
    """
    pair = lambda x, y: [F.greatest(x, y).alias("a"), F.least(x, y).alias("b")]
    left = scratch.table(edges.where("a <> b").select(*pair("a", "b")).distinct(), f"{name}-edges-0")
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        turn = len(rounds)
        order = lambda c, t=turn: F.struct(F.xxhash64(F.lit(t), c).alias("h"), F.col(c).alias("v"))
        ends = left.select(F.col("a").alias("node"), order("b").alias("to")).unionByName(left.select(F.col("b").alias("node"), order("a").alias("to")))
        best = ends.groupBy("node").agg(F.min("to").alias("to"))
        parent = best.select("node", F.least("to", order("node"))["v"].alias("label"))
        up = parent.select(F.col("node").alias("label"), F.col("label").alias("top"))
        label = scratch.table(parent.join(up, "label").select("node", F.col("top").alias("label")), f"{name}-label-{turn}")
        rounds.append(label)
        one = left.join(label.select(F.col("node").alias("a"), F.col("label").alias("x")), "a")
        two = one.join(label.select(F.col("node").alias("b"), F.col("label").alias("y")), "b")
        left = scratch.table(two.where("x <> y").select(*pair("x", "y")).distinct(), f"{name}-edges-{turn + 1}")
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    root = rounds.pop()
    while rounds:
        above = root.select(F.col("node").alias("label"), F.col("label").alias("root"))
        root = rounds.pop().join(above, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
    root = scratch.table(root, f"{name}-root")
    named = root.groupBy("label").agg(F.min("node").alias("component"))
    return scratch.table(root.join(named, "label").select("node", "component"), f"{name}-named")


class Forest:
    """Union-find over the rows of one task."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True
