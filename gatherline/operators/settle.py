"""Order-dependent passes over pairs, settled component by component.

A greedy pass (who follows whom, who is assigned to whom) depends on the order of its pairs, but never on pairs of another
connected component. So the components of the open pairs are found, by contraction in a logarithmic number of rounds;
each of at most ``WHOLE`` pairs is settled whole inside one task, many components to a task; larger ones are worn down by
rounds of the caller and then looked at again. Nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatherline.plans.scratch import Scratch

#: Pairs of a component that one task settles, and of the components that share a task (twice as many at most).
WHOLE = 300_000
#: Rounds over larger components before components are looked for again.
ROUNDS = 3


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) of every node in ``edges`` (columns a, b that differ): the least node in hashed order it reaches.

    Each round hooks every node onto its first neighbour in an order of the round's own; edges are rewritten between
    the hooks. A share of the nodes goes each round whatever the shape, so long paths shrink as fast as stars.
    """
    both = lambda x, y: [F.greatest(x, y).alias("a"), F.least(x, y).alias("b")]
    left = scratch.table(edges.where("a <> b").select(*both("a", "b")).distinct(), f"{name}-edges")
    steps: list[DataFrame] = []
    while not left.isEmpty():
        turn = len(steps)
        rank = lambda c, t=turn: F.struct(F.xxhash64(F.lit(t), c).alias("h"), F.col(c).alias("v"))
        ends = left.select(F.col("a").alias("node"), rank("b").alias("to")).unionByName(left.select(F.col("b").alias("node"), rank("a").alias("to")))
        hook = ends.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("to", rank("node"))["v"].alias("up"))
        step = scratch.table(hook.join(hook.select(F.col("node").alias("up"), F.col("up").alias("top")), "up").select("node", F.col("top").alias("up")), f"{name}-step-{turn}")
        steps.append(step)
        for end in ("a", "b"):
            left = left.join(step.select(F.col("node").alias(end), F.col("up").alias(f"{end}_up")), end)
        left = scratch.table(left.where("a_up <> b_up").select(*both("a_up", "b_up")).distinct(), f"{name}-edges-{turn}")
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = steps.pop().withColumnRenamed("up", "component")
    while steps:
        above = found.withColumnRenamed("node", "up")
        found = steps.pop().join(above, "up", "left").select("node", F.coalesce("component", "up").alias("component"))
    return scratch.table(found, f"{name}-found")


def settled(pairs: DataFrame, one: Column, other: Column, plain: Callable[[pd.DataFrame], pd.DataFrame], schema: str, scratch: Scratch, name: str, linked: Column | None = None, times: int = 1) -> tuple[DataFrame, DataFrame]:
    """What ``plain`` makes of the pairs in components of at most WHOLE pairs (``times`` as many, where they are few numbers each), and the pairs of all others.

    one, other: the pair's ends as longs that stand for them (an accidental equal only joins components). linked: whether
    the pair ties its ends together; where not, it belongs to the component of ``other`` alone. ``plain`` gets the pairs
    of many whole components at once, in no order.
    """
    tied = F.lit(True) if linked is None else linked
    limit = WHOLE * times
    keyed = pairs.withColumns({"_one": one, "_other": other})
    label = components(keyed.where(tied).select(F.col("_one").alias("a"), F.col("_other").alias("b")), scratch, name)
    tagged = keyed.join(label.withColumnRenamed("node", "_other"), "_other", "left").withColumn("_component", F.coalesce("component", "_other"))
    tagged = scratch.table(tagged.select(*pairs.columns, "_component"), f"{name}-tagged")
    sizes = scratch.table(tagged.groupBy("_component").agg(F.count("*").alias("_n")), f"{name}-sizes")
    total = sizes.where(F.col("_n") <= limit).agg(F.sum("_n")).first()[0] or 0
    tasks = -(-total // WHOLE) + pairs.sparkSession.sparkContext.defaultParallelism
    sized = tagged.join(sizes, "_component")
    small = sized.where(F.col("_n") <= limit).withColumn("_task", F.pmod(F.xxhash64("_component"), F.lit(tasks)))
    done = scratch.table(small.select(*pairs.columns, "_task").groupBy("_task").applyInPandas(lambda rows: plain(rows.drop(columns="_task")), schema), f"{name}-done")
    rest = scratch.table(sized.where(F.col("_n") > limit).select(*pairs.columns), f"{name}-rest")
    return done, rest


def settled_blocks(rows: DataFrame, by: list[str], plain: Callable[[pd.DataFrame], pd.DataFrame], schema: str, scratch: Scratch, name: str, times: int = 1) -> tuple[DataFrame, DataFrame]:
    """What ``plain`` makes of the blocks (rows equal in the columns ``by``, none null) of at most WHOLE rows (``times`` as many, where they are few numbers each), and the rows of all larger ones.

    For passes whose pairs never cross blocks: a block is settled row by row in one task, many blocks to a task, and none
    of its pairs is made. ``plain`` gets one block at a time, in no order.
    """
    rows = scratch.table(rows, f"{name}-rows")
    limit = WHOLE * times
    sizes = scratch.table(rows.groupBy(*by).agg(F.count("*").alias("_n")), f"{name}-sizes")
    total = sizes.where(F.col("_n") <= limit).agg(F.sum("_n")).first()[0] or 0
    tasks = -(-4 * total // WHOLE) + 3 * rows.sparkSession.sparkContext.defaultParallelism
    sized = rows.join(sizes, by)
    small = sized.where(F.col("_n") <= limit).withColumn("_task", F.pmod(F.xxhash64(*by), F.lit(tasks))).drop("_n")

    def each(held: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([plain(block) for _, block in held.groupby(by, sort=False)], ignore_index=True)

    done = scratch.table(small.groupBy("_task").applyInPandas(each, schema), f"{name}-done")
    return done, scratch.table(sized.where(F.col("_n") > limit).drop("_n"), f"{name}-rest")
