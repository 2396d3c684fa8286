"""Keyset-paged exports: whether the landed pages are one chain from the first page to the last, and where they are not."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatherline.plans.scratch import Scratch


def export_chain(pages: DataFrame) -> DataFrame:
    """Each landed page with its place in its table's chain, and what is wrong there.

    pages: table, after (the cursor it was asked with; null or empty: the first page), next_after (the cursor it names;
    null or empty: the last page), low and high (least and greatest key on it, of the cursors' type, null without rows),
    rows. Returns these columns with page (place from 1; null where no walk from the first page comes by) and fault, a
    comma-joined list, empty for a sound page:

    unreached  the walk from the first page does not come here (something before it is lost, or there is no first page)
    fork       pages of one cursor name different next cursors; the walk takes the least of them
    stops      the cursor it names has no page: the chain ends before the export does
    loop       it names a cursor that the walk had passed
    order      it holds keys outside (after, next_after], so rows are told twice or skipped

    A page that landed twice with equal cursors is no fault, and both copies are returned. Other columns are kept. An
    empty table gives no rows; pages without a table name are unreached.

    The walk is by doubling: in each round the known part of the chain jumps ahead by its own length, so a chain of n
    pages takes log2(n) rounds of equi-joins, each cut by a written table; loops end by the count of cursors.
    """
    scratch = Scratch(pages.sparkSession, "export-chain")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    key = ["table", "_at"]
    rows = pages.withColumns({"_at": text("after"), "_to": text("next_after")})
    step = rows.groupBy(*key).agg(F.min(F.when(F.col("_to") != "", F.col("next_after"))).cast("string").alias("_next"), F.count_distinct("_to").alias("_ways"))
    step = scratch.table(step, "steps")
    longest = step.groupBy("table").count().agg(F.max("count")).first()[0] or 0
    reached = step.where("_at = ''").select(*key, F.lit(1).cast("long").alias("page"))
    jump, span = step.where("_next IS NOT NULL").select(*key, "_next"), 1
    while span < longest:
        ahead = reached.join(jump, key).select("table", F.col("_next").alias("_at"), (F.col("page") + span).alias("page"))
        reached = scratch.table(reached.unionByName(ahead).groupBy(*key).agg(F.min("page").alias("page")), f"reached-{span}")
        beyond = jump.select("table", F.col("_at").alias("_next"), F.col("_next").alias("_far"))
        jump = scratch.table(jump.join(beyond, ["table", "_next"]).select(*key, F.col("_far").alias("_next")), f"jump-{span}")
        span *= 2
    there = step.select("table", F.col("_at").alias("_to"), F.lit(True).alias("_there")).join(reached.select("table", F.col("_at").alias("_to"), F.col("page").alias("_page_to")), ["table", "_to"], "left")
    out = rows.join(step.select(*key, "_ways"), key, "left").join(reached, key, "left").join(there, ["table", "_to"], "left")
    goes_on = F.col("_to") != ""
    outside = ((F.col("_at") != "") & (F.col("low") <= F.col("after"))) | (goes_on & (F.col("high") > F.col("next_after")))
    faults = {
        "unreached": F.col("page").isNull(),
        "fork": F.col("_ways") > 1,
        "stops": goes_on & F.col("_there").isNull(),
        "loop": goes_on & (F.col("_page_to") <= F.col("page")),
        "order": outside,
    }
    return out.withColumn("fault", F.concat_ws(",", *[F.when(is_so, name) for name, is_so in faults.items()])).select(*pages.columns, "page", "fault")
