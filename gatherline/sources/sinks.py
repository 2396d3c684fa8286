"""Keyed upserts, partial updates, reports and run logs, all idempotent: replaying the same rows changes nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatherline.functions.values import lookup, text


def last_known(rows: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """One row a key: per column the last value that is not null. Partial maxima are taken before the shuffle."""
    rest = [c for c in rows.columns if c not in (key, order)]
    return rows.groupBy(key).agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in rest])


def upsert(stored: DataFrame, rows: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """``stored`` with ``rows`` merged in by key: new values win where they are not null, new keys are added."""
    new = last_known(rows, key, order)
    rest = [c for c in stored.columns if c != key]
    renamed = new.select(key, *[F.col(c).alias(f"_n_{c}") for c in new.columns if c != key])
    joined = stored.join(renamed, key, "full")
    return joined.select(key, *[(F.coalesce(F.col(f"_n_{c}"), F.col(c)) if c in new.columns else F.col(c)).alias(c) for c in rest])


def replace_by_key(stored: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """``stored`` without the keys of ``rows``, and ``rows``; columns that one side lacks are null."""
    return stored.join(rows.select(key).distinct(), key, "left_anti").unionByName(rows, allowMissingColumns=True)


def update_fields(stored: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """``stored`` with the columns that updates has, where its value is not null; no rows are added, no defaults set."""
    fields = [c for c in updates.columns if c != key]
    u = updates.select(key, *[F.col(c).alias(f"_u_{c}") for c in fields])
    joined = stored.join(u, key, "left")
    return joined.select(key, *[(F.coalesce(F.col(f"_u_{c}"), F.col(c)) if c in fields else F.col(c)).alias(c) for c in stored.columns if c != key])


def run_log(rows: DataFrame, source: str = "source") -> DataFrame:
    """Per source: rows seen, distinct keys (upserted) and rows without a key (errors)."""
    return rows.groupBy(source).agg(F.count("*").alias("rows_seen"), F.count_distinct("dedupe_key").alias("rows_upserted"), F.count_if(F.col("dedupe_key").isNull()).alias("errors"))


def contact_rows(events: DataFrame) -> DataFrame:
    """One row per contact of an event with an address: role in words and confidence (0.9 for vendor contacts, else 0.7)."""
    one = events.select("dedupe_key", F.explode("contacts").alias("c"))
    role = F.coalesce(lookup(F.col("c.role"), {"vendor": "vendor/sponsor", "director": "director", "organizer": "organizer inbox"}), F.col("c.role"))
    return one.where(text("c.email") != "").select("dedupe_key", F.col("c.name").alias("name"), F.lower("c.email").alias("email"), F.col("c.phone").alias("phone"), role.alias("role"), F.when(F.col("c.role") == "vendor", 0.9).otherwise(0.7).alias("confidence"))


def report_rows(rows: DataFrame, rank: Column, *order: str) -> DataFrame:
    """Rows in report order; nested columns as JSON of at most 32,000 characters, as spreadsheet cells hold no more."""
    flat = [F.left(F.to_json(c), F.lit(32000)).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in rows.dtypes]
    return rows.select(*flat, rank.alias("_rank")).orderBy("_rank", *order).drop("_rank")


def fan_out(lines: DataFrame) -> DataFrame:
    """Check records of report lines: one for the stored row, and one for the organiser's own row where there is one.

    lines: app_key, org_key, status, ord.
    """
    both = F.array(F.struct(F.col("app_key").alias("dedupe_key"), F.lit("app").alias("side")), F.struct(F.col("org_key").alias("dedupe_key"), F.lit("organizer").alias("side")))
    return lines.select(F.explode(F.filter(both, lambda r: r["dedupe_key"].isNotNull())).alias("r"), "status", "ord").select("r.dedupe_key", "r.side", "status", "ord")


def pending(work: DataFrame, finished: DataFrame, key: str) -> DataFrame:
    """Units of work without a done marker, the newest first."""
    return work.join(finished.select(key).distinct(), key, "left_anti").orderBy(F.desc(key))


def write_staged(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Parquet written as a whole: readers see the old files until the job commits."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


#: What a payload of each kind must hold.
CONTRACT = {
    "rows": ["source", "source_event_id", "name", "sport", "start_date", "end_date", "city_states", "dedupe_key"],
    "run": ["started_at", "finished_at", "rows_seen", "rows_upserted", "errors", "note"],
    "history": ["source", "source_event_id", "name", "sport", "start_date", "end_date", "city_states", "dedupe_key"],
    "contacts": ["dedupe_key", "name", "role", "email", "confidence", "enriched_via"],
}


def contract_faults(payloads: DataFrame) -> DataFrame:
    """Payloads that break the contract: their columns and missing (what they lack), sorted; unknown keys are ignored.

    payloads: kind and body, a JSON text. An unknown kind lacks everything, as does a body that does not parse.
    """
    wanted = F.create_map(*[x for kind, keys in CONTRACT.items() for x in (F.lit(kind), F.array(*map(F.lit, keys)))])
    known = F.coalesce(F.json_object_keys("body"), F.array().cast("array<string>"))
    missing = F.coalesce(F.array_except(F.element_at(wanted, F.col("kind")), known), F.array(F.lit("kind")))
    return payloads.withColumn("missing", F.array_sort(missing)).where(F.size("missing") > 0)
