"""The same jobs over unbounded input: windows with late data, sessions, keyed upserts per batch, deduplication."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gatherline.plans.scratch import shared_dir
from gatherline.sources.sinks import upsert

#: How long after its day an event may still be reported.
LATE = "10 days"
#: Buckets of a keyed table: files that a batch rewrites hold the keys of one.
BUCKETS = 64


def windowed_counts(events: DataFrame, time: str, by: list[str], length: str, slide: str | None = None, late: str = LATE) -> DataFrame:
    """Count and sum of value per window and key; works on streams and on tables alike."""
    w = F.window(time, length, slide) if slide else F.window(time, length)
    out = events.withWatermark(time, late).groupBy(w.alias("w"), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n", "total")


def sessions(events: DataFrame, time: str, by: list[str], gap: str, late: str = LATE) -> DataFrame:
    """Activity per key in sessions that end after ``gap`` of silence."""
    out = events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), *by).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *by, "n")


def deduplicated(events: DataFrame, time: str, key: list[str], late: str = LATE) -> DataFrame:
    """First row of each key within the watermark; state is dropped once a key can no longer come late."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def upsert_stream(rows: DataFrame, target: str, key: str, checkpoint: str | None = None) -> StreamingQuery:
    """Merges each batch into a keyed table under ``target`` that is kept in BUCKETS buckets of key hashes.

    A batch reads and writes the buckets that hold its keys only, as new files; a manifest then names the files of every
    bucket, and readers take the newest whole manifest, one consistent version. Versions are numbered by what is there,
    so a batch that is retried, or replayed after its checkpoint is lost, merges the same values again and changes
    nothing. Files that neither the newest manifest nor the one before it names are removed. Where no checkpoint is
    given, each target has its own.
    """
    spark = rows.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")

    def merge(batch: DataFrame, _: int) -> None:
        batch = batch.withColumn("ord", F.monotonically_increasing_id()).persist()
        try:
            touched = [r.b for r in batch.select(bucket.alias("b")).distinct().collect()]  # at most BUCKETS
            if touched:
                version, files = _manifest(spark, target)
                stored = [f"{target}/data/version={files[b]}/bucket={b}" for b in touched if b in files]
                before = spark.read.parquet(*stored) if stored else batch.drop("ord").limit(0)
                merged = upsert(before, batch, key).withColumn("bucket", bucket)
                merged.repartition(len(touched), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/data/version={version + 1}")
                named = files | dict.fromkeys(touched, version + 1)
                spark.createDataFrame([*named.items()], "bucket int, version long").coalesce(1).write.mode("overwrite").parquet(f"{target}/manifest/version={version + 1}")
                _vacuum(spark, target, [named, files], version)
        finally:
            batch.unpersist()

    place = checkpoint or f"{shared_dir(spark)}/stream-{key}-{hashlib.sha256(target.encode()).hexdigest()[:16]}"
    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", place).trigger(availableNow=True).start()


def _versions(spark: SparkSession, folder: str) -> list[int]:
    """Versions under a folder that their writers have marked complete."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    made = [s.getPath() for s in fs.listStatus(path)] if fs.exists(path) else []
    whole = [p.getName() for p in made if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return [int(n.partition("=")[2]) for n in whole if n.startswith("version=")]


def _manifest(spark: SparkSession, target: str) -> tuple[int, dict[int, int]]:
    """The newest version and, for every bucket, the version that holds its rows."""
    version = max(_versions(spark, f"{target}/manifest"), default=0)
    files = spark.read.parquet(f"{target}/manifest/version={version}").collect() if version else []
    return version, {r.bucket: r.version for r in files}


def _vacuum(spark: SparkSession, target: str, manifests: list[dict[int, int]], version: int) -> None:
    """Removes buckets' files that no manifest in ``manifests`` names, and manifests before ``version``."""
    kept = {(v, b) for files in manifests for b, v in files.items()}
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(f"{target}/data")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for made in fs.listStatus(root):
        number = int(made.getPath().getName().partition("=")[2])
        buckets = [s.getPath() for s in fs.listStatus(made.getPath()) if s.getPath().getName().startswith("bucket=")]
        gone = [b for b in buckets if (number, int(b.getName().partition("=")[2])) not in kept]
        if number <= version:
            for b in gone:
                fs.delete(b, True)
            if len(gone) == len(buckets):
                fs.delete(made.getPath(), True)
    for old in _versions(spark, f"{target}/manifest"):
        if old < version:
            fs.delete(path(f"{target}/manifest/version={old}"), True)


def current(spark: SparkSession, target: str) -> DataFrame | None:
    """The newest whole version of a keyed table, or None."""
    _, files = _manifest(spark, target)
    return spark.read.parquet(*[f"{target}/data/version={v}/bucket={b}" for b, v in files.items()]) if files else None
