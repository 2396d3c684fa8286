"""Intermediate tables in the folder that driver and executors share.

A long plan is cut by writing a table and reading it back: the table survives lost executors, and what follows
starts from files instead of recomputing. The folder is the one named by ``spark.checkpoint.dir``; only where that
is unset and Spark runs in this process (tests) a temporary folder of this machine is made.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a local one when none is named and there is no cluster, which without one is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="gatherline-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


class Scratch:
    """Tables of one query under one folder; removed when the session ends."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        atexit.register(self._remove, "")

    def _remove(self, name: str) -> None:
        try:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001 - the session may already be gone at exit; files are then left to the cluster
            pass

    def table(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        """Write ``df`` as Parquet and read it back."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").option("compression", compression).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Remove a table that nothing reads any more."""
        self._remove(name)
