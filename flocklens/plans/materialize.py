"""Written intermediate tables in the cluster's shared checkpoint folder.

A relation that several downstream models read (the contact days and tuples,
the ticket candidates, the attendance base) is written once as Parquet and read
back: one scan of the big detail instead of one per consumer, a short
lineage (a lost executor rereads files instead of recomputing the upstream
plan), and file statistics for AQE's join choices. The folder is the one that
``spark.checkpoint.dir`` names, or the session's checkpoint directory; without
either a build that writes intermediates fails.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to storage that all executors share")
    return root.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def files_under(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of the files of a table; works for any
    store that Spark reads."""
    p, fs = _file_system(spark, path)
    found, files = [], fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return found


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _file_system(spark, path)
    fs.delete(p, True)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet at ``path`` and return the scan of it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Materializer:
    """Writes a build's shared intermediates under one run folder, which
    ``cleanup`` removes; with ``enabled=False`` relations stay lazy plans."""

    def __init__(self, spark: SparkSession, enabled: bool = True):
        self.spark = spark
        self.enabled = enabled
        self._run = None

    @property
    def run_dir(self) -> str:
        if self._run is None:
            self._run = f"{checkpoint_root(self.spark)}/flocklens-run-{uuid.uuid4().hex}"
        return self._run

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        if not self.enabled:
            return df
        return write_table(df, f"{self.run_dir}/{name}")

    def cleanup(self) -> None:
        if self._run is not None:
            delete(self.spark, self._run)
            self._run = None
