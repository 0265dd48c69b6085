"""Session helpers for tests, the bench and local runs.

Library operators never create or configure a session; jobs run on whatever
session the caller provides.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(*, scratch: str, cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("flocklens")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # as many partitions as cores: merging the small ones would leave cores idle
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("FLOCKLENS_DRIVER_MEMORY", "8g"))
        .config("spark.local.dir", os.path.join(scratch, "local"))
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, os.path.join(scratch, "checkpoints"))
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the cluster's ``spark.checkpoint.dir`` (shared storage); only when
    it is unset (local tests) fall back to ``fallback`` or a new local folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    spark.sparkContext.setCheckpointDir(fallback or tempfile.mkdtemp(prefix="flocklens-"))
    return spark.sparkContext.getCheckpointDir()
