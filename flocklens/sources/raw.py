"""Readers for the raw registries.

``Sources`` bundles the five raw DataFrames; every operator takes the
DataFrames it needs, so callers can feed Parquet, a catalog table, or the
driver-table fixture (``flocklens.sources.fixture``) interchangeably.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from flocklens.sources.schemas import CONTRACTS


@dataclass(frozen=True)
class Sources:
    campaign: DataFrame
    campaign_member: DataFrame
    ticket_event: DataFrame
    ticket_attendee: DataFrame
    ticket_order: DataFrame


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Parquet scan with the declared contract as read schema, so only the
    contracted columns are read and filters push down to the files. A file
    that lacks a contracted column is an error, not a column of NULLs."""
    there = {f.name for f in spark.read.parquet(path).schema.fields}
    missing = [f.name for f in CONTRACTS[name].fields if f.name not in there]
    if missing:
        raise ValueError(f"{name} at {path} lacks the columns {', '.join(missing)}")
    return spark.read.schema(CONTRACTS[name]).parquet(path)


def read_sources(spark: SparkSession, root: str) -> Sources:
    """Read ``<root>/<name>`` (Parquet directories or files) for all five."""
    root = root.rstrip("/")
    return Sources(**{n: read_table(spark, f"{root}/{n}", n) for n in CONTRACTS})
