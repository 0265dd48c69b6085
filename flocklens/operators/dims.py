"""Date and event dimensions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flocklens.config import SPINE_DAYS, SPINE_START, Settings
from flocklens.functions.dates import days_before, time_bucket, week_sunday

DIM_EVENT_COLUMNS = (
    "event_id", "event_name", "description", "type", "event_format", "event_date",
    "event_time", "budget", "cost", "expected_revenue",
)


def dim_events(events: DataFrame) -> DataFrame:
    """Distinct event attributes (one row per event when campaigns are unique).

    ``events`` is the event side of the detail: ``staging.active_campaigns``
    (or the detail itself)."""
    return events.select(*DIM_EVENT_COLUMNS).distinct()


def spine_length(as_of: _dt.date) -> int:
    """Days of the fixed 2020-01-01 + [0, 18250] spine that are <= as_of."""
    return max(0, min(SPINE_DAYS, (as_of - SPINE_START).days + 1))


def date_spine(spark: SparkSession, as_of: _dt.date) -> DataFrame:
    """The calendar up to ``as_of``; the as-of bound is folded into the range
    so the spine is never generated past it. At most 18,251 rows by
    construction, which is what makes it safe to broadcast."""
    n = spine_length(as_of)
    return spark.range(0, n, 1, 1).select(
        F.date_add(F.lit(SPINE_START), F.col("id").cast("int")).alias("date")
    )


def with_calendar(df: DataFrame, date_col: str, settings: Settings) -> DataFrame:
    d = F.col(date_col)
    return df.select(
        d.alias("date"),
        F.dayofweek(d).cast("long").alias("day_of_week"),
        week_sunday(d).alias("week"),
        F.month(d).cast("long").alias("month"),
        F.quarter(d).cast("long").alias("quarter"),
        F.year(d).cast("long").alias("year"),
        time_bucket(days_before(settings.as_of, d), settings.bucket_period_days).alias("time_bucket"),
    )


def dim_dates(spark: SparkSession, settings: Settings) -> DataFrame:
    """Calendar attributes and recency bucket of every day up to ``as_of``."""
    return with_calendar(date_spine(spark, settings.as_of), "date", settings)


def event_calendar(events: DataFrame, spark: SparkSession, settings: Settings) -> DataFrame:
    """``dim_dates`` rows of the days on which CRM events happened: the date
    dimension as the attendance data sees it (inner join on the day).
    ``events``: the event side of the detail (see ``dim_events``)."""
    days = events.select(F.col("event_date").alias("date")).distinct()
    # the spine side is bounded (<= 18,251 rows), so it is the broadcast side
    return days.join(F.broadcast(dim_dates(spark, settings)), "date", "inner")
