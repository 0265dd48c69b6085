"""Calendar expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from flocklens.config import BUCKET_EDGES, BUCKET_LABELS


def days_before(as_of: _dt.date, d) -> Column:
    """Whole days from ``d`` to ``as_of`` (negative for future dates)."""
    d = F.col(d) if isinstance(d, str) else d
    return F.datediff(F.lit(as_of), d)


def week_sunday(d) -> Column:
    """Week of year with weeks starting on Sunday; days before the first
    Sunday are week 0 (range 0..53). Not ISO ``weekofyear``."""
    d = F.col(d) if isinstance(d, str) else d
    return F.floor((F.dayofyear(d) - F.dayofweek(d) + F.lit(7)) / F.lit(7)).cast("long")


def time_bucket(days: Column, period_days: int) -> Column:
    """Recency bucket of an age in days: ``days / period <= edge`` per edge."""
    expr = None
    for edge, label in zip(BUCKET_EDGES, BUCKET_LABELS):
        cond = days <= F.lit(edge * period_days)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(BUCKET_LABELS[-1]))
