"""Classification rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flocklens.config import (
    DEFAULT_EVENT_CLASS,
    ELIGIBLE_FLOOR,
    EVENT_CLASSES,
    HIGH,
    IN_PERSON,
    IN_PERSON_STATUSES,
    LOW,
    MEDIUM,
    NOT_APPLICABLE,
    ONLINE,
    ONLINE_STATUSES,
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def attendance_type(status) -> Column:
    """CRM member status -> attendance type; unknown statuses pass through."""
    s = _c(status)
    return (
        F.when(s.isin(*IN_PERSON_STATUSES), F.lit(IN_PERSON))
        .when(s.isin(*ONLINE_STATUSES), F.lit(ONLINE))
        .otherwise(s)
    )


def classify_event(name) -> Column:
    """Ticketing event name -> CRM campaign type (substring rules)."""
    low = F.lower(_c(name))
    expr = None
    for needles, label in EVENT_CLASSES:
        cond = None
        for n in needles:
            c = low.contains(n)
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(DEFAULT_EVENT_CLASS))


def event_format(online_flag) -> Column:
    """Online only when the flag is TRUE; FALSE and NULL are in person."""
    return F.when(_c(online_flag) == F.lit(True), F.lit(ONLINE)).otherwise(F.lit(IN_PERSON))


def risk_eligible(baseline_rate, recent_rate) -> Column:
    """SQL three-valued: NULL (dropped by a filter) when a rate is unknown."""
    b, r = _c(baseline_rate), _c(recent_rate)
    floor = F.lit(ELIGIBLE_FLOOR)
    return (b > F.lit(0)) & ~((b < floor) & (r < floor))


def rule_flag(baseline_rate, drop_ratio) -> Column:
    b, d = _c(baseline_rate), _c(drop_ratio)
    return (
        F.when((b >= F.lit(0.7)) & (d >= F.lit(0.5)), F.lit(HIGH))
        .when(b.between(0.4, 0.7) & (d >= F.lit(0.6)), F.lit(MEDIUM))
        .when((b < F.lit(0.4)) & (d < F.lit(0.2)), F.lit(LOW))
        .otherwise(F.lit(NOT_APPLICABLE))
    )


def hybrid_flag(rule, stat) -> Column:
    """Both High -> High, both Low -> Low, any other graded pair -> Medium."""
    r, s = _c(rule), _c(stat)
    graded = (HIGH, MEDIUM, LOW)
    return (
        F.when((r == F.lit(HIGH)) & (s == F.lit(HIGH)), F.lit(HIGH))
        .when((r == F.lit(LOW)) & (s == F.lit(LOW)), F.lit(LOW))
        .when(r.isin(*graded) & s.isin(*graded), F.lit(MEDIUM))
        .otherwise(F.lit(NOT_APPLICABLE))
    )


def similarity_confidence(sim, medium: float, low: float) -> Column:
    s = _c(sim)
    return (
        F.when(s >= F.lit(medium), F.lit("medium"))
        .when(s >= F.lit(low), F.lit("low"))
        .otherwise(F.lit(None).cast("string"))
    )
