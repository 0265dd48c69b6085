"""Worship-attendance risk profiling.

Windows are measured in days before ``as_of``: recent = age <= 3 periods
(future-dated events count as recent, there is no lower bound), baseline =
3 < age/period <= 6. Rates divide a contact's attended worship days by the
number of days with a worship event in the same window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flocklens.config import HIGH, LOW, MEDIUM, NOT_APPLICABLE, WORSHIP_TYPE, Settings
from flocklens.functions.dates import days_before
from flocklens.functions.rules import hybrid_flag, risk_eligible, rule_flag


def scalar_row(one_row: DataFrame):
    """A one-row relation (a global aggregate) as a struct-valued scalar
    subquery: evaluated once, reused wherever referenced, no join."""
    return one_row.select(F.struct(*one_row.columns).alias("v")).scalar()


def period_event_days(events: DataFrame, settings: Settings) -> DataFrame:
    """One row: distinct worship days in the recent and the baseline window.

    ``events`` is the event side of the detail (``staging.active_campaigns``
    or the detail itself). Only days inside the baseline horizon can count,
    so the age bound is folded into a date range that reaches the scan."""
    horizon = F.date_sub(F.lit(settings.as_of), settings.baseline_days)
    days = (
        events.filter((F.col("type") == F.lit(WORSHIP_TYPE)) & (F.col("event_date") >= horizon))
        .select("event_date")
        .distinct()
    )
    age = days_before(settings.as_of, F.col("event_date"))
    return days.agg(
        F.count(F.when(age <= F.lit(settings.recent_days), F.lit(1))).alias("recent_worship"),
        F.count(
            F.when((age > F.lit(settings.recent_days)) & (age <= F.lit(settings.baseline_days)), F.lit(1))
        ).alias("baseline_worship"),
    )


def member_period_attendance(profile: DataFrame) -> DataFrame:
    """Attended worship days per member-role contact in both windows."""
    return profile.filter(F.col("has_member_worship") == 1).select(
        "contact_id", "recent_attendance", "baseline_attendance"
    )


def attendance_rates(profile: DataFrame, period_days: DataFrame) -> DataFrame:
    """Recent / baseline attendance rates and the drop ratio (of counts).

    ``period_days`` is a global aggregate (exactly one row), read as a
    scalar subquery."""
    pdays = scalar_row(period_days)
    ra, ba = F.col("recent_attendance"), F.col("baseline_attendance")
    return member_period_attendance(profile).select(
        "contact_id",
        "recent_attendance",
        F.try_divide(ra, pdays["recent_worship"]).alias("recent_rate"),
        F.try_divide(ba, pdays["baseline_worship"]).alias("baseline_rate"),
        F.try_divide(ba - ra, ba).alias("drop_ratio"),
    )


_WHOLE = "decimal(38,0)"


def rate_stats(profile: DataFrame, period_days: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of the recent rate over all rated
    contacts (before the eligibility filter), from exact integer moments.

    All recent rates share one denominator R, so with n contacts, the sum s of
    their attended days and q of its squares, the variance of the attendance is
    v / (n (n - 1)) with v = n q - s^2: integers, whose sums depend on no order.
    ``bound`` is the least integer of at least n v / (n - 1), with which z-scores
    are compared without rounding (``statistical_risk``)."""
    pdays = scalar_row(period_days)
    a = F.col("recent_attendance")
    m = member_period_attendance(profile).agg(
        F.count(a).alias("n"),
        F.sum(a).alias("s"),
        F.sum((a * a).cast(_WHOLE)).cast(_WHOLE).alias("q"),
    )
    r, n = F.nullif(pdays["recent_worship"], F.lit(0)), F.col("n")
    m = m.select("n", "s", ((n * F.col("q")).cast(_WHOLE) - (F.col("s").cast(_WHOLE) * F.col("s")).cast(_WHOLE)).cast(_WHOLE).alias("v"), r.alias("r"))
    v, rest = F.col("v"), F.expr("v % nullif(n - 1, 0)")
    whole = ((v - rest) / F.nullif(n - 1, F.lit(0))).cast(_WHOLE)
    return m.select(
        F.when(F.col("r").isNotNull(), n).otherwise(F.lit(0)).alias("n"),
        "s",
        F.when(F.col("r").isNotNull() & (v > 0), (v + whole + F.when(rest > 0, 1).otherwise(0)).cast(_WHOLE)).alias("bound"),
        F.try_divide(F.col("s").cast("double"), (n * F.col("r")).cast("double")).alias("mean_recent"),
        (F.sqrt(F.try_divide(v.cast("double"), (n * (n - 1)).cast("double"))) / F.col("r")).alias("sd_recent"),
    )


def statistical_risk(attendance, stats: DataFrame):
    """Flag by the z-score of the recent rate: <= -1 High, <= -0.5 Medium, else Low;
    not applicable without a rate or a spread.

    With d = n a - s, z <= -1 means d < 0 and d^2 >= n v / (n - 1), and z <= -0.5
    the same for (2 d)^2: integers on both sides, so a z of exactly -1 is graded
    alike everywhere."""
    st = scalar_row(stats)
    a = F.col(attendance) if isinstance(attendance, str) else attendance
    d = (st["n"] * a - st["s"]).cast(_WHOLE)
    below = lambda k: (d < 0) & ((d * d).cast(_WHOLE) * k >= st["bound"])
    return (
        F.when(a.isNull() | st["bound"].isNull(), F.lit(NOT_APPLICABLE))
        .when(below(1), F.lit(HIGH))
        .when(below(4), F.lit(MEDIUM))
        .otherwise(F.lit(LOW))
    )


def risk_flags(rates: DataFrame, stats: DataFrame) -> DataFrame:
    """Rule-based and statistical flags of the eligible contacts."""
    return (
        rates.filter(risk_eligible("baseline_rate", "recent_rate"))
        .select(
            "contact_id",
            "baseline_rate",
            "recent_rate",
            rule_flag("baseline_rate", "drop_ratio").alias("rule_based_flag"),
            statistical_risk("recent_attendance", stats).alias("statistical_flag"),
        )
    )


def hybrid_risk(flags: DataFrame) -> DataFrame:
    return flags.withColumn("hybrid_flag", hybrid_flag("rule_based_flag", "statistical_flag"))


def latest_worship(profile: DataFrame) -> DataFrame:
    """Last worship day and the in-person / second-service share of worship days."""
    return profile.filter(F.col("has_worship") == 1).select(
        "contact_id",
        "latest_worship_date",
        F.try_divide(F.col("in_person_days"), F.col("worship_days")).alias("in_person_prop"),
        F.try_divide(F.col("second_service_days"), F.col("worship_days")).alias("second_service_prop"),
    )
