"""Per-contact aggregates over the CRM detail, from two scans of it.

* contact days: one row per (contact, event day, participant type) with
  integer day flags. A contact that holds a third of all rows is spread over
  as many shuffle keys as it has event days and types, and map-side partial
  aggregation shrinks it before the shuffle. Activity (window counts, worship
  shares, first and latest days) and the latest participant type derive from
  these rows: "count distinct days where <condition>" becomes "sum over days of
  max(condition)", so no Expand.
* contact tuples: the distinct descriptive tuples of each contact; the string
  picks (which Spark aggregates with a sort) and the CRM emails derive from them.

The model graph writes both, so every consumer reads small tables. Every
aggregate is duplicate-insensitive, so the input does not need the detail's
29-column DISTINCT.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flocklens.config import IN_PERSON, SECOND_SERVICE_TIME, WORSHIP_TYPE, Settings
from flocklens.functions.dates import days_before
from flocklens.functions.text import non_blank, norm

PASSTHROUGH_ATTRIBUTES = (
    "salutation", "phone", "mobile_phone", "fax", "country", "state_", "city",
    "street", "postal_code", "company", "opted_out_of_email",
)


def distinct_tuples(df: DataFrame, *cols) -> DataFrame:
    """Distinct ``cols`` with their row count ``_n``.

    A hash aggregate on the (string) columns with map-side partials. A bare
    ``distinct()`` under a min/max aggregate is removed by Catalyst
    (RemoveRedundantAggregates), which would leave the sort-based string
    aggregate to run over every raw row; the upper aggregate therefore
    references ``_n``, placed where it can never decide a pick."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))


def _flag(cond: Column) -> Column:
    return F.max(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def _count_days(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def contact_days(ed_rows: DataFrame, settings: Settings) -> DataFrame:
    """One row per (contact_id, event_date, participant_type) with integer day
    flags: fixed-width buffers, so a hash aggregate with map-side partials."""
    worship = F.col("type") == F.lit(WORSHIP_TYPE)
    role = F.col("participant_type").isin(*settings.member_roles)
    return ed_rows.groupBy("contact_id", "event_date", "participant_type").agg(
        _flag(worship).alias("w"),
        _flag(worship & role).alias("wr"),
        _flag(worship & (F.col("attendance_type") == F.lit(IN_PERSON))).alias("wip"),
        _flag(worship & (F.col("event_time") == F.lit(SECOND_SERVICE_TIME))).alias("wss"),
    )


def contact_activity(contact_days: DataFrame, settings: Settings) -> DataFrame:
    """Window counts, worship shares, first and latest days per contact (hash
    aggregates over at most one row per day)."""
    days = contact_days.groupBy("contact_id", "event_date").agg(*[F.max(c).alias(c) for c in ("w", "wr", "wip", "wss")])
    d = F.col("event_date")
    age = days_before(settings.as_of, d)
    recent = age <= F.lit(settings.recent_days)
    baseline = (age > F.lit(settings.recent_days)) & (age <= F.lit(settings.baseline_days))
    dated = d.isNotNull()
    w, wr = F.col("w") == 1, F.col("wr") == 1
    return days.groupBy("contact_id").agg(
        F.max("w").alias("has_worship"),
        F.max("wr").alias("has_member_worship"),
        _count_days(wr & recent).alias("recent_attendance"),
        _count_days(wr & baseline).alias("baseline_attendance"),
        F.max(F.when(w, d)).alias("latest_worship_date"),
        _count_days(w & dated).alias("worship_days"),
        _count_days((F.col("wip") == 1) & dated).alias("in_person_days"),
        _count_days((F.col("wss") == 1) & dated).alias("second_service_days"),
        F.min(d).alias("first_crm_event_date"),
    )


def contact_tuples(ed_rows: DataFrame) -> DataFrame:
    """Distinct descriptive tuples of each contact with their row count: a hash
    aggregate on string keys that collapses a contact's many identical rows on
    the map side."""
    return distinct_tuples(ed_rows, "contact_id", "first_name", "last_name", "email", *PASSTHROUGH_ATTRIBUTES)


def contact_attributes(tuples: DataFrame) -> DataFrame:
    """Deterministic picks of the contact's descriptive columns."""
    first, last, email = F.col("first_name"), F.col("last_name"), F.col("email")
    named = first.isNotNull() & last.isNotNull()
    return tuples.groupBy("contact_id").agg(
        F.sum("_n").alias("detail_rows"),
        F.min(F.when(non_blank(first), first)).alias("first_pick"),
        F.min(F.when(non_blank(last), last)).alias("last_pick"),
        F.min(F.when(named, F.struct(first.alias("f"), last.alias("l")))).alias("name_pair"),
        F.min(F.when(named, norm(email))).alias("named_email"),
        F.min(norm(email)).alias("email_1"),
        *[F.min(c).alias(c) for c in PASSTHROUGH_ATTRIBUTES],
    )


def latest_participant_type(contact_days: DataFrame) -> DataFrame:
    """Participant type on the contact's latest event day (undated days last;
    the largest type that day)."""
    latest = F.struct(F.col("event_date").alias("d"), F.col("participant_type").alias("pt"), F.col("w").alias("w"))
    return contact_days.groupBy("contact_id").agg(F.max(latest)["pt"].alias("participant_type"))


def contact_profile(days: DataFrame, tuples: DataFrame, settings: Settings) -> DataFrame:
    """One row per contact_id (NULL contact ids form one group, as in SQL).

    The parts are stacked and grouped again rather than joined, so the NULL
    contact group survives and no join is needed; each column has one
    non-NULL source per contact."""
    u = contact_activity(days, settings)
    for part in (contact_attributes(tuples), latest_participant_type(days)):
        u = u.unionByName(part, allowMissingColumns=True)
    return u.groupBy("contact_id").agg(*[F.max(c).alias(c) for c in u.columns if c != "contact_id"])
