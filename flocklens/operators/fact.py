"""The attendance fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flocklens.config import IN_PERSON, SECOND_SERVICE_TIME, WORSHIP_TYPE

FACT_COLUMNS = (
    "event_id", "event_date", "time_bucket", "event_time", "type", "event_format",
    "attendance_type", "contact_id", "first_name", "last_name", "participant_type",
    "in_person_count", "second_service_count", "events_attended", "events_sum",
)


def attendance_base(ed_rows: DataFrame, members: DataFrame, events: DataFrame, dates: DataFrame) -> DataFrame:
    """Attended rows joined to the member, event and date dimensions, built once.

    The detail is first reduced to distinct (event, contact, attendance type):
    all the fact keeps of a detail row. That partial DISTINCT runs map-side, so
    a contact holding a third of the rows shrinks to one row per event before
    any join. The date dimension is bounded (<= 18,251 rows) and broadcast;
    events and members are joined on their keys (AQE broadcasts the event
    side when its measured size is small).

    ``events`` may be the event dimension or the campaign attributes
    themselves: every joined event has a detail row, so both give the same
    rows, and the campaign table avoids another pass over the detail."""
    att = (
        ed_rows.filter(F.col("attendance_indicator") == F.lit(True))
        .select("event_id", "contact_id", "attendance_type")
        .distinct()
    )
    ev = events.select("event_id", "event_date", "event_time", "type", "event_format").distinct()
    dd = dates.select(F.col("date").alias("event_date"), "time_bucket")
    m = members.select("contact_id", "first_name", "last_name", "participant_type")
    return att.join(ev, "event_id", "inner").join(F.broadcast(dd), "event_date", "inner").join(m, "contact_id", "inner")


def service_days(base: DataFrame) -> DataFrame:
    """One row per (contact, bucket, day) with worship-service day flags."""
    worship = F.col("type") == F.lit(WORSHIP_TYPE)
    ip = worship & (F.col("attendance_type") == F.lit(IN_PERSON))
    ss = worship & (F.col("event_time") == F.lit(SECOND_SERVICE_TIME))
    return base.groupBy("contact_id", "time_bucket", "event_date").agg(
        F.max(F.when(ip, F.lit(1)).otherwise(F.lit(0))).alias("ip"),
        F.max(F.when(ss, F.lit(1)).otherwise(F.lit(0))).alias("ss"),
    )


def service_counts(base: DataFrame) -> DataFrame:
    """Per (bucket, contact): distinct in-person worship days, distinct 11:30
    worship days, and distinct attended days (the per-contact window count)."""
    return service_days(base).groupBy("time_bucket", "contact_id").agg(
        F.sum("ip").cast("long").alias("in_person_count"),
        F.sum("ss").cast("long").alias("second_service_count"),
        F.count(F.lit(1)).alias("events_attended"),
    )


def events_per_bucket(base: DataFrame) -> DataFrame:
    """Distinct attended days per recency bucket: at most 5 rows."""
    days = base.select("time_bucket", "event_date").distinct()
    return days.groupBy("time_bucket").agg(F.count(F.lit(1)).alias("events_sum"))


def fact_attendance(base: DataFrame) -> DataFrame:
    """One row per attended (event attributes, attendance type, member) with the
    member's per-bucket service counts and the bucket's distinct event days.

    ``base`` is the written attendance base: the counts aggregate it and join
    back. The two DISTINCT window counts become grouped counts; the per-bucket
    one has at most five rows (broadcast), where a window over it would have
    put the whole fact into five tasks. Rows are distinct by construction
    (distinct keys, 1:1 lookups), so no final DISTINCT pass."""
    out = base.join(service_counts(base), ["time_bucket", "contact_id"], "inner").join(
        F.broadcast(events_per_bucket(base)), "time_bucket", "inner"
    )
    return out.select(*FACT_COLUMNS)
