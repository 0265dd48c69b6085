"""Ticketing attendance aligned to the CRM detail's shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flocklens.config import IN_PERSON, ONLINE, TICKET_ID_PREFIX
from flocklens.functions.text import norm
from flocklens.operators.profile import distinct_tuples


def email_to_contact(ed_rows: DataFrame) -> DataFrame:
    """Per normalised CRM email, the contact with the latest event day
    (undated rows last; ties -> the largest contact id)."""
    e = ed_rows.filter(F.col("email").isNotNull()).select(norm("email").alias("email"), "event_date", "contact_id")
    t = distinct_tuples(e, "email", "event_date", "contact_id")
    g = t.groupBy("email").agg(
        F.max(F.struct(F.col("event_date").alias("d"), F.col("contact_id").alias("c"), F.col("_n").alias("n"))).alias("m")
    )
    return g.select("email", F.col("m")["c"].alias("contact_id"))


def dedup_attendees(att_stg: DataFrame) -> DataFrame:
    """One registration per (event, normalised email): checked-in first, then
    the smallest attendee id in string order. NULL/placeholder emails collapse
    to one row per event, as the grouping key says.

    ``row_number() = 1`` lets Catalyst plan a partial WindowGroupLimit before
    the shuffle, so a hot (event, email) group is cut to one row per map task."""
    w = Window.partitionBy("eventbrite_event_id", "_email_key").orderBy(
        F.col("checked_in").desc_nulls_last(), F.col("eventbrite_attendee_id").asc_nulls_first()
    )
    return (
        att_stg.withColumn("_email_key", norm("email"))
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .drop("_rn", "_email_key")
    )


def ticket_attendance(att_stg: DataFrame, ev_stg: DataFrame, ed_rows: DataFrame) -> DataFrame:
    """Deduplicated registrations of live events, resolved to a CRM contact by
    email, else identified by prefix + attendee id."""
    a = dedup_attendees(att_stg).withColumn("_email_key", norm("email"))
    e = ev_stg.select("eventbrite_event_id", "event_name", "type", "event_format", "event_date", "event_time")
    lookup = email_to_contact(ed_rows).withColumnRenamed("email", "_email_key").withColumnRenamed(
        "contact_id", "_crm_contact_id"
    )
    j = a.join(e, "eventbrite_event_id", "inner").join(lookup, "_email_key", "left")
    return j.select(
        F.col("eventbrite_event_id").alias("event_id"),
        "event_name",
        "type",
        "event_format",
        "event_date",
        "event_time",
        F.coalesce(
            F.col("_crm_contact_id"), F.concat(F.lit(TICKET_ID_PREFIX), F.col("eventbrite_attendee_id"))
        ).alias("contact_id"),
        "first_name",
        "last_name",
        F.col("_email_key").alias("email"),
        F.col("phone_raw").alias("phone"),
        F.col("checked_in").alias("attendance_indicator"),
        F.when(F.col("event_format") == F.lit(ONLINE), F.lit(ONLINE)).otherwise(F.lit(IN_PERSON)).alias(
            "attendance_type"
        ),
    )
