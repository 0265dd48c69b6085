"""First-touch tracking: the first event a person attended in either registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flocklens.config import FIRST_CRM_EVENT_NAME
from flocklens.functions.text import norm
from flocklens.operators.profile import distinct_tuples


def first_crm_event(profile: DataFrame) -> DataFrame:
    """Earliest CRM event day per contact, over all event types."""
    return profile.select(
        "contact_id",
        F.col("first_crm_event_date").alias("first_event_date"),
        F.lit(FIRST_CRM_EVENT_NAME).alias("first_event_name"),
    )


def first_ticket_event(att_stg: DataFrame, ev_stg: DataFrame) -> DataFrame:
    """Per normalised ticket email: first event day and that event's name
    (undated events sort first, as in an ascending SQL sort; ties -> the
    smallest name). Distinct (email, day, name) first -- a hash aggregate
    with map-side partials -- so a shared or placeholder email cannot pile up
    in one task before the min-of-struct pick."""
    a = att_stg.select(norm("email").alias("email_key"), "eventbrite_event_id")
    e = ev_stg.select("eventbrite_event_id", "event_date", "event_name")
    j = distinct_tuples(a.join(e, "eventbrite_event_id", "inner"), "email_key", "event_date", "event_name")
    g = j.groupBy("email_key").agg(
        F.min("event_date").alias("first_event_date"),
        F.min(F.struct(F.col("event_date").alias("d"), F.col("event_name").alias("n"), F.col("_n").alias("c"))).alias("p"),
    )
    return g.select("email_key", "first_event_date", F.col("p")["n"].alias("first_event_name"))


def first_touch(ticket_date: Column, ticket_name: Column, crm_date: Column):
    """(date, name) of the earlier first event; the ticket one only when
    strictly earlier. The CRM name is the fixed label."""
    ticket_first = ticket_date.isNotNull() & (ticket_date < crm_date)
    date = F.when(ticket_first, ticket_date).otherwise(crm_date)
    name = (
        F.when(ticket_first, ticket_name)
        .when(crm_date.isNotNull(), F.lit(FIRST_CRM_EVENT_NAME))
        .otherwise(F.lit(None).cast("string"))
    )
    return date, name
