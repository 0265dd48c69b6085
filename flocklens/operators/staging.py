"""Staging models: the CRM attendance detail and the three ticketing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flocklens.functions.rules import attendance_type, classify_event, event_format
from flocklens.functions.text import digits_only, norm
from flocklens.config import TICKET_SOURCE

EVENT_DETAIL_COLUMNS = (
    "event_id", "event_name", "description", "type", "event_format", "event_date",
    "event_time", "budget", "cost", "expected_revenue", "contact_id", "first_name",
    "last_name", "salutation", "phone", "mobile_phone", "email", "fax", "country",
    "state_", "city", "street", "postal_code", "company", "participant_type",
    "opted_out_of_email", "status", "attendance_indicator", "attendance_type",
)


def campaign_attributes(campaign: DataFrame) -> DataFrame:
    """Campaign columns under their event names (one row per campaign)."""
    return campaign.select(
        F.col("Id").alias("event_id"),
        F.col("Name").alias("event_name"),
        F.col("Description").alias("description"),
        F.col("Type").alias("type"),
        F.col("Format__c").alias("event_format"),
        F.col("EndDate").alias("event_date"),
        F.col("Service_Time__c").alias("event_time"),
        F.col("BudgetedCost").alias("budget"),
        F.col("ActualCost").alias("cost"),
        F.col("ExpectedRevenue").alias("expected_revenue"),
    )


def active_campaigns(campaign: DataFrame, member: DataFrame) -> DataFrame:
    """Campaign rows that have at least one member row: exactly the event
    side of the detail join, without the member columns. A left semi join
    against the distinct member campaign ids reads one column of the member
    table instead of joining every member row and deduplicating after."""
    ids = member.select(F.col("CampaignId").alias("event_id")).filter(F.col("event_id").isNotNull()).distinct()
    return campaign_attributes(campaign).join(ids, "event_id", "left_semi")


def event_detail_rows(campaign: DataFrame, member: DataFrame) -> DataFrame:
    """Campaign x member join with snake-case names, *without* the final DISTINCT.

    Every other consumer aggregates duplicate-insensitively (min, max,
    count distinct) or ends in its own DISTINCT, so they read this form and
    skip a 29-column shuffle of the largest table. The campaign side is one
    row per event; AQE broadcasts it when its measured size allows.
    """
    c = campaign_attributes(campaign)
    m = member.select(
        F.col("CampaignId").alias("_campaign_id"),
        F.col("ContactId").alias("contact_id"),
        F.col("FirstName").alias("first_name"),
        F.col("LastName").alias("last_name"),
        F.col("Salutation").alias("salutation"),
        F.col("Phone").alias("phone"),
        F.col("MobilePhone").alias("mobile_phone"),
        F.col("Email").alias("email"),
        F.col("Fax").alias("fax"),
        F.col("Country").alias("country"),
        F.col("State").alias("state_"),
        F.col("City").alias("city"),
        F.col("Street").alias("street"),
        F.col("PostalCode").alias("postal_code"),
        F.col("CompanyOrAccount").alias("company"),
        F.col("Participant_Type__c").alias("participant_type"),
        F.col("HasOptedOutOfEmail").alias("opted_out_of_email"),
        F.col("Status").alias("status"),
        F.col("Attendance_Indicator__c").alias("attendance_indicator"),
    )
    j = m.join(c, m["_campaign_id"] == c["event_id"], "inner")
    return j.withColumn("attendance_type", attendance_type("status")).select(*EVENT_DETAIL_COLUMNS)


def event_detail(campaign: DataFrame, member: DataFrame) -> DataFrame:
    """The published model: the distinct rows of the join. Both sides' keys are
    in the output, so each side is made distinct on its own columns before the
    join, and the campaign's texts are not shuffled once per member row."""
    return event_detail_rows(campaign.distinct(), member.distinct())


def stg_ticket_events(raw: DataFrame) -> DataFrame:
    """Live ticketing events: soft-deleted and draft rows dropped (a NULL
    flag or status drops the row, as a SQL WHERE does)."""
    src = raw.filter((F.col("_fivetran_deleted") == F.lit(False)) & (F.col("status") != F.lit("draft")))
    return src.select(
        F.col("id").cast("string").alias("eventbrite_event_id"),
        F.col("name_text").alias("event_name"),
        F.col("description_text").alias("description"),
        F.lit(TICKET_SOURCE).alias("event_source"),
        classify_event("name_text").alias("type"),
        event_format("online_event").alias("event_format"),
        F.to_date("start_local").alias("event_date"),
        F.date_format("start_local", "hh:mm a").alias("event_time"),
        F.col("start_local").alias("event_start_at"),
        F.col("end_local").alias("event_end_at"),
        "venue_id",
        "capacity",
        "status",
        "is_free",
        F.col("_fivetran_synced").alias("synced_at"),
    )


def stg_ticket_attendees(raw: DataFrame) -> DataFrame:
    """Active registrations (not deleted, cancelled or refunded)."""
    active = (
        (F.col("_fivetran_deleted") == F.lit(False))
        & (F.col("cancelled") == F.lit(False))
        & (F.col("refunded") == F.lit(False))
    )
    return raw.filter(active).select(
        F.col("id").cast("string").alias("eventbrite_attendee_id"),
        F.col("event_id").cast("string").alias("eventbrite_event_id"),
        F.col("order_id").cast("string").alias("eventbrite_order_id"),
        F.col("profile_first_name").alias("first_name"),
        F.col("profile_last_name").alias("last_name"),
        norm("profile_email").alias("email"),
        digits_only("profile_cell_phone").alias("phone_normalized"),
        F.col("profile_cell_phone").alias("phone_raw"),
        "checked_in",
        "status",
        F.col("created").alias("registered_at"),
        F.col("_fivetran_synced").alias("synced_at"),
    )


def stg_ticket_orders(raw: DataFrame) -> DataFrame:
    """Orders that are not soft-deleted."""
    return raw.filter(F.col("_fivetran_deleted") == F.lit(False)).select(
        F.col("id").cast("string").alias("eventbrite_order_id"),
        F.col("event_id").cast("string").alias("eventbrite_event_id"),
        F.col("owner_first_name").alias("first_name"),
        F.col("owner_last_name").alias("last_name"),
        norm("owner_email").alias("email"),
        "status",
        F.col("gross_major_value").alias("order_total"),
        F.col("gross_currency").alias("currency"),
        F.col("created").alias("ordered_at"),
        F.col("_fivetran_synced").alias("synced_at"),
    )
