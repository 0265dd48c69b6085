"""Registered queries: name -> builder over a Build.

Each query reads the driver tables through the fixture adapter (so its work
grows with them) and returns one published relation of the model graph, or a
column function applied to a source table. Computed columns carry the same
names as in ``flocklens.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flocklens.config import FIXTURE_CALENDAR_SETTINGS, FIXTURE_SETTINGS
from flocklens.functions.rules import attendance_type, risk_eligible, rule_flag
from flocklens.functions.dates import days_before, time_bucket
from flocklens.functions.text import digits_only, display_name, norm, surrogate_id
from flocklens.operators import dims, fact, identity, risk, ticketing
from flocklens.plans.build import Build
from flocklens.session import ensure_checkpoint_dir
from flocklens.sources.fixture import fixture_sources


_BUILDS: dict[tuple, Build] = {}


def fixture_build(spark: SparkSession, sf_dir: str, shared: bool = True, materialize: bool = True) -> Build:
    """The model graph over the driver tables at ``sf_dir``.

    With ``shared`` one Build per (application, directory) is reused, so the
    registered queries share their written intermediates."""
    if spark.sparkContext.master.split("[")[0] == "local":
        # tests and local runs that name no folder get a private one
        ensure_checkpoint_dir(spark)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), materialize)
    if shared and key in _BUILDS:
        return _BUILDS[key]
    b = Build(spark, fixture_sources(spark, sf_dir), FIXTURE_SETTINGS, materialize=materialize)
    if shared:
        _BUILDS[key] = b
    return b


def _statistical(b: Build) -> DataFrame:
    flag = risk.statistical_risk("recent_attendance", b.stats)
    return b.rates.select("contact_id", "recent_rate", flag.alias("statistical_flag"))


QUERIES: dict[str, Callable[[Build], DataFrame]] = {
    # sources and staging
    "scan_campaign": lambda b: b.src.campaign,
    "scan_campaign_member": lambda b: b.src.campaign_member,
    "event_detail": lambda b: b.event_detail,
    "attendance_type": lambda b: b.src.campaign_member.groupBy(
        F.col("Status").alias("status"), attendance_type("Status").alias("attendance_type")
    ).agg(F.count(F.lit(1)).alias("n_rows")),
    "stg_ticket_events": lambda b: b.stg_events,
    "event_classification": lambda b: b.stg_events.select(
        "eventbrite_event_id", "event_name", "type", "event_format"
    ),
    "stg_ticket_attendees": lambda b: b.stg_attendees,
    "stg_ticket_orders": lambda b: b.stg_orders,
    "normalize_email": lambda b: b.src.ticket_attendee.select(
        F.col("id").alias("attendee_id"), F.col("profile_email").alias("raw_email"), norm("profile_email").alias("email")
    ),
    "normalize_phone": lambda b: b.src.ticket_attendee.select(
        F.col("id").alias("attendee_id"),
        F.col("profile_cell_phone").alias("phone_raw"),
        digits_only("profile_cell_phone").alias("phone_normalized"),
    ),
    "proper_case_names": lambda b: b.src.campaign_member.select(
        F.col("FirstName").alias("raw_first_name"),
        F.col("LastName").alias("raw_last_name"),
        display_name("FirstName").alias("first_name"),
        display_name("LastName").alias("last_name"),
    ).distinct(),
    # dimensions
    "dim_events": lambda b: b.dim_events,
    "event_calendar": lambda b: dims.event_calendar(b.active_campaigns, b.spark, FIXTURE_CALENDAR_SETTINGS),
    "time_bucket": lambda b: b.ed_rows.select("event_date").distinct().select(
        "event_date",
        time_bucket(days_before(b.settings.as_of, F.col("event_date")), b.settings.bucket_period_days).alias(
            "time_bucket"
        ),
    ),
    # risk
    "period_event_days": lambda b: b.period_days,
    "member_period_attendance": lambda b: risk.member_period_attendance(b.activity),
    "attendance_rates": lambda b: b.rates.drop("recent_attendance"),
    "rate_stats": lambda b: b.stats.select("mean_recent", "sd_recent"),
    "risk_eligible": lambda b: b.rates.filter(risk_eligible("baseline_rate", "recent_rate")).select(
        "contact_id", "baseline_rate", "recent_rate"
    ),
    "risk_rule_flag": lambda b: b.rates.select(
        "contact_id", "baseline_rate", "drop_ratio", rule_flag("baseline_rate", "drop_ratio").alias("rule_based_flag")
    ),
    "risk_statistical_flag": _statistical,
    "risk_flags": lambda b: b.risk_flags,
    "hybrid_risk": lambda b: b.hybrid_risk,
    "latest_worship": lambda b: b.latest_worship,
    # journeys
    "first_crm_event": lambda b: b.first_crm_event,
    "first_ticket_event": lambda b: b.first_ticket_event,
    # identity
    "crm_contacts": lambda b: b.crm_contacts,
    "valid_attendee_contacts": lambda b: b.valid_attendees,
    "ticket_contacts_not_in_crm": lambda b: b.candidates.select("email_key", "first_name", "last_name"),
    "exact_name_match": lambda b: b.tier2,
    "unresolved_ticket_contacts": lambda b: b.unresolved.select("email_key", "first_name", "last_name"),
    "ambiguous_name_emails": lambda b: identity.ambiguous_name_emails(b.candidates, b.crm_contacts),
    "ambiguous_name_contacts": lambda b: identity.ambiguous_name_contacts(b.candidates, b.crm_contacts),
    "name_similarity_pairs": lambda b: b.name_matches,
    "best_similar_name": lambda b: b.tier3,
    "name_resolution": lambda b: b.resolution,
    "high_confidence_matches": lambda b: b.high_matches,
    "flagged_matches": lambda b: b.flagged,
    "surrogate_contact_id": lambda b: b.candidates.select(
        "email_key", surrogate_id("email_key").alias("contact_id")
    ),
    # members
    "latest_participant_type": lambda b: b.latest_type,
    "crm_members": lambda b: b.crm_members,
    "ticket_only_contacts": lambda b: b.ticket_only,
    "dim_members": lambda b: b.dim_members,
    "first_touch": lambda b: b.crm_members.select("contact_id", "first_event_date", "first_event_name"),
    # facts
    "attendance_base": lambda b: b.attendance_base,
    "service_counts": lambda b: fact.service_counts(b.attendance_base),
    "events_attended": lambda b: fact.service_counts(b.attendance_base).select(
        "contact_id", "time_bucket", "events_attended"
    ),
    "events_per_bucket": lambda b: fact.events_per_bucket(b.attendance_base),
    "fact_attendance": lambda b: b.fact_attendance,
    "email_to_contact": lambda b: ticketing.email_to_contact(b.ed_rows),
    "dedup_attendees": lambda b: ticketing.dedup_attendees(b.stg_attendees),
    "ticket_attendance": lambda b: b.ticket_attendance,
    # data quality
    "dq_unique_violations": lambda b: b.dq("dq_unique_violations"),
    "dq_not_null_violations": lambda b: b.dq("dq_not_null_violations"),
    "dq_summary": lambda b: b.dq("dq_summary"),
}


def query_callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def make(fn):
        return lambda spark, sf_dir: fn(fixture_build(spark, sf_dir))

    return {name: make(fn) for name, fn in QUERIES.items()}
