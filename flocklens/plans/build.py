"""The model graph: every published relation as a lazily built DataFrame.

``Build`` wires the operators together once per (sources, settings). Each
property returns the same DataFrame object on every access, so a relation
used by several downstream models is one subtree of the final plan (Spark
reuses identical exchanges). The relations named in ``WRITTEN`` are written to
the run folder when they are first needed (or all at once by ``prepare``), and
the owner of the build removes them with ``close``; with ``materialize=False``
nothing is written and nothing runs until an action is called.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flocklens.config import WORSHIP_TYPE, Settings
from flocklens.operators import (
    dims,
    fact,
    identity,
    journeys,
    members,
    profile,
    quality,
    risk,
    staging,
    ticketing,
)
from flocklens.plans.materialize import Materializer
from flocklens.sources.raw import Sources


WRITTEN = (
    "contact_days", "contact_tuples", "period_days", "stats", "profile", "first_ticket_event", "candidates", "resolution",
    "attendance_base",
)


class Build:
    def __init__(self, spark: SparkSession, sources: Sources, settings: Settings, materialize: bool = True):
        self.spark = spark
        self.src = sources
        self.settings = settings
        self.keep = Materializer(spark, enabled=materialize)

    def prepare(self) -> Build:
        """Write all shared intermediates now."""
        for name in WRITTEN:
            getattr(self, name)
        return self

    def close(self) -> None:
        """Remove the written intermediates; the build's relations end with them."""
        self.keep.cleanup()

    # -- staging --------------------------------------------------------
    @cached_property
    def ed_rows(self) -> DataFrame:
        return staging.event_detail_rows(self.src.campaign, self.src.campaign_member)

    @cached_property
    def active_campaigns(self) -> DataFrame:
        return staging.active_campaigns(self.src.campaign, self.src.campaign_member)

    @cached_property
    def event_detail(self) -> DataFrame:
        return staging.event_detail(self.src.campaign, self.src.campaign_member)

    @cached_property
    def stg_events(self) -> DataFrame:
        return staging.stg_ticket_events(self.src.ticket_event)

    @cached_property
    def stg_attendees(self) -> DataFrame:
        return staging.stg_ticket_attendees(self.src.ticket_attendee)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_ticket_orders(self.src.ticket_order)

    # -- dimensions -----------------------------------------------------
    @cached_property
    def dim_events(self) -> DataFrame:
        return dims.dim_events(self.active_campaigns)

    @cached_property
    def campaign_events(self) -> DataFrame:
        return staging.campaign_attributes(self.src.campaign)

    @cached_property
    def dim_dates(self) -> DataFrame:
        return dims.dim_dates(self.spark, self.settings)

    # -- per-contact profile and risk ------------------------------------
    @cached_property
    def contact_days(self) -> DataFrame:
        return self.keep(profile.contact_days(self.ed_rows, self.settings), "contact_days")

    @cached_property
    def contact_tuples(self) -> DataFrame:
        return self.keep(profile.contact_tuples(self.ed_rows), "contact_tuples")

    @cached_property
    def activity(self) -> DataFrame:
        return profile.contact_activity(self.contact_days, self.settings)

    @cached_property
    def latest_type(self) -> DataFrame:
        return profile.latest_participant_type(self.contact_days)

    @cached_property
    def profile(self) -> DataFrame:
        return self.keep(profile.contact_profile(self.contact_days, self.contact_tuples, self.settings), "profile")

    @cached_property
    def period_days(self) -> DataFrame:
        # every worship day has a contact day; one row, read by several models
        days = self.contact_days.filter("w = 1").select("event_date", F.lit(WORSHIP_TYPE).alias("type"))
        return self.keep(risk.period_event_days(days, self.settings), "period_days")

    @cached_property
    def rates(self) -> DataFrame:
        return risk.attendance_rates(self.activity, self.period_days)

    @cached_property
    def stats(self) -> DataFrame:
        return self.keep(risk.rate_stats(self.activity, self.period_days), "stats")

    @cached_property
    def risk_flags(self) -> DataFrame:
        return risk.risk_flags(self.rates, self.stats)

    @cached_property
    def hybrid_risk(self) -> DataFrame:
        return risk.hybrid_risk(self.risk_flags)

    @cached_property
    def latest_worship(self) -> DataFrame:
        return risk.latest_worship(self.activity)

    # -- journeys ---------------------------------------------------------
    @cached_property
    def first_crm_event(self) -> DataFrame:
        return journeys.first_crm_event(self.activity)

    @cached_property
    def first_ticket_event(self) -> DataFrame:
        return self.keep(journeys.first_ticket_event(self.stg_attendees, self.stg_events), "first_ticket_event")

    # -- identity ---------------------------------------------------------
    @cached_property
    def crm_emails(self) -> DataFrame:
        return identity.crm_emails(self.contact_tuples)

    @cached_property
    def crm_contacts(self) -> DataFrame:
        return identity.crm_contacts(self.profile)

    @cached_property
    def valid_attendees(self) -> DataFrame:
        return identity.valid_attendee_contacts(self.stg_attendees, self.settings)

    @cached_property
    def candidates(self) -> DataFrame:
        return self.keep(identity.ticket_candidates(self.valid_attendees, self.crm_emails), "candidates")

    @cached_property
    def tier2(self) -> DataFrame:
        return identity.exact_name_match(self.candidates, self.crm_contacts)

    @cached_property
    def unresolved(self) -> DataFrame:
        return identity.unresolved_candidates(self.candidates, self.crm_contacts)

    @cached_property
    def name_matches(self) -> DataFrame:
        keep = self.keep if self.keep.enabled else None
        return identity.best_name_matches(self.unresolved, self.crm_contacts, self.settings, keep)

    @cached_property
    def tier3(self) -> DataFrame:
        return identity.best_similar_name(self.unresolved, self.name_matches, self.settings)

    @cached_property
    def resolution(self) -> DataFrame:
        return self.keep(identity.name_resolution(self.tier2, self.tier3), "resolution")

    @cached_property
    def high_matches(self) -> DataFrame:
        return identity.high_confidence_matches(self.resolution)

    @cached_property
    def flagged(self) -> DataFrame:
        return identity.flagged_matches(self.resolution)

    # -- members ------------------------------------------------------------
    @cached_property
    def member_core(self) -> DataFrame:
        return members.member_core(self.profile)

    @cached_property
    def crm_members(self) -> DataFrame:
        return members.crm_members(
            self.profile, self.period_days, self.stats, self.high_matches, self.first_ticket_event, self.flagged
        )

    @cached_property
    def ticket_only(self) -> DataFrame:
        return members.ticket_only_contacts(self.candidates, self.high_matches, self.resolution, self.first_ticket_event)

    @cached_property
    def dim_members(self) -> DataFrame:
        return members.dim_members(self.crm_members, self.ticket_only)

    # -- facts ----------------------------------------------------------------
    @cached_property
    def attendance_base(self) -> DataFrame:
        base = fact.attendance_base(self.ed_rows, self.member_core, self.campaign_events, self.dim_dates)
        return self.keep(base, "attendance_base")

    @cached_property
    def fact_attendance(self) -> DataFrame:
        return fact.fact_attendance(self.attendance_base)

    @cached_property
    def ticket_attendance(self) -> DataFrame:
        return ticketing.ticket_attendance(self.stg_attendees, self.stg_events, self.ed_rows)

    # -- quality --------------------------------------------------------------
    def dq(self, which: str) -> DataFrame:
        fn = getattr(quality, which)
        return fn(self.stg_events, self.stg_attendees, self.stg_orders)
