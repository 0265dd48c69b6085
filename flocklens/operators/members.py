"""The member dimension: CRM members plus ticketing-only contacts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flocklens.config import NOT_APPLICABLE
from flocklens.functions.rules import hybrid_flag, risk_eligible, rule_flag
from flocklens.functions.text import display_name, surrogate_id
from flocklens.operators.journeys import first_touch
from flocklens.operators.risk import scalar_row, statistical_risk

MEMBER_COLUMNS = (
    "contact_id", "first_name", "last_name", "salutation", "phone", "mobile_phone",
    "email_1", "email_2", "fax", "country", "state_", "city", "street", "postal_code",
    "company", "participant_type", "opted_out_of_email", "latest_worship_date",
    "baseline_rate", "recent_rate", "rule_based_flag", "statistical_flag", "hybrid_flag",
    "in_person_prop", "second_service_prop", "first_event_date", "first_event_name",
    "possible_duplicate_contact_id", "name_similarity",
)


def member_core(profile: DataFrame) -> DataFrame:
    """The member attributes the attendance fact needs. They depend only on
    the CRM detail, so the fact does not pull identity resolution into its
    plan. A contact is a member when some row has a non-blank first and
    some row a non-blank last name."""
    return profile.filter(F.col("first_pick").isNotNull() & F.col("last_pick").isNotNull()).select(
        "contact_id",
        display_name("first_pick").alias("first_name"),
        display_name("last_pick").alias("last_name"),
        "participant_type",
    )


def _high_match_pick(high: DataFrame, fe_eb: DataFrame) -> DataFrame:
    """One merged ticket email per CRM contact: the one with the earliest
    first ticket event (undated last), then the smallest email."""
    j = high.join(fe_eb, high["eb_email"] == fe_eb["email_key"], "left")
    d = F.col("first_event_date")
    g = j.groupBy("sf_contact_id").agg(
        F.min(
            F.struct(
                d.isNull().alias("undated"),
                d.alias("d"),
                F.col("eb_email").alias("e"),
                F.col("first_event_name").alias("n"),
            )
        ).alias("h")
    )
    return g.select(
        F.col("sf_contact_id").alias("contact_id"),
        F.col("h")["e"].alias("email_2"),
        F.col("h")["d"].alias("eb_first_date"),
        F.col("h")["n"].alias("eb_first_name"),
    )


def _flag_pick(flagged: DataFrame) -> DataFrame:
    """One possible duplicate per CRM contact: highest similarity, then the
    smallest ticketing id."""
    g = flagged.groupBy("sf_contact_id").agg(
        F.min(
            F.struct(
                (-F.col("name_similarity")).alias("k"),
                F.col("eb_contact_id").alias("c"),
                F.col("name_similarity").alias("s"),
            )
        ).alias("f")
    )
    return g.select(
        F.col("sf_contact_id").alias("contact_id"),
        F.col("f")["c"].alias("possible_duplicate_contact_id"),
        F.col("f")["s"].alias("name_similarity"),
    )


def crm_members(
    profile: DataFrame,
    period_days: DataFrame,
    stats: DataFrame,
    high: DataFrame,
    fe_eb: DataFrame,
    flagged: DataFrame,
) -> DataFrame:
    """CRM members: profile attributes, rates and risk flags, merged ticket
    email, first touch and possible duplicate; one row per contact.

    Rates and flags are computed in line from the profile against the two
    one-row relations (window day counts, rate statistics, as scalar
    subqueries), so the member rows are never joined to themselves; every
    other input is pre-reduced to one row per contact, so the left joins are
    1:1 and nothing fans out."""
    p = profile.filter(F.col("first_pick").isNotNull() & F.col("last_pick").isNotNull())
    pdays = scalar_row(period_days)
    rated = F.col("has_member_worship") == 1
    ra, ba = F.col("recent_attendance"), F.col("baseline_attendance")
    recent_rate = F.when(rated, F.try_divide(ra, pdays["recent_worship"]))
    baseline_rate = F.when(rated, F.try_divide(ba, pdays["baseline_worship"]))
    drop_ratio = F.try_divide(ba - ra, ba)
    eligible = rated & F.coalesce(risk_eligible(baseline_rate, recent_rate), F.lit(False))
    rule = rule_flag(baseline_rate, drop_ratio)
    stat = statistical_risk(F.when(rated, ra), stats)
    worshipped = F.col("has_worship") == 1
    p = p.select(
        "*",
        F.when(eligible, baseline_rate).alias("_baseline_rate"),
        F.when(eligible, recent_rate).alias("_recent_rate"),
        F.when(eligible, rule).otherwise(F.lit(NOT_APPLICABLE)).alias("rule_based_flag"),
        F.when(eligible, stat).otherwise(F.lit(NOT_APPLICABLE)).alias("statistical_flag"),
        F.when(eligible, hybrid_flag(rule, stat)).otherwise(F.lit(NOT_APPLICABLE)).alias("hybrid_flag"),
        F.when(worshipped, F.try_divide(F.col("in_person_days"), F.col("worship_days"))).alias("_ip"),
        F.when(worshipped, F.try_divide(F.col("second_service_days"), F.col("worship_days"))).alias("_ss"),
    )
    j = p.join(_high_match_pick(high, fe_eb), "contact_id", "left").join(_flag_pick(flagged), "contact_id", "left")
    fdate, fname = first_touch(F.col("eb_first_date"), F.col("eb_first_name"), F.col("first_crm_event_date"))
    computed = {
        "first_name": display_name("first_pick"),
        "last_name": display_name("last_pick"),
        "baseline_rate": F.col("_baseline_rate"),
        "recent_rate": F.col("_recent_rate"),
        "in_person_prop": F.col("_ip"),
        "second_service_prop": F.col("_ss"),
        "first_event_date": fdate,
        "first_event_name": fname,
    }
    return j.select(*[computed[c].alias(c) if c in computed else F.col(c) for c in MEMBER_COLUMNS])


def ticket_only_contacts(
    candidates: DataFrame, high: DataFrame, resolution: DataFrame, fe_eb: DataFrame
) -> DataFrame:
    """Ticketing contacts that are neither CRM emails nor merged by name:
    one row per email, id = prefix + md5(email), in the member shape."""
    c = candidates.join(high.select(F.col("eb_email").alias("email_key")), "email_key", "left_anti")
    r = resolution.select(
        F.col("eb_email").alias("email_key"),
        F.when(
            F.col("match_confidence").isin("medium", "low") & (F.col("n_sf_same_name") == 1),
            F.col("sf_contact_id"),
        ).alias("possible_duplicate_contact_id"),
        "name_similarity",
    )
    j = c.join(r, "email_key", "left").join(fe_eb, "email_key", "left")
    s, b, d, x = "string", "boolean", "date", "double"
    null = lambda t: F.lit(None).cast(t)
    na = F.lit(NOT_APPLICABLE)
    return j.select(
        surrogate_id("email_key").alias("contact_id"),
        display_name("first_name").alias("first_name"),
        display_name("last_name").alias("last_name"),
        null(s).alias("salutation"),
        F.col("phone").alias("phone"),
        null(s).alias("mobile_phone"),
        F.col("email_key").alias("email_1"),
        null(s).alias("email_2"),
        null(s).alias("fax"),
        null(s).alias("country"),
        null(s).alias("state_"),
        null(s).alias("city"),
        null(s).alias("street"),
        null(s).alias("postal_code"),
        null(s).alias("company"),
        null(s).alias("participant_type"),
        null(b).alias("opted_out_of_email"),
        null(d).alias("latest_worship_date"),
        null(x).alias("baseline_rate"),
        null(x).alias("recent_rate"),
        na.alias("rule_based_flag"),
        na.alias("statistical_flag"),
        na.alias("hybrid_flag"),
        null(x).alias("in_person_prop"),
        null(x).alias("second_service_prop"),
        "first_event_date",
        "first_event_name",
        "possible_duplicate_contact_id",
        "name_similarity",
    )


def dim_members(crm: DataFrame, ticket_only: DataFrame) -> DataFrame:
    return crm.select(*MEMBER_COLUMNS).unionByName(ticket_only.select(*MEMBER_COLUMNS))
