"""Column contracts of the five raw source tables.

The CRM tables keep their CRM column names; the ticketing tables keep the
connector's names (including the soft-delete flag). Only the columns the
models read are listed; extra columns in a file are ignored by the reader.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, L, D, B, DT, TS = StringType(), LongType(), DoubleType(), BooleanType(), DateType(), TimestampNTZType()

CAMPAIGN = _s(
    ("Id", S), ("Name", S), ("Description", S), ("Type", S), ("Format__c", S),
    ("EndDate", DT), ("Service_Time__c", S), ("BudgetedCost", D), ("ActualCost", D),
    ("ExpectedRevenue", D),
)

CAMPAIGN_MEMBER = _s(
    ("CampaignId", S), ("ContactId", S), ("FirstName", S), ("LastName", S),
    ("Salutation", S), ("Phone", S), ("MobilePhone", S), ("Email", S), ("Fax", S),
    ("Country", S), ("State", S), ("City", S), ("Street", S), ("PostalCode", S),
    ("CompanyOrAccount", S), ("Participant_Type__c", S), ("HasOptedOutOfEmail", B),
    ("Status", S), ("Attendance_Indicator__c", B),
)

TICKET_EVENT = _s(
    ("id", L), ("name_text", S), ("description_text", S), ("online_event", B),
    ("start_local", TS), ("end_local", TS), ("venue_id", L), ("capacity", L),
    ("status", S), ("is_free", B), ("_fivetran_deleted", B), ("_fivetran_synced", TS),
)

TICKET_ATTENDEE = _s(
    ("id", L), ("event_id", L), ("order_id", L), ("profile_first_name", S),
    ("profile_last_name", S), ("profile_email", S), ("profile_cell_phone", S),
    ("checked_in", B), ("status", S), ("created", TS), ("cancelled", B),
    ("refunded", B), ("_fivetran_deleted", B), ("_fivetran_synced", TS),
)

TICKET_ORDER = _s(
    ("id", L), ("event_id", L), ("owner_first_name", S), ("owner_last_name", S),
    ("owner_email", S), ("status", S), ("gross_major_value", D), ("gross_currency", S),
    ("created", TS), ("_fivetran_deleted", B), ("_fivetran_synced", TS),
)

CONTRACTS = {
    "campaign": CAMPAIGN,
    "campaign_member": CAMPAIGN_MEMBER,
    "ticket_event": TICKET_EVENT,
    "ticket_attendee": TICKET_ATTENDEE,
    "ticket_order": TICKET_ORDER,
}
