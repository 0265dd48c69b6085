"""Adapter: the driver's generic test tables -> the five raw registries.

The test harness ships TPC-H-like tables plus ``events`` / ``documents`` /
``benchmark``, none in CRM or ticketing shape. This module derives the raw
registries from them with plain DataFrame expressions (one deterministic rule
per column, documented in FIXTURES.md), so every query's work grows with the
driver tables: every ``events`` row becomes a member row, every ``documents``
row three registrations, every ``benchmark`` item a ticketing event.
``flocklens.plans.oracle`` holds the same mapping as DuckDB SQL.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from flocklens.plans.materialize import checkpoint_root, files_under
from flocklens.sources.raw import Sources, read_table
from flocklens.sources.schemas import CONTRACTS

# Fixed values of the fixture mapping.
FIRST_NAMES = ("Anna", "Ben", "Mary-Jane", "José", "zoë", " Ivan", "Ruth", "O'NEIL", "Li", "peter", "Sofia\u00a0", "Omar")
LAST_STEMS = ("Ander", "Berg", "Carl", "Dahl", "Eriks", "Fischer", "Gold", "Hart")
LAST_ENDINGS = ("son", "man", "ton", "ley", "well", "ford", "er", "s", "ßen", "-Ruiz")
SPLIT_DATE = "2024-01-22"
PATTERN = 40  # period of the ticketing events' status pattern
EVENT_EPOCH = "2023-12-25 09:00:00"
REGISTRATION_EPOCH = "2023-12-01 00:00:00"
SYNC_TIME = "2024-02-01 00:00:00"
TICKET_EVENT_NAMES = ("Sunday Worship Night", "PRAYER Meeting", "Bible Hour", "Study Group", "Picnic")
ROLES_BY_USER = ("Homer", "Elder", "Ecclesia", "Deacon", "Guest", "Visitor")
STATUS_BY_EVENT = (
    "Attended", "Attendeed", "Attended Online", "Attended (Online)", "Attended  (Online)", "No Show",
)
STATES = ("NY", "NJ", "CT", "PA")

_S, _L, _D, _TS = StringType(), LongType(), DoubleType(), TimestampNTZType()
# read schemas: the timestamp columns are zone-less in the files
DRIVER_SCHEMAS = {
    "events": StructType([StructField("event_id", _L), StructField("ts", _TS),
                          StructField("user_id", _L), StructField("event_type", _S)]),
    "documents": StructType([StructField("doc_id", _L), StructField("text", _S)]),
    "orders": StructType([StructField("o_orderkey", _L), StructField("o_custkey", _L),
                          StructField("o_orderstatus", _S), StructField("o_totalprice", _D),
                          StructField("o_orderdate", _TS)]),
    "customer": StructType([StructField("c_custkey", _L), StructField("c_name", _S)]),
    "benchmark": StructType([StructField("item_id", _L)]),
}


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(key: Column, values) -> Column:
    """``values[key]`` as a CASE (key is a small non-negative int)."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v) if v is not None else F.lit(None).cast("string")
        expr = F.when(key == i, lit) if expr is None else expr.when(key == i, lit)
    return expr


def _ntz(text: str) -> Column:
    return F.to_timestamp_ntz(F.lit(text))


def _str(c: Column) -> Column:
    return c.cast("string")


def doc_names(documents: DataFrame) -> DataFrame:
    """A name for every document, drawn by the digest of its whole text."""
    # the digest as a column of its own: within the CASEs each branch would take it again
    h = F.md5(F.coalesce(F.col("text"), F.lit("")))
    documents = documents.select("doc_id", h.alias("_h"))
    documents = documents.select("doc_id", *[F.conv(F.substring("_h", 1 + 4 * k, 4), 16, 10).cast("int").alias(f"_{k}") for k in range(6)])
    part = lambda k: F.col(f"_{k}")
    stem = _pick(part(1) % len(LAST_STEMS), LAST_STEMS)
    last = F.concat(stem, _pick(part(2) % len(LAST_ENDINGS), LAST_ENDINGS))
    double = F.concat(last, F.lit("-"), _pick(part(4) % len(LAST_STEMS), LAST_STEMS), (part(5) % 9).cast("string"))
    return documents.select(
        "doc_id",
        _pick(part(0) % len(FIRST_NAMES), FIRST_NAMES).alias("first"),
        F.when(part(3) % 3 == 0, double).otherwise(last).alias("last"),
    )


def _slot(events: DataFrame) -> DataFrame:
    """Each event's campaign: its type, day and half day. Some rows of three
    user groups go to an outing of the same half day instead, which gives
    these groups a falling, a rising and a sparse worship attendance."""
    u, eid, d = F.col("user_id"), F.col("event_id"), F.to_date("ts")
    late = d >= F.lit(SPLIT_DATE).cast("date")
    elsewhere = (
        ((u % 5 == 0) & late & (eid % 4 != 0))
        | ((u % 5 == 1) & ~late & (eid % 3 != 0))
        | ((u % 5 == 2) & (eid % 8 != 0))
    )
    kind = F.when(elsewhere, F.lit("outing")).otherwise(F.col("event_type"))
    return _slot_texts(events.select("*", d.alias("_d"), (F.hour("ts") < 12).alias("_am"), kind.alias("_kind")))


def _slot_texts(slots: DataFrame) -> DataFrame:
    """The half day as text and the slot's id."""
    half = F.when(F.col("_am"), F.lit("am")).otherwise(F.lit("pm"))
    slot = F.concat(F.col("_kind"), F.lit("-"), _str(F.col("_d")), F.lit("-"), half)
    return slots.select("*", half.alias("_half"), slot.alias("_slot"))


def campaign(events: DataFrame) -> DataFrame:
    """One campaign per (event_type, day, morning/afternoon) slot."""
    e = _slot(events)
    dom = F.dayofmonth("_d")
    worshipish = F.col("_kind").isin("view", "click", "purchase")
    # few slots, many events: the texts are made once a slot
    e = _slot_texts(e.select("_kind", "_d", "_am").distinct())
    return e.select(
        F.col("_slot").alias("Id"),
        F.concat(F.col("_kind"), F.lit(" service "), _str(F.col("_d")), F.lit(" "), F.col("_half")).alias("Name"),
        F.when(dom % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Slot "), F.col("_slot"))).alias("Description"),
        F.when(worshipish, F.lit("Worship Service"))
        .when(F.col("_kind") == "signup", F.lit("Prayer"))
        .otherwise(F.lit("Event")).alias("Type"),
        F.when(F.col("_kind") == "click", F.lit("Online")).otherwise(F.lit("In-Person")).alias("Format__c"),
        F.col("_d").alias("EndDate"),
        F.when(F.col("_am"), F.lit("09:30 AM")).otherwise(F.lit("11:30 AM")).alias("Service_Time__c"),
        (dom * F.lit(10.0)).alias("BudgetedCost"),
        F.when(dom % 5 == 0, F.lit(None).cast("double")).otherwise(dom * F.lit(7.5)).alias("ActualCost"),
        F.when(F.col("_am"), F.lit(100.0)).otherwise(F.lit(250.0)).alias("ExpectedRevenue"),
    ).distinct()


def campaign_member(events: DataFrame, documents: DataFrame) -> DataFrame:
    """One member row per ``events`` row; contact = user, name = that of the
    document with the user's number, in four variants; some share a name."""
    u, eid = F.col("user_id"), F.col("event_id")
    e = _slot(events)
    names = doc_names(documents)
    namesake = e.user_id - F.when(e.user_id % 16 == 12, 4).otherwise(0)
    e = e.join(names, namesake == names.doc_id, "left")
    first = F.when(u % 4 == 1, F.concat(F.substring(F.trim("first"), 1, 3), F.lit("."))).otherwise(F.col("first"))
    last = (
        F.when(u % 4 == 2, F.concat(F.col("last"), F.lit("e")))
        .when(u % 4 == 3, F.reverse(F.col("last")))
        .otherwise(F.col("last"))
    )
    email = (
        F.when(u % 7 == 0, F.lit(None).cast("string"))
        .when(u % 11 == 10, F.concat(F.lit("User"), _str(u - 1), F.lit("@Example.org")))
        .otherwise(F.concat(F.lit("\u2003User"), _str(u), F.lit("@Example.org\u00a0")))
    )
    return e.select(
        F.col("_slot").alias("CampaignId"),
        F.concat(F.lit("C"), _str(u)).alias("ContactId"),
        first.alias("FirstName"),
        last.alias("LastName"),
        _pick(u % 3, ("Mr.", "Ms.", None)).alias("Salutation"),
        F.when(u % 9 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("555-"), F.lpad(_str(u % 10000), 4, "0"))).alias("Phone"),
        F.when(u % 2 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("555-7"), F.lpad(_str(u % 1000), 3, "0"))).alias("MobilePhone"),
        email.alias("Email"),
        F.lit(None).cast("string").alias("Fax"),
        F.lit("US").alias("Country"),
        _pick(u % 4, STATES).alias("State"),
        F.concat(F.lit("Springfield "), _str(u % 10)).alias("City"),
        F.concat(_str(u), F.lit(" Main St")).alias("Street"),
        F.lpad(_str(u % 100000), 5, "0").alias("PostalCode"),
        F.when(u % 3 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Household "), _str(F.floor(u / 3)))).alias("CompanyOrAccount"),
        _pick(u % 6, ROLES_BY_USER).alias("Participant_Type__c"),
        (u % 4 == 0).alias("HasOptedOutOfEmail"),
        _pick(eid % 6, STATUS_BY_EVENT).alias("Status"),
        (eid % 5 != 0).alias("Attendance_Indicator__c"),
    )


def _null_if(cond: Column, value: Column) -> Column:
    return F.when(~cond, value)


def ticket_event(benchmark: DataFrame) -> DataFrame:
    """One ticketing event per benchmark item; a few ids repeat the one before
    and a few required values are missing (rows the declared tests must find)."""
    i = F.col("item_id")
    start = _ntz(EVENT_EPOCH) + F.make_dt_interval(hours=(i * 22).cast("int"))
    m = i % PATTERN
    return benchmark.select(
        _null_if(m == 31, F.when(m == 17, i - 1).otherwise(i)).alias("id"),
        _null_if(m == 22, _pick(i % 5, TICKET_EVENT_NAMES)).alias("name_text"),
        F.concat(F.lit("Benchmark item "), _str(i)).alias("description_text"),
        F.when(i % 4 == 0, F.lit(True)).when(i % 4 == 2, F.lit(None).cast("boolean"))
        .otherwise(F.lit(False)).alias("online_event"),
        _null_if(m == 9, start).alias("start_local"),
        (start + F.make_dt_interval(hours=F.lit(2))).alias("end_local"),
        (i % 3).alias("venue_id"),
        (i + 100).alias("capacity"),
        F.when(m == 13, F.lit("draft")).when(m == 27, F.lit(None).cast("string"))
        .otherwise(F.lit("live")).alias("status"),
        (i % 2 == 0).alias("is_free"),
        (m == 7).alias("_fivetran_deleted"),
        _ntz(SYNC_TIME).alias("_fivetran_synced"),
    )


def item_count(benchmark: DataFrame) -> Column:
    """The number of ticketing events, as a scalar subquery."""
    return benchmark.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("n")).scalar()


def ticket_attendee(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Three registrations per document (two of them for the same event),
    spread over all ticketing events."""
    d = doc_names(documents).withColumn("k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    doc, k = F.col("doc_id"), F.col("k")
    aid = doc * 10 + k
    email = (
        F.when(doc % 60 == 15, F.lit("Info Requested"))
        .when(doc % 90 == 21, F.lit(None).cast("string"))
        .when(doc % 6 == 1, F.concat(F.lit("\u3000USER"), _str(F.floor(doc / 6)), F.lit("@example.org")))
        .otherwise(F.concat(F.lit("Guest"), _str(doc), F.lit("@example.net")))
    )
    return d.select(
        # some ids are missing, some repeat that of another registration
        _null_if((doc % 101 == 7) & (k == 0), F.when((doc % 97 == 5) & (k == 1), aid - 1).otherwise(aid)).alias("id"),
        ((F.floor(doc / 2) + F.when(k == 2, F.lit(0)).otherwise(k)) % item_count(benchmark)).alias("event_id"),
        doc.alias("order_id"),
        F.col("first").alias("profile_first_name"),
        F.col("last").alias("profile_last_name"),
        email.alias("profile_email"),
        F.concat(F.lit("("), F.lpad(_str(doc % 1000), 3, "0"), F.lit(") 555-"),
                 F.lpad(_str(doc % 10000), 4, "0")).alias("profile_cell_phone"),
        (aid % 3 == 0).alias("checked_in"),
        F.when(aid % 3 == 0, F.lit("Checked In")).otherwise(F.lit("Attending")).alias("status"),
        (_ntz(REGISTRATION_EPOCH) + F.make_dt_interval(mins=doc.cast("int"))).alias("created"),
        (aid % 17 == 0).alias("cancelled"),
        (aid % 19 == 0).alias("refunded"),
        (aid % 29 == 0).alias("_fivetran_deleted"),
        _ntz(SYNC_TIME).alias("_fivetran_synced"),
    )


def ticket_order(orders: DataFrame, customer: DataFrame, benchmark: DataFrame) -> DataFrame:
    o = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
    k = F.col("o_orderkey")
    return o.select(
        _null_if(k % 331 == 3, F.when(k % 211 == 4, k - 1).otherwise(k)).alias("id"),
        (k % item_count(benchmark)).alias("event_id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("owner_first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("owner_last_name"),
        _null_if(k % 173 == 2, F.concat(F.lit(" "), F.col("c_name"), F.lit("@Example.com"))).alias("owner_email"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("gross_major_value"),
        F.lit("USD").alias("gross_currency"),
        F.col("o_orderdate").alias("created"),
        (k % 23 == 0).alias("_fivetran_deleted"),
        _ntz(SYNC_TIME).alias("_fivetran_synced"),
    )


def derive_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The five raw registries derived (lazily) from the driver tables."""
    events = read_driver(spark, sf_dir, "events")
    documents = read_driver(spark, sf_dir, "documents")
    benchmark = read_driver(spark, sf_dir, "benchmark")
    return Sources(
        campaign=campaign(events),
        campaign_member=campaign_member(events, documents),
        ticket_event=ticket_event(benchmark),
        ticket_attendee=ticket_attendee(documents, benchmark),
        ticket_order=ticket_order(
            read_driver(spark, sf_dir, "orders"), read_driver(spark, sf_dir, "customer"), benchmark
        ),
    )


def fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Key of a derivation: the input files (path, size, time) as the cluster's
    file system lists them."""
    h = hashlib.sha256()
    for name in sorted(DRIVER_SCHEMAS):
        for path, size, time in sorted(files_under(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")):
            h.update(f"{path}:{size}:{time}\n".encode())
    return h.hexdigest()[:20]


class WrittenSources:
    """The registries of ``derived``, each written below ``base`` and read back
    with its contract when it is first asked for: a query pays for the
    registries that it reads."""

    def __init__(self, spark: SparkSession, derived: Sources, base: str):
        self._spark, self._derived, self._base = spark, derived, base

    def __getattr__(self, name: str) -> DataFrame:
        if name not in CONTRACTS:
            raise AttributeError(name)
        path = f"{self._base}/{name}"
        getattr(self._derived, name).write.mode("overwrite").parquet(path)  # what a failed write left
        table = read_table(self._spark, path, name)
        setattr(self, name, table)
        return table


_DERIVED: dict[tuple, WrittenSources] = {}


def fixture_sources(spark: SparkSession, sf_dir: str) -> WrittenSources:
    """The five raw registries, written once per application and input as
    Parquet tables in a folder of their own below the shared checkpoint folder,
    and read back with the registry contracts, as production reads its raw
    tables."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), fingerprint(spark, sf_dir))
    if key not in _DERIVED:
        base = f"{checkpoint_root(spark)}/flocklens-fixture-{uuid.uuid4().hex}"
        _DERIVED[key] = WrittenSources(spark, derive_sources(spark, sf_dir), base)
    return _DERIVED[key]
