"""Declared column tests of the ticketing staging models, as Spark jobs.

A test returns its failing rows (zero rows = pass); ``dq_summary`` counts the
failures of all ten tests with one aggregation pass per relation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flocklens.config import TICKET_ID_PREFIX

# (relation, key column, not-null columns) of the declared tests
TESTS = (
    ("stg_ticket_events", "eventbrite_event_id", ("eventbrite_event_id", "event_name", "event_date")),
    ("stg_ticket_attendees", "eventbrite_attendee_id", ("eventbrite_attendee_id", "email")),
    ("stg_ticket_orders", "eventbrite_order_id", ("eventbrite_order_id", "email")),
)


def unique_violations(df: DataFrame, relation: str, column: str) -> DataFrame:
    """Non-NULL values of ``column`` that occur more than once."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
        .select(F.lit(relation).alias("relation"), F.lit(column).alias("column_name"), "value", "n_rows")
    )


def not_null_violations(df: DataFrame, relation: str, columns, key: str) -> DataFrame:
    """A row per NULL in one of ``columns``, identified by the relation's key;
    one pass over the relation."""
    failing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.select(
        F.lit(relation).alias("relation"),
        F.explode(failing).alias("column_name"),
        F.col(key).cast("string").alias("row_key"),
    )


def null_counts(columns) -> list[Column]:
    """The NULLs of each column, as aggregates that a write can observe."""
    return [F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in columns]


def duplicated_keys(df: DataFrame, key: str) -> int:
    """How many non-NULL values of ``key`` occur more than once."""
    per_key = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.filter(F.col("n") > 1).count()


def surrogate_clashes(contact_ids: DataFrame) -> DataFrame:
    """CRM contact ids that look like the surrogate id of a ticketing contact.
    The attendance fact relies on there being none."""
    return contact_ids.select("contact_id").filter(F.col("contact_id").startswith(TICKET_ID_PREFIX)).distinct()


def _relations(ev: DataFrame, att: DataFrame, orders: DataFrame):
    return dict(zip((t[0] for t in TESTS), (ev, att, orders)))


def dq_unique_violations(ev: DataFrame, att: DataFrame, orders: DataFrame) -> DataFrame:
    rel = _relations(ev, att, orders)
    out = None
    for name, key, _ in TESTS:
        v = unique_violations(rel[name], name, key)
        out = v if out is None else out.unionByName(v)
    return out


def dq_not_null_violations(ev: DataFrame, att: DataFrame, orders: DataFrame) -> DataFrame:
    rel = _relations(ev, att, orders)
    out = None
    for name, key, cols in TESTS:
        v = not_null_violations(rel[name], name, cols, key)
        out = v if out is None else out.unionByName(v)
    return out


def dq_summary(ev: DataFrame, att: DataFrame, orders: DataFrame) -> DataFrame:
    """(relation, column_name, test, failures) for all ten tests.

    Per relation: group by the key (map-side partial counts), then one global
    aggregate gives the duplicated-key count and every NULL count."""
    rel = _relations(ev, att, orders)
    out = None
    for name, key, cols in TESTS:
        others = [c for c in cols if c != key]
        per_key = rel[name].groupBy(key).agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(f"_null_{c}") for c in others],
        )
        k = F.col(key)
        agg = per_key.agg(
            F.count(F.when(k.isNotNull() & (F.col("_n") > 1), F.lit(1))).alias("u"),
            F.coalesce(F.sum(F.when(k.isNull(), F.col("_n"))), F.lit(0)).cast("long").alias("nn_key"),
            *[F.coalesce(F.sum(f"_null_{c}"), F.lit(0)).cast("long").alias(f"nn_{c}") for c in others],
        )
        rows = [(key, "unique", "u"), (key, "not_null", "nn_key")] + [(c, "not_null", f"nn_{c}") for c in others]
        stack = ", ".join(f"'{c}', '{t}', {a}" for c, t, a in rows)
        v = agg.selectExpr(
            f"'{name}' AS relation", f"stack({len(rows)}, {stack}) AS (column_name, test, failures)"
        )
        out = v if out is None else out.unionByName(v)
    return out
