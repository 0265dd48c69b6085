"""Sinks: the published models as lasting tables that switch together, plus views.

``publish`` is the batch equivalent of one warehouse run. Every model is fully
rebuilt into a folder of the run's own; then one small manifest, renamed into
place under the next number, makes the whole set current. Until that rename
readers have the old set, whole; a run that dies half-way changes nothing, and
of two runs at once the second one's rename fails. ``published`` reads the
current manifest.

A ``view`` model is a catalog view over the published tables, evaluated at
read: it holds no rows, and shows changed input after the next publish.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession

from flocklens.config import IN_PERSON, ONLINE, TICKET_ID_PREFIX
from flocklens.functions.text import UNICODE_WHITESPACE
from flocklens.operators import quality
from flocklens.plans.build import Build
from flocklens.plans.materialize import _file_system, delete

# model name -> (Build attribute, partition columns)
TABLES = {
    "event_detail": ("event_detail", ()),
    "stg_ticket_events": ("stg_events", ()),
    "stg_ticket_attendees": ("stg_attendees", ()),
    "stg_ticket_orders": ("stg_orders", ()),
    "dim_events": ("dim_events", ()),
    "dim_dates": ("dim_dates", ()),
    "dim_members": ("dim_members", ()),
    "fact_attendance": ("fact_attendance", ("time_bucket",)),
}


def _email_key(column: str) -> str:
    return f"lower(trim(BOTH '{UNICODE_WHITESPACE}' FROM {column}))"


# model name -> (tables that it reads, SQL over them; ``{name}`` is a table's relation)
VIEWS = {
    "ticket_attendance": (
        ("stg_ticket_attendees", "stg_ticket_events", "event_detail"),
        f"""
        WITH registered AS (
            SELECT *, {_email_key('email')} AS email_key FROM {{stg_ticket_attendees}}),
        once AS (
            SELECT * FROM (
                SELECT *, row_number() OVER (PARTITION BY eventbrite_event_id, email_key
                    ORDER BY checked_in DESC NULLS LAST, eventbrite_attendee_id ASC NULLS FIRST) AS nth FROM registered)
            WHERE nth = 1),
        known AS (
            SELECT email_key, max(struct(event_date, contact_id, n)).contact_id AS contact_id
            FROM (SELECT {_email_key('email')} AS email_key, event_date, contact_id, count(*) AS n
                  FROM {{event_detail}} WHERE email IS NOT NULL GROUP BY 1, 2, 3)
            GROUP BY email_key)
        SELECT a.eventbrite_event_id AS event_id, e.event_name, e.type, e.event_format, e.event_date, e.event_time,
               coalesce(k.contact_id, concat('{TICKET_ID_PREFIX}', a.eventbrite_attendee_id)) AS contact_id,
               a.first_name, a.last_name, a.email_key AS email, a.phone_raw AS phone, a.checked_in AS attendance_indicator,
               if(e.event_format <=> '{ONLINE}', '{ONLINE}', '{IN_PERSON}') AS attendance_type
        FROM once a JOIN {{stg_ticket_events}} e ON e.eventbrite_event_id = a.eventbrite_event_id
             LEFT JOIN known k ON k.email_key = a.email_key""",
    ),
}
PUBLISHED = (*TABLES, *VIEWS)


def write_table(df: DataFrame, path: str, partition_by=(), fmt: str = "parquet") -> None:
    """A table at a path of its own."""
    w = df.write.mode("errorifexists").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def _manifests(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the manifests under ``root``, ascending."""
    folder, fs = _file_system(spark, f"{root}/_manifests")
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n[: -len(".json")]) for n in names if n.endswith(".json") and n[0].isdigit())


def _read(spark: SparkSession, root: str, number: int) -> dict[str, str]:
    rows = spark.read.text(f"{root}/_manifests/{number:09d}.json", wholetext=True).collect()  # one small file
    return json.loads(rows[0][0])


def published(spark: SparkSession, root: str) -> dict[str, str]:
    """{table: path} of the current set; empty before the first publish."""
    root = root.rstrip("/")
    numbers = _manifests(spark, root)
    return _read(spark, root, numbers[-1]) if numbers else {}


def _switch(spark: SparkSession, root: str, number: int, tables: dict[str, str]) -> None:
    """Makes ``tables`` the current set: a rename to a name that must be free."""
    draft, fs = _file_system(spark, f"{root}/_manifests/_draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(tables, sort_keys=True).encode()))
    finally:
        out.close()
    final, _ = _file_system(spark, f"{root}/_manifests/{number:09d}.json")
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"another run has published {final} meanwhile; nothing was switched")


def _as_views(spark: SparkSession, tables: dict[str, str], names, database: str | None) -> None:
    """Catalog views: one over each table's current folder, then the view models."""
    at = lambda name: f"`{database}`.`{name}`" if database else f"`{name}`"
    for name in names:
        if name in TABLES:
            spark.sql(f"CREATE OR REPLACE VIEW {at(name)} AS SELECT * FROM parquet.`{tables[name]}`")
    for name in names:
        if name in VIEWS:
            reads, sql = VIEWS[name]
            spark.sql(f"CREATE OR REPLACE VIEW {at(name)} AS {sql.format(**{t: at(t) for t in reads})}")


def _write_tested(df: DataFrame, name: str, path: str, partition_by) -> dict:
    """Write a table; {(relation, column, test): failures} of its declared tests.

    The NULL counts are metrics of the write itself, so they cost no further scan;
    uniqueness reads the key column of what was written."""
    declared = [(key, cols) for relation, key, cols in quality.TESTS if relation == name]
    if not declared:
        write_table(df, path, partition_by)
        return {}
    (key, cols), seen = declared[0], Observation()
    write_table(df.observe(seen, *quality.null_counts(cols)), path, partition_by)
    found = {(name, c, "not_null"): seen.get[c] for c in cols}
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    return found | {(name, key, "unique"): quality.duplicated_keys(written, key)}


def publish(build: Build, root: str, models=None, database: str | None = None) -> dict:
    """``publish_tested`` without the test counts: ``{table: path}``."""
    return publish_tested(build, root, models, database)[0]


def publish_tested(build: Build, root: str, models=None, database: str | None = None) -> tuple[dict, dict]:
    """Write the models and switch to them; returns ``{table: path}`` of what is
    current then, and the failures of the declared tests of the tables written. ``models`` rebuilds only those (a view's tables with it) and
    keeps the rest of the current set. An unknown model name is an error. The
    catalog views (in ``database``, or the current one) follow the switch."""
    wanted = set(PUBLISHED if models is None else models)
    if unknown := sorted(wanted - set(PUBLISHED)):
        raise ValueError(f"unknown models: {', '.join(unknown)}")
    wanted |= {t for name in wanted & set(VIEWS) for t in VIEWS[name][0]}
    spark, root = build.spark, root.rstrip("/")
    numbers = _manifests(spark, root)
    tables = _read(spark, root, numbers[-1]) if numbers else {}
    folder, failures = f"{root}/_versions/{uuid.uuid4().hex}", {}
    try:
        for name, (attr, parts) in TABLES.items():
            if name in wanted:
                failures |= _write_tested(getattr(build, attr), name, f"{folder}/{name}", parts)
                tables[name] = f"{folder}/{name}"
        _switch(spark, root, numbers[-1] + 1 if numbers else 1, tables)
    except BaseException:
        delete(spark, folder)
        raise
    _as_views(spark, tables, [n for n in PUBLISHED if n in wanted], database)
    return tables, failures


def expire(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove the folders that none of the last ``keep`` sets holds, and older
    manifests. Readers of an older set lose it, so keep as many as may be in use;
    not while a publish is running."""
    root = root.rstrip("/")
    numbers = _manifests(spark, root)
    used = {path.split("/_versions/")[1].split("/")[0] for n in numbers[-keep:] for path in _read(spark, root, n).values()}
    versions, fs = _file_system(spark, f"{root}/_versions")
    for f in fs.listStatus(versions) if fs.exists(versions) else ():
        if f.getPath().getName() not in used:
            fs.delete(f.getPath(), True)
    for n in numbers[:-keep]:
        delete(spark, f"{root}/_manifests/{n:09d}.json")
