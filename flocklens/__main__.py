"""Batch job: rebuild every published model from the raw registry tables.

    spark-submit --py-files flocklens.zip -m flocklens \\
        --sources s3://bucket/raw --out s3://bucket/warehouse [--as-of 2024-01-31]

``--sources`` holds one Parquet table per registry (campaign, campaign_member,
ticket_event, ticket_attendee, ticket_order). Without ``--as-of`` the
production default (today at fixed UTC-5) is used. Session configuration is
left to spark-submit (see README, "Running at 100 TB").
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from flocklens.config import Settings
from flocklens.plans.build import Build
from flocklens.plans.sinks import publish
from flocklens.sources.raw import read_sources


def main(argv=None) -> dict:
    ap = argparse.ArgumentParser(prog="flocklens")
    ap.add_argument("--sources", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--as-of", default=None)
    ap.add_argument("--risk-period-days", type=int, default=30)
    ap.add_argument("--bucket-period-days", type=int, default=30)
    ap.add_argument("--models", nargs="*", default=None)
    a = ap.parse_args(argv)
    as_of = dt.date.fromisoformat(a.as_of) if a.as_of else Settings.today_est()
    settings = Settings(as_of=as_of, risk_period_days=a.risk_period_days, bucket_period_days=a.bucket_period_days)
    spark = SparkSession.builder.appName("flocklens").getOrCreate()
    build = Build(spark, read_sources(spark, a.sources), settings)
    try:
        return publish(build, a.out, models=set(a.models) if a.models else None)
    finally:
        build.close()


if __name__ == "__main__":
    print(main())
