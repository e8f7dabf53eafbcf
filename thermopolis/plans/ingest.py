"""Collected answers and relational tables into the raw zone.

Run as ``python -m thermopolis.plans.ingest`` or hand this file to ``spark-submit`` with the package in
``--py-files``.
"""

from __future__ import annotations

import argparse

import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from thermopolis.session import build_session, clean, materialize
from thermopolis.sources import raw, sinks


def ingest_payloads(spark: SparkSession, collected: str, readings: str, quarantine: str) -> None:
    """Good answers become stamped readings, the others go to quarantine with their whole text.

    Texts are parsed once: what they hold is stored typed, and both outputs read that.
    """
    parsed = raw.parse_payloads(raw.read_collected(spark, collected))
    parsed = materialize(parsed.withColumn("payload", F.when(~F.col("is_good"), F.col("payload"))))
    sinks.append_readings(raw.payload_readings(parsed), readings)
    sinks.append_quarantine(raw.quarantined(parsed), quarantine)


def ingest_tables(
    spark: SparkSession,
    url: str,
    dimensions: str,
    properties: dict[str, str] | None = None,
    partitions: int = 1,
) -> list[str]:
    tables = raw.snapshot_tables(lambda table: raw.jdbc_table(spark, url, table, properties, partitions))
    sinks.write_dimensions(tables, dimensions)
    return list(tables)


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--collected", required=True)
    parser.add_argument("--readings", required=True)
    parser.add_argument("--quarantine", required=True)
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-partitions", type=int, default=8)
    parser.add_argument("--jdbc-driver")
    parser.add_argument("--jdbc-user")
    parser.add_argument("--jdbc-password-variable", help="environment variable that holds the password")
    parser.add_argument("--dimensions")
    parser.add_argument("--input-bytes", type=int, help="size of the collected texts, to choose shuffle partitions")
    args = parser.parse_args()
    spark = build_session("thermopolis-ingest", input_bytes=args.input_bytes)
    ingest_payloads(spark, args.collected, args.readings, args.quarantine)
    if args.jdbc_url:
        password = os.environ[args.jdbc_password_variable] if args.jdbc_password_variable else None
        given = {"driver": args.jdbc_driver, "user": args.jdbc_user, "password": password}
        properties = {k: v for k, v in given.items() if v is not None}
        ingest_tables(spark, args.jdbc_url, args.dimensions, properties, args.jdbc_partitions)
    clean(spark)
    spark.stop()


if __name__ == "__main__":
    main()
