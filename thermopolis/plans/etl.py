"""Raw zone to trusted zone.

Run as ``python -m thermopolis.plans.etl`` or hand this file to ``spark-submit`` with the package in
``--py-files``. A failed run leaves the process with an error, and the earlier trusted rows in place.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermopolis.operators.daily import merge_days, partial_days
from thermopolis.operators.integrate import city_info, trusted
from thermopolis.session import build_session, clean, materialize
from thermopolis.sources import raw, sinks, zones


def read_inputs(
    spark: SparkSession, readings: str, dimensions: str, stamped: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Readings with their fetch instant, and the integrated city rows."""
    tables = raw.read_dimensions(spark, dimensions)
    if stamped:
        hours = raw.read_stamped_readings(spark, readings)
    else:
        hours = raw.read_readings(spark, readings, with_snapshot=True)
    return hours, city_info(**tables)


def run(
    spark: SparkSession,
    readings: str,
    dimensions: str,
    output: str,
    fmt: str = "parquet",
    dedupe: str = "none",
    static: bool = True,
    stamped: bool = False,
) -> int:
    """Write the trusted zone and return its rows.

    The job computes all years from all readings, so it replaces the whole zone: a city whose year
    was unknown in an earlier run does not stay behind in the folder of the unknown year. With
    ``static`` off only the years present are replaced.
    """
    hours, info = read_inputs(spark, readings, dimensions, stamped)
    days = merge_days(partial_days(hours, dedupe), dedupe)
    return sinks.write_trusted(trusted(days, info), output, fmt, static)


def run_audited(
    spark: SparkSession,
    readings: str,
    dimensions: str,
    output: str,
    fmt: str = "parquet",
    dedupe: str = "none",
    static: bool = True,
    stamped: bool = False,
) -> dict[str, int]:
    """``run`` that returns the rows of each stage: readings, daily, city_info and final.

    The readings are scanned once. Their partial days, which carry the counts, are written between the two
    halves of the job and read by both the second half and the count. So a stage that is run again
    after a lost executor changes no count: they are sums over finished files.
    """
    hours, info = read_inputs(spark, readings, dimensions, stamped)
    parts = materialize(partial_days(hours, dedupe))
    final = sinks.write_trusted(trusted(merge_days(parts, dedupe), info), output, fmt, static)
    return {
        "readings": parts.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0],
        "daily": parts.select("name", "day").distinct().count(),
        "city_info": info.count(),
        "final": final,
    }


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--readings", required=True)
    parser.add_argument("--dimensions", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    parser.add_argument("--dedupe", default="none", choices=["none", "latest"])
    parser.add_argument("--keep-other-years", action="store_true", help="replace only the years present")
    parser.add_argument("--table", help="register the zone as this catalog table")
    parser.add_argument("--stamped", action="store_true", help="readings written by the ingest job")
    parser.add_argument("--audit", action="store_true", help="print rows per stage")
    parser.add_argument("--input-bytes", type=int, help="raw size, to choose shuffle partitions")
    args = parser.parse_args()
    spark = build_session("thermopolis-etl", input_bytes=args.input_bytes)
    job = run_audited if args.audit else run
    done = job(
        spark,
        args.readings,
        args.dimensions,
        args.output,
        args.format,
        args.dedupe,
        not args.keep_other_years,
        args.stamped,
    )
    if args.table:
        zones.register_trusted(spark, args.table, args.output, args.format)
    if args.audit:
        for stage, rows in done.items():
            print(f"{stage}: {rows}")
        clean(spark)
    else:
        print(f"{done} trusted rows in {args.output}")
    spark.stop()


if __name__ == "__main__":
    main()
