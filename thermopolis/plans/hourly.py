"""Raw zone to trusted zone, run after run: only new fetches are read, only changed years are published.

Run as ``python -m thermopolis.plans.hourly`` or hand this file to ``spark-submit`` with the package in
``--py-files``. The result is that of a full ``etl`` over the same raw zone, row for row.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermopolis.operators.integrate import city_info, trusted
from thermopolis.session import build_session
from thermopolis.sources import daystate, raw, sinks, versions, zones


def run(
    spark: SparkSession,
    readings: str,
    dimensions: str,
    output: str,
    state: str,
    fmt: str = "parquet",
    dedupe: str = "none",
) -> dict[str, int]:
    """Bring the trusted zone up to date; how many fetch days, days and years were computed, and the rows
    written.

    ``state`` is a folder of the runs' own, see ``sources.daystate``. Fetch days whose files have changed
    are read; the days they touch are merged with the parts of other fetch days; the years of
    cities whose daily rows have changed are replaced. New relational snapshots replace all years, from
    the stored days. The trusted zone is published before the state, so a run that dies in between is
    repeated in full. A state kept for another ``dedupe`` is built anew.
    """
    with versions.commit(spark, state) as draft:
        if draft.notes.get("dedupe") != dedupe:
            draft.tables, draft.notes = {}, {"dedupe": dedupe}
        snapshot = daystate.folder_fingerprint(spark, dimensions)
        whole = draft.notes.get("dimensions") != snapshot
        before = dict(draft.tables.get(daystate.DAYS, {}))
        found = daystate.changes(spark, readings, draft.notes.get("fetches", {}))
        days = daystate.advance(spark, state, draft, readings, found, dedupe)
        counts = {"fetch_days": len(found.new) + len(found.gone), "days": len(days), "years": 0, "rows": 0}
        if whole or days:
            info = city_info(**raw.read_dimensions(spark, dimensions))
            rows = daystate.read(spark, state, draft.tables, daystate.DAYS, daystate.DAILY)
            if whole:
                counts["rows"] = sinks.write_trusted(trusted(rows, info), output, fmt, static=True)
                counts["years"] = len(versions.latest(spark, output).tables[sinks.TRUSTED])
            else:
                old = daystate.read(spark, state, {daystate.DAYS: before}, daystate.DAYS, daystate.DAILY, days)
                new = daystate.read(spark, state, draft.tables, daystate.DAYS, daystate.DAILY, days)
                years = changed_years(old, new, info)
                counts["years"] = len(years)
                if years:
                    counts["rows"] = sinks.write_trusted(trusted(rows, info.where(_in(years))), output, fmt, years=years)
        draft.notes["dimensions"] = snapshot
    return counts


def changed_years(old: DataFrame, new: DataFrame, info: DataFrame) -> list[int | None]:
    """Consumption years of the cities with a daily row that is new, gone or different."""
    same = old.exceptAll(new).unionAll(new.exceptAll(old)).select("name").distinct()
    return [r["year"] for r in info.join(same, "name", "left_semi").select("year").distinct().collect()]


def _in(years: list[int | None]):
    known = [y for y in years if y is not None]
    wanted = F.col("year").isin(known) if known else F.lit(False)
    return wanted | F.col("year").isNull() if None in years else wanted


def audit(spark: SparkSession, dimensions: str, output: str, state: str, fmt: str = "parquet") -> dict[str, int]:
    """Rows of each stage, readings out of the notes of the runs that have read them."""
    version = versions.latest(spark, state)
    days = daystate.read(spark, state, version.tables, daystate.DAYS, daystate.DAILY)
    return {
        "readings": sum(entry["rows"] for entry in version.notes["fetches"].values()),
        "daily": days.count(),
        "city_info": city_info(**raw.read_dimensions(spark, dimensions)).count(),
        "final": zones.read_trusted(spark, output, fmt=fmt).count(),
    }


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--readings", required=True, help="raw zone written by the ingest job")
    parser.add_argument("--dimensions", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--state", required=True, help="folder for what the runs keep between them")
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    parser.add_argument("--dedupe", default="none", choices=["none", "latest"])
    parser.add_argument("--table", help="move this catalog name to the new version")
    parser.add_argument("--audit", action="store_true", help="print rows per stage")
    parser.add_argument("--input-bytes", type=int, help="size of the new fetches, to choose shuffle partitions")
    args = parser.parse_args()
    spark = build_session("thermopolis-hourly", input_bytes=args.input_bytes)
    print(run(spark, args.readings, args.dimensions, args.output, args.state, args.format, args.dedupe))
    if args.table:
        zones.register_trusted(spark, args.table, args.output, args.format)
    if args.audit:
        print(audit(spark, args.dimensions, args.output, args.state, args.format))
    spark.stop()


if __name__ == "__main__":
    main()
