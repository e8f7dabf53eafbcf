"""Writers of the raw, trusted and refined zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from thermopolis import schemas
from thermopolis.sources import versions
from thermopolis.sources.versions import Files

#: The zone's only table in its versions, and the folder name of rows without a year.
TRUSTED = "trusted"
UNKNOWN_YEAR = "__HIVE_DEFAULT_PARTITION__"


class EmptyOutputError(ValueError):
    """A result without rows must not replace an earlier one."""


def append_readings(readings: DataFrame, path: str) -> None:
    """Add stamped readings to the raw zone, one folder per fetch day, in files of even size.

    A reading is known by city, fetch and time. Of copies in the batch the greatest is kept; what the
    zone has already is left out, so a job that runs again adds what is missing and nothing twice. Only
    the batch's fetch days are looked at: the work does not grow with the zone's history.
    """
    rows = schemas.require_columns(readings, schemas.STAMPED_READINGS, "readings")
    rows = rows.select(*schemas.STAMPED_READINGS.names, F.to_date("snapshot").alias("snapshot_date"))
    key = ["snapshot_date", "name", "snapshot", "time"]
    once = rows.groupBy(*key).agg(F.max("temperature_2m").alias("temperature_2m")).select(*rows.columns)
    new = _not_stored(once, _fetch_days(rows), path, key)
    new.hint("rebalance", "snapshot_date").write.mode("append").partitionBy("snapshot_date").parquet(path)


def append_quarantine(bad: DataFrame, path: str) -> None:
    """Add answers to look at by hand, unless the same text of the same fetch is there.

    A row is known by the SHA-256 of city, fetch and text, stored beside them, so texts are neither
    compared nor shuffled to find out; as above only the batch's fetch days are looked at.
    """
    fields = F.struct(*[F.col(c) for c in schemas.COLLECTED.names])
    rows = schemas.require_columns(bad, schemas.COLLECTED, "quarantine").select(
        *schemas.COLLECTED.names, F.sha2(F.to_json(fields), 256).alias("digest"), F.to_date("snapshot").alias("snapshot_date")
    )
    new = _not_stored(rows, _fetch_days(rows), path, ["snapshot_date", "digest"])
    once = new.groupBy("snapshot_date", "digest").agg(F.first(F.struct(*schemas.COLLECTED.names)).alias("row"))
    columns = [F.col(f"row.{c}").alias(c) for c in schemas.COLLECTED.names]
    once.select(*columns, "digest", "snapshot_date").write.mode("append").partitionBy("snapshot_date").parquet(path)


def _fetch_days(rows: DataFrame) -> list:
    """The batch's fetch days, a row for each day of the calendar at most."""
    return [r["snapshot_date"] for r in rows.select("snapshot_date").distinct().collect()]


def _not_stored(rows: DataFrame, days: list, path: str, key: list[str]) -> DataFrame:
    """Rows whose key, NULLs included, is not in the folder's partitions of ``days`` yet."""
    spark = rows.sparkSession
    if not Files(spark, path).exists():
        return rows
    stored = spark.read.schema(rows.schema).parquet(path)
    known = [d for d in days if d is not None]
    same_days = F.col("snapshot_date").isin(known) if known else F.lit(False)
    if len(known) < len(days):
        same_days = same_days | F.col("snapshot_date").isNull()
    stored = stored.where(same_days).select(*[F.col(c).alias(f"stored_{c}") for c in key])
    same = [F.col(c).eqNullSafe(F.col(f"stored_{c}")) for c in key]
    return rows.join(stored, same, "left_anti")


def write_dimensions(tables: dict[str, DataFrame], base: str) -> None:
    """Replace relational snapshots by headered CSVs, all of them at one moment or none."""
    with versions.commit(next(iter(tables.values())).sparkSession, base) as draft:
        for name, df in tables.items():
            df.write.option("header", True).csv(f"{base}/{draft.folder}/{name}.csv")
            draft.tables[name] = {versions.WHOLE: f"{draft.folder}/{name}.csv"}


def write_dimension(df: DataFrame, base: str, table: str) -> None:
    """Replace one relational snapshot."""
    write_dimensions({table: df}, base)


def write_trusted(
    trusted: DataFrame,
    path: str,
    fmt: str = "parquet",
    static: bool = False,
    rebalance: bool = True,
    years: list[int | None] | None = None,
) -> int:
    """Replace trusted partitions at one moment and return the rows written; no rows is an error.

    Only the years present in ``trusted`` are replaced, and ``years``, which go if they have no rows
    any more; ``static`` replaces all. Rows are written beside those in use and counted on the way, so
    a run that fails or finds nothing leaves the zone as it was. ``rebalance`` brings the rows of a
    year together into files of even size and splits a year that is too large for one task.
    """
    rows = schemas.require_columns(trusted, schemas.TRUSTED, "trusted").select(*schemas.TRUSTED.names)
    if rebalance:
        rows = rows.hint("rebalance", "year")
    written = Observation("trusted")
    spark = trusted.sparkSession
    with versions.commit(spark, path) as draft:
        (
            rows.observe(written, F.count("*").alias("n_rows"))
            .write.option("header", True)
            .partitionBy("year")
            .format(fmt)
            .save(f"{path}/{draft.folder}")
        )
        # Counted by finished tasks of the last stage, each once however often it was started.
        n_rows = written.get["n_rows"]
        if n_rows == 0:
            raise EmptyOutputError("no rows for the trusted zone")
        if draft.number == 0:
            draft.tables[TRUSTED] = dict.fromkeys(versions.partitions(spark, path, ""), "")
        old = {} if static else draft.tables.get(TRUSTED, {})
        gone = {f"year={UNKNOWN_YEAR if y is None else y}" for y in years or []}
        draft.tables[TRUSTED] = {p: f for p, f in old.items() if p not in gone} | dict.fromkeys(
            versions.partitions(spark, path, draft.folder), draft.folder
        )
    return n_rows


def write_marts(marts: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """Replace refined marts under ``path``, all of them at one moment or none."""
    rows = {n: schemas.require_columns(df, schemas.MARTS[n], n).select(*schemas.MARTS[n].names) for n, df in marts.items()}
    with versions.commit(next(iter(marts.values())).sparkSession, path) as draft:
        for name, df in rows.items():
            df.write.option("header", True).format(fmt).save(f"{path}/{draft.folder}/{name}")
            draft.tables[name] = {versions.WHOLE: f"{draft.folder}/{name}"}


def write_mart(mart: DataFrame, path: str, name: str, fmt: str = "parquet") -> None:
    """Replace one refined mart under ``path``."""
    write_marts({name: mart}, path, fmt)
