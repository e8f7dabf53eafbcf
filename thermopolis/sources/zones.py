"""Readers of the trusted and refined zones, and the catalog table over trusted."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from thermopolis import schemas
from thermopolis.sources import versions
from thermopolis.sources.sinks import TRUSTED, UNKNOWN_YEAR


def _read(spark: SparkSession, path: str, schema: StructType, fmt: str) -> DataFrame:
    """The trusted partitions in use, each from the folder of the run that wrote it."""

    def reader():
        reader = spark.read.schema(schema).format(fmt)
        return reader.option("header", True) if fmt == "csv" else reader

    found = versions.places(spark, path, TRUSTED)
    if found is None:
        return reader().load(path)
    parts = [reader().option("basePath", folder).load([f"{folder}/{p}" for p in names]) for folder, names in found.items()]
    return reduce(DataFrame.unionAll, parts)


def read_trusted(
    spark: SparkSession, path: str, year: int | None = None, fmt: str = "parquet"
) -> DataFrame:
    """The trusted table, or one year of it. ``year`` prunes partitions and stays a column."""
    trusted = _read(spark, path, schemas.TRUSTED, fmt)
    return trusted if year is None else trusted.where(F.col("year") == F.lit(year))


def read_trusted_text(spark: SparkSession, path: str) -> DataFrame:
    """A trusted CSV copy with every column as text, for ``metrics.typed_trusted``."""
    text = StructType([StructField(name, StringType(), True) for name in schemas.TRUSTED.names])
    return _read(spark, path, text, "csv")


def read_mart(spark: SparkSession, path: str, mart: str, fmt: str = "parquet") -> DataFrame:
    """Every part file of a refined mart, the one in use of the zone that ``path`` lies in.

    A CSV header is read, not assumed: columns may be missing or renamed in older copies.
    """
    schema = schemas.MARTS[mart]
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    zone, _, name = path.rstrip("/").rpartition("/")
    for place in versions.places(spark, zone, name) or ():
        path = place
    found = rename_legacy(reader.format(fmt).load(path))
    return schemas.require_columns(found, schema, mart).select(
        *[F.col(field.name).try_cast(field.dataType).alias(field.name) for field in schema]
    )


def rename_legacy(mart: DataFrame) -> DataFrame:
    """Older copies of the ranking call the metric ``avg_kwh_pe``."""
    if "avg_kwh_per_person" not in mart.columns and "avg_kwh_pe" in mart.columns:
        return mart.withColumnRenamed("avg_kwh_pe", "avg_kwh_per_person")
    return mart


def register_trusted(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog name for the trusted zone as it is published now.

    Each version gets an external table of its own, with all its partitions, before the name, a view
    over one of them, is moved to it by a single change of the catalog. So a reader in any session
    finds the old rows or the new ones, never a table without partitions. External tables of
    versions that are no longer kept are dropped, their files are the zone's own business.
    """
    version = versions.latest(spark, path)
    number = 0 if version is None else version.number
    found = versions.places(spark, path, TRUSTED) or {path: versions.partitions(spark, path, "")}
    columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schemas.TRUSTED)
    header = "OPTIONS (header 'true')" if fmt == "csv" else ""
    stored = f"{table}__{number:012d}"
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:table)", args={"table": stored})
    spark.sql(
        f"CREATE TABLE IDENTIFIER(:table) ({columns}) USING {fmt} {header} PARTITIONED BY (year) LOCATION {_quoted(path)}",
        args={"table": stored},
    )
    for folder, parts in found.items():
        for at in range(0, len(parts), 100):
            added = " ".join(f"PARTITION ({_partition(p)}) LOCATION {_quoted(f'{folder}/{p}')}" for p in parts[at : at + 100])
            spark.sql(f"ALTER TABLE IDENTIFIER(:table) ADD {added}", args={"table": stored})
    *_, name = table.split(".")
    is_there = spark.catalog.tableExists(table)
    if is_there and spark.catalog.getTable(table).tableType != "VIEW":
        spark.sql("DROP TABLE IDENTIFIER(:table)", args={"table": table})
        is_there = False
    # CREATE OR REPLACE would drop the view first, ALTER changes it in place.
    spark.sql(f"{'ALTER' if is_there else 'CREATE'} VIEW {_named(table)} AS SELECT * FROM {_named(stored)}")
    database = table.removesuffix(name).rstrip(".") or spark.catalog.currentDatabase()
    older = sorted(t.name for t in spark.catalog.listTables(database, f"{name}__*") if t.name.removeprefix(f"{name}__").isdigit())
    for old in older[: -versions.KEPT]:
        spark.sql(f"DROP TABLE IF EXISTS {_named(f'{database}.{old}')}")
    return spark.table(table)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _named(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))


def _partition(folder: str) -> str:
    """The year of a partition folder as the catalog is told it."""
    value = folder.removeprefix("year=")
    return "year = NULL" if value == UNKNOWN_YEAR else f"year = {int(value)}"
