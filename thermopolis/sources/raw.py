"""Readers of the raw zone: hourly readings, relational snapshots, collected payloads."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from thermopolis import schemas
from thermopolis.functions.columns import PAYLOAD_TIME, snapshot_from_file_name
from thermopolis.sources import versions

CORRUPT = "_corrupt"

# The integer column of each relational table that a parallel read splits on.
PARTITION_KEYS = {
    "cities": "id",
    "regions": "id",
    "city_region": "city_id",
    "population": "city_id",
    "city_consumption": "id",
}


class MissingInputError(FileNotFoundError):
    """A required input table cannot be read."""


def read_readings(spark: SparkSession, path: str, with_snapshot: bool = False) -> DataFrame:
    """All CSV files of a folder; ``with_snapshot`` adds the fetch instant out of each file name."""
    readings = (
        spark.read.schema(schemas.READINGS)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    if with_snapshot:
        stamp = snapshot_from_file_name(F.col("_metadata.file_name"))
        readings = readings.withColumn("snapshot", stamp)
    return readings


def read_stamped_readings(spark: SparkSession, path: str) -> DataFrame:
    """The raw zone written by ``sinks.append_readings``."""
    return spark.read.schema(schemas.STAMPED_READINGS).parquet(path)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The answers written by ``sinks.append_quarantine``, each with its digest."""
    return spark.read.schema(schemas.QUARANTINED).parquet(path).select(*schemas.QUARANTINED.names)


def read_dimension(spark: SparkSession, base: str, table: str) -> DataFrame:
    """One relational snapshot, the one in use. A header that disagrees with the schema is an error."""
    places = versions.places(spark, base, table) or {f"{base}/{table}.csv": []}
    return (
        spark.read.schema(schemas.DIMENSIONS[table])
        .option("header", True)
        .option("enforceSchema", False)
        .csv(list(places))
    )


def read_dimensions(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """All five snapshots, or an error that names the first one that cannot be read.

    Looks at one row per table; a full count would read everything twice.
    """
    tables = {}
    for table in schemas.DIMENSIONS:
        try:
            tables[table] = read_dimension(spark, base, table)
            tables[table].limit(1).collect()
        except Exception as error:
            raise MissingInputError(f"cannot read {table}.csv under {base}: {error}") from error
    return tables


def dimension_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    union = counts[0]
    for more in counts[1:]:
        union = union.unionAll(more)
    return union


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """One database table, read as ``partitions`` ranges of its key side by side.

    The database itself is asked for the ends of the key, one row. Rows that appear outside them
    later, or have no key, still come with the first or the last range.
    """

    def reader():
        return spark.read.format("jdbc").option("url", url).options(**(properties or {}))

    whole = reader().option("dbtable", table)
    if partitions == 1:
        return whole.load()
    key = PARTITION_KEYS[table]
    ends = f"(SELECT min({key}) AS low, max({key}) AS high FROM {table}) ends"
    low, high = reader().option("dbtable", ends).load().first()
    if low is None:
        return whole.load()
    return whole.options(
        partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=partitions
    ).load()


def snapshot_tables(
    read_table: Callable[[str], DataFrame],
    tables: Iterable[str] = tuple(schemas.DIMENSIONS),
) -> dict[str, DataFrame]:
    """Each relational table as it is now, for ``sinks.write_dimensions``: executor to file, all published
    together."""
    found = {}
    for table in tables:
        found[table] = schemas.require_columns(read_table(table), schemas.DIMENSIONS[table], table)
    return {table: df.select(*schemas.DIMENSIONS[table].names) for table, df in found.items()}


def read_collected(spark: SparkSession, path: str) -> DataFrame:
    """Service answers as collected: city, fetch instant and the whole text, one JSON object a line.

    A line without an answer in it, broken or not, is its own payload, so that quarantine has its text.
    """
    lines = spark.read.text(path).withColumn("line", F.from_json("value", schemas.COLLECTED))
    return lines.select("line.name", "line.snapshot", F.coalesce("line.payload", "value").alias("payload"))


def parse_payloads(payloads: DataFrame) -> DataFrame:
    """Adds ``hourly`` and ``is_good`` to rows with a JSON ``payload``.

    A payload is good if it is whole JSON and has both arrays, every time in them can be read, and its
    city and fetch instant are known, where there are columns for them. Valid JSON without the arrays
    leaves the corrupt column NULL, and a cut text may still parse in part, so both are checked.
    """
    schema = StructType(schemas.PAYLOAD.fields + [StructField(CORRUPT, StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json("payload", schema, options)

    def whole(answer):
        return (
            answer[CORRUPT].isNull()
            & answer["hourly"]["time"].isNotNull()
            & answer["hourly"]["temperature_2m"].isNotNull()
            & F.forall(answer["hourly"]["time"], lambda t: F.try_to_timestamp(t, F.lit(PAYLOAD_TIME)).isNotNull())
        )

    known = reduce(and_, [F.col(c).isNotNull() for c in ("name", "snapshot") if c in payloads.columns], F.lit(True))

    # ``exists`` names the parsed answer once. Written as three conditions on the column, a filter on
    # ``is_good`` would be pushed below the projection and parse every text three times.
    return (
        payloads.withColumn("parsed", parsed)
        .withColumn("is_good", F.coalesce(F.exists(F.array("parsed"), whole), F.lit(False)) & known)
        .withColumn("hourly", F.col("parsed.hourly"))
        .drop("parsed")
    )


def explode_payloads(parsed: DataFrame) -> DataFrame:
    """One row per hour of each good payload. The longer array is cut to the shorter one.

    A bad payload is cut to no hours rather than filtered out, so that its text is parsed once.
    """
    n_times, n_temps = F.size("hourly.time"), F.size("hourly.temperature_2m")
    hours = F.when(F.col("is_good"), F.least(n_times, n_temps)).otherwise(0)
    kept = [c for c in parsed.columns if c not in ("payload", "hourly", "is_good")]
    return parsed.select(
        *kept,
        F.slice("hourly.time", F.lit(1), hours).alias("time"),
        F.slice("hourly.temperature_2m", F.lit(1), hours).alias("temperature_2m"),
    ).select(*kept, F.inline(F.arrays_zip("time", "temperature_2m")))


def payload_readings(parsed: DataFrame) -> DataFrame:
    """Exploded payloads as stamped readings."""
    return explode_payloads(parsed).select(
        F.try_to_timestamp("time", F.lit(PAYLOAD_TIME)).alias("time"),
        "temperature_2m",
        "name",
        "snapshot",
    )


def quarantined(parsed: DataFrame) -> DataFrame:
    """Payloads to look at by hand, with their whole text."""
    return parsed.where("NOT is_good").drop("hourly", "is_good")


def payload_status(parsed: DataFrame) -> DataFrame:
    status = F.when(F.col("is_good"), "good").otherwise("quarantined")
    return parsed.groupBy(status.alias("status")).agg(F.count("*").alias("n_payloads"))
