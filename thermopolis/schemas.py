"""Declared schema of every table. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


READINGS = _struct(
    ("time", TimestampType()),
    ("temperature_2m", DoubleType()),
    ("name", StringType()),
)

# The raw zone this engine writes keeps the fetch instant as a column.
STAMPED_READINGS = StructType(READINGS.fields + [StructField("snapshot", TimestampType(), True)])

COLLECTED = _struct(
    ("name", StringType()),
    ("snapshot", TimestampType()),
    ("payload", StringType()),
)

# Quarantine keeps the digest of a row beside it.
QUARANTINED = StructType(COLLECTED.fields + [StructField("digest", StringType(), True)])

PAYLOAD = _struct(
    (
        "hourly",
        _struct(
            ("time", ArrayType(StringType())),
            ("temperature_2m", ArrayType(DoubleType())),
        ),
    ),
)

CITIES = _struct(
    ("id", IntegerType()),
    ("name", StringType()),
    ("latitude", DoubleType()),
    ("longitude", DoubleType()),
)
REGIONS = _struct(("id", IntegerType()), ("region_name", StringType()))
CITY_REGION = _struct(("city_id", IntegerType()), ("region_id", IntegerType()))
POPULATION = _struct(
    ("city_id", IntegerType()), ("year", IntegerType()), ("population", IntegerType())
)
CITY_CONSUMPTION = _struct(
    ("id", IntegerType()),
    ("city_id", IntegerType()),
    ("year", IntegerType()),
    ("water_m3", DoubleType()),
    ("electricity_kwh", DoubleType()),
)

DIMENSIONS = {
    "cities": CITIES,
    "regions": REGIONS,
    "city_region": CITY_REGION,
    "population": POPULATION,
    "city_consumption": CITY_CONSUMPTION,
}

# year is the partition column, so it comes last.
TRUSTED = _struct(
    ("city", StringType()),
    ("date", StringType()),
    ("avg_temperature", DoubleType()),
    ("min_temperature", DoubleType()),
    ("max_temperature", DoubleType()),
    ("latitude", DoubleType()),
    ("longitude", DoubleType()),
    ("water_m3", DoubleType()),
    ("electricity_kwh", DoubleType()),
    ("population", IntegerType()),
    ("country", StringType()),
    ("year", IntegerType()),
)

TEMPERATURE_PER_CITY = _struct(("city", StringType()), ("mean_temp", DoubleType()))
CONSUMPTION_RANKING = _struct(("city", StringType()), ("avg_kwh_per_person", DoubleType()))
ELECTRICITY_PREDICTIONS = _struct(
    ("city", StringType()),
    ("avg_temperature", DoubleType()),
    ("electricity_kwh", DoubleType()),
    ("prediction", DoubleType()),
)

CITY_CLUSTERS = _struct(("city", StringType()), ("cluster", IntegerType()))

MARTS = {
    "temperature_per_city": TEMPERATURE_PER_CITY,
    "consumption_ranking": CONSUMPTION_RANKING,
    "electricity_predictions": ELECTRICITY_PREDICTIONS,
    "city_clusters": CITY_CLUSTERS,
}


class MissingColumnsError(ValueError):
    """A table lacks columns its contract names."""


def require_columns(df: DataFrame, schema: StructType, table: str) -> DataFrame:
    missing = [name for name in schema.names if name not in df.columns]
    if missing:
        raise MissingColumnsError(f"{table} lacks {', '.join(missing)}")
    return df
