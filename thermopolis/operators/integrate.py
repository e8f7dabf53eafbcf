"""Dimension joins and the trusted fact table.

No side is broadcast by hint: the number of cities grows with the data. Spark broadcasts a side when
its size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermopolis import schemas


def city_info(
    cities: DataFrame,
    regions: DataFrame,
    city_region: DataFrame,
    population: DataFrame,
    city_consumption: DataFrame,
    match_year: bool = True,
) -> DataFrame:
    """One row per city and consumption year, with defaults for missing facts.

    ``match_year=False`` joins population by city alone, which pairs every consumption year with
    every population year.
    """
    located = cities.join(
        city_region.withColumnRenamed("city_id", "located_id"),
        F.col("id") == F.col("located_id"),
        "left",
    ).join(
        regions.select(F.col("id").alias("country_id"), "region_name"),
        F.col("region_id") == F.col("country_id"),
        "left",
    )
    consumption = city_consumption.select("city_id", "year", "water_m3", "electricity_kwh")
    people = population.select(
        F.col("city_id").alias("people_id"), F.col("year").alias("people_year"), "population"
    )
    if match_year:
        # The two fact tables meet first, on the key both are grouped by, so the wider city rows
        # are shuffled once instead of once per fact table.
        facts = consumption.join(
            people,
            (F.col("city_id") == F.col("people_id")) & (F.col("year") == F.col("people_year")),
            "left",
        )
        joined = located.join(facts, F.col("id") == F.col("city_id"), "left")
    else:
        joined = located.join(consumption, F.col("id") == F.col("city_id"), "left").join(
            people, F.col("id") == F.col("people_id"), "left"
        )
    return joined.select(
        "name",
        "latitude",
        "longitude",
        F.coalesce("water_m3", F.lit(0.0)).alias("water_m3"),
        F.coalesce("electricity_kwh", F.lit(0.0)).alias("electricity_kwh"),
        F.coalesce("population", F.lit(0)).alias("population"),
        "year",
        F.coalesce("region_name", F.lit("Unknown")).alias("country"),
    )


def trusted(daily: DataFrame, info: DataFrame) -> DataFrame:
    """Daily statistics of the cities known by exactly that name. ``year`` is the consumption year."""
    return (
        daily.join(info, "name", "inner")
        .withColumnRenamed("name", "city")
        .select(*schemas.TRUSTED.names)
    )
