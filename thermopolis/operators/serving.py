"""The read-only queries. Each returns a DataFrame; an empty one means "not found"."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermopolis import schemas
from thermopolis.functions.columns import pearson
from thermopolis.operators.metrics import trusted_year


def list_cities(trusted: DataFrame, year: int) -> DataFrame:
    return trusted_year(trusted, year).select("city", "country", "latitude", "longitude").distinct()


def city_history(trusted: DataFrame, city: str, year: int, n: int = 30) -> DataFrame:
    """The ``n`` latest days of a city. The name is a literal value, so any name is safe."""
    hidden = {"latitude", "longitude", "year"}
    days = trusted_year(trusted, year).where(F.col("city") == F.lit(city))
    return days.select([c for c in schemas.TRUSTED.names if c not in hidden]).orderBy(F.desc("date")).limit(n)


def temperature_rankings(means: DataFrame) -> DataFrame:
    return means.orderBy(F.desc_nulls_last("mean_temp"), F.asc("city"))


def consumption_rankings(averages: DataFrame) -> DataFrame:
    return averages.orderBy(F.desc_nulls_last("avg_kwh_per_person"), F.asc("city"))


def correlations(trusted: DataFrame, year: int) -> DataFrame:
    return trusted_year(trusted, year).agg(
        pearson("avg_temperature", "electricity_kwh").alias("temp_electricity_corr"),
        pearson("avg_temperature", "water_m3").alias("temp_water_corr"),
        pearson("electricity_kwh", "water_m3").alias("electricity_water_corr"),
    )
