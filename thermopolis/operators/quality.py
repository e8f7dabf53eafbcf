"""Data-quality reports: what the name join drops, and rows per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unmatched_names(readings: DataFrame, cities: DataFrame) -> DataFrame:
    """Names seen on one side only.

    Both anti joins in one full join over distinct names: each table is read once and names are
    unique before they meet, so no name is hot. A NULL name matches nothing and is listed.
    """
    read = readings.select("name").distinct().withColumn("in_readings", F.lit(True))
    known = cities.select("name").distinct().withColumn("in_cities", F.lit(True))
    return (
        read.join(known, "name", "full")
        .where(F.col("in_readings").isNull() | F.col("in_cities").isNull())
        .select(
            "name",
            F.when(F.col("in_cities").isNull(), "readings").otherwise("cities").alias("side"),
        )
    )


def stage_counts(readings: DataFrame, info: DataFrame) -> DataFrame:
    """Rows of each stage from raw readings to trusted, reading each input once.

    A name's share of the trusted table is its days times its city rows, so the final count needs
    neither the join output nor a second pass. Written as aggregates rather than accumulators:
    re-run tasks after a lost executor cannot be counted twice.
    """
    days = (
        readings.groupBy("name", F.to_date("time").alias("day"))
        .agg(F.count("*").alias("n_readings"))
        .groupBy("name")
        .agg(F.sum("n_readings").alias("n_readings"), F.count("*").alias("n_days"))
    )
    rows = info.groupBy("name").agg(F.count("*").alias("n_info"))

    def total(column):
        return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")

    totals = days.join(rows, "name", "full").agg(
        total(F.col("n_readings")).alias("readings"),
        total(F.col("n_days")).alias("daily"),
        total(F.col("n_info")).alias("city_info"),
        total(F.col("n_days") * F.col("n_info")).alias("final"),
    )
    return totals.unpivot(
        [], ["readings", "daily", "city_info", "final"], "stage", "n_rows"
    )
