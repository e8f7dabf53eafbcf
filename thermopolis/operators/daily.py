"""Hourly readings to daily statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermopolis.functions.columns import DAY


def latest_readings(readings: DataFrame) -> DataFrame:
    """One reading per (name, time): the one from the newest snapshot.

    Times are compared exactly, so readings within one hour all stay. Of copies with equal stamps the
    greatest is kept, which makes the result the same however the rows are partitioned. The greatest
    (stamp, value) combines on the map side, so overlapping snapshots shrink before the shuffle; a
    ``row_number`` window would ship every copy. Copies of unknown age count as older than any other.
    """
    newest = F.max(F.struct("snapshot", "temperature_2m"))
    grouped = readings.groupBy("name", "time").agg(newest.alias("newest"))
    return grouped.select("name", "time", F.col("newest.temperature_2m").alias("temperature_2m"))


def daily_weather(readings: DataFrame, dedupe: str = "none") -> DataFrame:
    """Average, least and greatest temperature per (name, date).

    Consecutive snapshots overlap. ``dedupe="none"`` averages all copies; ``dedupe="latest"`` first
    keeps the newest copy of each reading and needs a ``snapshot`` column.
    """
    if dedupe == "latest":
        readings = latest_readings(readings)
    elif dedupe != "none":
        raise ValueError(f"dedupe is 'none' or 'latest', not {dedupe!r}")
    # Grouping by a DATE keeps the key small; it becomes text once per day, not once per reading.
    return (
        readings.groupBy("name", F.to_date("time").alias("day"))
        .agg(
            F.avg("temperature_2m").alias("avg_temperature"),
            F.min("temperature_2m").alias("min_temperature"),
            F.max("temperature_2m").alias("max_temperature"),
        )
        .select(
            "name",
            F.date_format("day", DAY).alias("date"),
            "avg_temperature",
            "min_temperature",
            "max_temperature",
        )
    )


def _exact_sums(value: str) -> list[Column]:
    """Count, sum and range of doubles such that parts add up to the same whole in any order.

    Readings are summed as decimals of 18 places, which hold them digit by digit; what no such
    decimal can hold (NaN, infinities, 1e9 and beyond) is added apart as doubles.
    """
    exact = F.when(F.abs(value) < 1e9, F.col(value)).try_cast("decimal(38,18)")
    return [
        F.count(value).alias("n"),
        F.sum(exact).alias("total"),
        F.sum(F.when(exact.isNull(), F.col(value))).alias("beyond"),
        F.min(value).alias("least"),
        F.max(value).alias("greatest"),
    ]


def partial_days(readings: DataFrame, dedupe: str = "none", *keys: str) -> DataFrame:
    """What ``merge_days`` needs of some readings, per ``keys``, name and day; for ``dedupe="latest"`` per
    time too, as a later part may hold a newer copy of it. ``n_rows`` counts the readings."""
    days = readings.withColumn("day", F.to_date("time"))
    if dedupe == "none":
        return days.groupBy(*keys, "name", "day").agg(F.count("*").alias("n_rows"), *_exact_sums("temperature_2m"))
    if dedupe != "latest":
        raise ValueError(f"dedupe is 'none' or 'latest', not {dedupe!r}")
    newest = F.max(F.struct("snapshot", "temperature_2m"))
    return days.groupBy(*keys, "name", "day", "time").agg(F.count("*").alias("n_rows"), newest.alias("newest"))


def merge_days(partials: DataFrame, dedupe: str = "none") -> DataFrame:
    """The rows of ``daily_weather`` out of the parts of all readings, however those were divided.

    The result depends on the readings only, to the last bit; averages may differ from a sum of doubles in
    the last digits.
    """
    if dedupe == "latest":
        times = partials.groupBy("name", "day", "time").agg(F.max("newest").alias("newest"))
        times = times.select("name", "day", F.col("newest.temperature_2m").alias("temperature_2m"))
        sums = times.groupBy("name", "day").agg(*_exact_sums("temperature_2m"))
    else:
        sums = partials.groupBy("name", "day").agg(
            *[F.sum(c).alias(c) for c in ("n", "total", "beyond")], F.min("least").alias("least"), F.max("greatest").alias("greatest")
        )
    total = F.coalesce(F.col("total").cast("double"), F.lit(0.0)) + F.coalesce("beyond", F.lit(0.0))
    return sums.select(
        "name",
        F.date_format("day", DAY).alias("date"),
        (total / F.nullif(F.col("n"), F.lit(0))).alias("avg_temperature"),
        F.col("least").alias("min_temperature"),
        F.col("greatest").alias("max_temperature"),
    )
