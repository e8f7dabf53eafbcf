"""The driver's parquet tables, seen as this engine's input tables.

Customers are cities, nations are countries, orders are yearly consumption, events are readings.
``oracle.PREFIX`` says the same in SQL. Nothing here is part of the engine.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermopolis.functions.columns import PAYLOAD_TIME

# Fixed value: one fetch of the weather service holds seven days of hours.
PAYLOAD_ROWS = 168

# Declared, so that building a query starts no job to look into the files.
TABLES = {
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,
                 props string""",
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
                   c_mktsegment string""",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
                 o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
                   l_quantity double, l_extendedprice double, l_discount double, l_tax double,
                   l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("name"),
        F.col("ts").cast("timestamp").alias("time"),
        F.col("value").alias("temperature_2m"),
        F.col("event_id").alias("snapshot"),
    )


def _orders(spark: SparkSession, sf_dir: str, year: int | None) -> DataFrame:
    """Orders of one year by a range of dates, which unlike ``year(...)`` reaches the parquet scan."""
    orders = table(spark, sf_dir, "orders")
    if year is None:
        return orders
    first, end = (F.lit(datetime.date(y, 1, 1)).cast("timestamp_ntz") for y in (year, year + 1))
    return orders.where((F.col("o_orderdate") >= first) & (F.col("o_orderdate") < end))


def city_consumption(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    orders, items = _orders(spark, sf_dir, year), table(spark, sf_dir, "lineitem")
    if year is not None:
        # Items of other years go before they are summed and shuffled.
        items = items.join(orders, items.l_orderkey == orders.o_orderkey, "left_semi")
    water = items.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("order_water"))
    return (
        orders.join(water, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy(F.col("o_custkey").alias("city_id"), F.year("o_orderdate").alias("year"))
        .agg(
            F.sum("order_water").alias("water_m3"),
            F.sum("o_totalprice").alias("electricity_kwh"),
        )
    )


def population(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    return (
        _orders(spark, sf_dir, year)
        .where(F.col("o_orderpriority") != "1-URGENT")
        .groupBy(F.col("o_custkey").alias("city_id"), F.year("o_orderdate").alias("year"))
        .agg(F.count("*").cast("int").alias("population"))
    )


def dimensions(spark: SparkSession, sf_dir: str, year: int | None = None) -> dict[str, DataFrame]:
    """The five relational tables; facts of one year only if ``year`` is given."""
    customer = table(spark, sf_dir, "customer")
    return {
        "cities": customer.select(
            F.col("c_custkey").alias("id"),
            F.col("c_custkey").cast("string").alias("name"),
            (F.col("c_nationkey") * F.lit(5.0) - F.lit(60.0)).alias("latitude"),
            (F.col("c_custkey") % F.lit(360) - F.lit(180.0)).alias("longitude"),
        ),
        "regions": table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("region_name")
        ),
        "city_region": customer.select(
            F.col("c_custkey").alias("city_id"), F.col("c_nationkey").alias("region_id")
        ),
        "population": population(spark, sf_dir, year),
        "city_consumption": city_consumption(spark, sf_dir, year),
    }


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text per city and fetch, with the kind of its last event.

    A fetch covers a block of ``PAYLOAD_ROWS`` event ids, so no text grows with the data even if one
    city holds a large share of it.
    """
    reading = F.struct("ts", "event_id", "value", "event_type")
    fetches = (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.expr(f"event_id div {PAYLOAD_ROWS}").alias("fetch"))
        .agg(F.sort_array(F.collect_list(reading)).alias("hours"))
    )
    times = F.transform(
        "hours", lambda hour: F.date_format(hour["ts"].cast("timestamp"), PAYLOAD_TIME)
    )
    hourly = F.struct(times.alias("time"), F.col("hours.value").alias("temperature_2m"))
    return fetches.select(
        F.col("user_id").cast("string").alias("name"),
        F.to_json(F.struct(hourly.alias("hourly"))).alias("payload"),
        F.element_at("hours", -1)["event_type"].alias("last_event"),
    )


def dirty_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads as a failing service leaves them: cut off after an ``error`` event, or an answer
    without readings after a ``signup`` event."""
    cut = F.substring(F.col("payload"), F.lit(1), F.floor(F.length("payload") / 2).cast("int"))
    return payloads(spark, sf_dir).withColumn(
        "payload",
        F.when(F.col("last_event") == "error", cut)
        .when(F.col("last_event") == "signup", F.lit('{"error": true}'))
        .otherwise(F.col("payload")),
    )


def order_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with blanks and capitals."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("name")).distinct()
