"""Every registered query: (spark, folder of parquet tables) -> DataFrame.

The operators return plain doubles. ``_rounded`` rounds what a query hands out, because two engines
add doubles in different orders: 6 decimals, 4 where values reach 1e5, 2 for money-like sums.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermopolis import adapter, schemas
from thermopolis.functions import columns
from thermopolis.operators import daily, integrate, learning, metrics, quality, serving, stats
from thermopolis.session import materialize, use_utc
from thermopolis.sources import raw

Query = Callable[[SparkSession, str], DataFrame]

YEAR = 2000
CITY = "12"
DAYS = 30
SEED = 42

QUERIES: dict[str, Query] = {}

_DECIMALS = {
    "water_m3": 2,
    "electricity_kwh": 2,
    "kwh_per_capita": 4,
    "avg_kwh_per_capita": 4,
    "avg_kwh_per_person": 4,
    "lower_bound": 4,
    "upper_bound": 4,
    "q1": 4,
    "q3": 4,
    "mean": 4,
    "stddev": 4,
    "min": 4,
    "max": 4,
    "prediction": 2,
    "rmse": 2,
}
_CORRELATIONS = {"corr", "temp_electricity_corr", "temp_water_corr", "electricity_water_corr"}


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.round(name, 8 if name in _CORRELATIONS else _DECIMALS.get(name, 6)).alias(name)
            if kind == "double"
            else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def _query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(use_utc(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _info(spark, sf_dir, year=None, match_year=True):
    return integrate.city_info(**adapter.dimensions(spark, sf_dir, year), match_year=match_year)


def _trusted(spark, sf_dir):
    days = daily.daily_weather(adapter.readings(spark, sf_dir))
    return integrate.trusted(days, _info(spark, sf_dir))


def _trusted_year(spark, sf_dir):
    """One year of trusted, the range of order dates narrowed at the scan as a partition would."""
    days = daily.daily_weather(adapter.readings(spark, sf_dir))
    return metrics.trusted_year(integrate.trusted(days, _info(spark, sf_dir, YEAR)), YEAR)


def _derived(spark, sf_dir):
    return metrics.derive_metrics(_trusted_year(spark, sf_dir))


# Scans and ingestion


@_query
def scan_readings(spark, sf_dir):
    return adapter.readings(spark, sf_dir).select("name", "time", "temperature_2m")


@_query
def scan_dimensions(spark, sf_dir):
    return raw.dimension_counts(adapter.dimensions(spark, sf_dir))


@_query
def explode_payload(spark, sf_dir):
    parsed = raw.parse_payloads(adapter.payloads(spark, sf_dir))
    return raw.explode_payloads(parsed).select("name", "time", "temperature_2m")


@_query
def quarantine_payloads(spark, sf_dir):
    return raw.payload_status(raw.parse_payloads(adapter.dirty_payloads(spark, sf_dir)))


@_query
def city_slug(spark, sf_dir):
    names = adapter.order_priorities(spark, sf_dir)
    return names.select("name", columns.city_slug("name").alias("slug"))


@_query
def snapshot_label(spark, sf_dir):
    events = adapter.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return events.select("event_id", columns.snapshot_label("ts").alias("label"))


# Raw to trusted


@_query
def daily_weather(spark, sf_dir):
    return _rounded(daily.daily_weather(adapter.readings(spark, sf_dir)))


@_query
def daily_weather_latest(spark, sf_dir):
    return _rounded(daily.daily_weather(adapter.readings(spark, sf_dir), dedupe="latest"))


def _merged(spark, sf_dir, dedupe):
    """Days out of the parts that 24 fetches of their own would leave behind."""
    parted = adapter.readings(spark, sf_dir).withColumn("fetch", F.col("snapshot") % 24)
    return _rounded(daily.merge_days(daily.partial_days(parted, dedupe, "fetch"), dedupe))


@_query
def daily_weather_merged(spark, sf_dir):
    return _merged(spark, sf_dir, "none")


@_query
def daily_weather_latest_merged(spark, sf_dir):
    return _merged(spark, sf_dir, "latest")


@_query
def city_info(spark, sf_dir):
    return _rounded(_info(spark, sf_dir))


@_query
def city_info_anyyear(spark, sf_dir):
    return _rounded(_info(spark, sf_dir, match_year=False))


@_query
def trusted(spark, sf_dir):
    return _rounded(_trusted(spark, sf_dir))


@_query
def trusted_year(spark, sf_dir):
    return _rounded(_trusted_year(spark, sf_dir))


@_query
def typed_trusted(spark, sf_dir):
    text = _trusted_year(spark, sf_dir).select(
        *[F.col(name).cast("string").alias(name) for name in schemas.TRUSTED.names]
    )
    return _rounded(metrics.typed_trusted(text))


@_query
def unmatched_names(spark, sf_dir):
    cities = adapter.dimensions(spark, sf_dir)["cities"]
    return quality.unmatched_names(adapter.readings(spark, sf_dir), cities)


@_query
def stage_counts(spark, sf_dir):
    return quality.stage_counts(adapter.readings(spark, sf_dir), _info(spark, sf_dir))


# Trusted to refined


@_query
def derived_metrics(spark, sf_dir):
    return _rounded(
        _derived(spark, sf_dir).select(
            "city", "date", "temp_range", "kwh_per_capita", "water_per_capita", "temp_squared"
        )
    )


@_query
def temperature_per_city(spark, sf_dir):
    return _rounded(metrics.temperature_per_city(_trusted_year(spark, sf_dir)))


@_query
def temperature_rankings(spark, sf_dir):
    means = metrics.temperature_per_city(_trusted_year(spark, sf_dir))
    return _rounded(serving.temperature_rankings(means))


@_query
def consumption_ranking(spark, sf_dir):
    averages = metrics.consumption_per_city(_trusted_year(spark, sf_dir))
    return _rounded(serving.consumption_rankings(averages))


@_query
def city_features(spark, sf_dir):
    return _rounded(metrics.city_features(_derived(spark, sf_dir)))


@_query
def correlations(spark, sf_dir):
    return _rounded(serving.correlations(_trusted_year(spark, sf_dir), YEAR))


@_query
def correlation_matrix(spark, sf_dir):
    return _rounded(stats.correlation_matrix(_derived(spark, sf_dir)))


@_query
def descriptive_stats(spark, sf_dir):
    return _rounded(stats.descriptive_stats(_derived(spark, sf_dir)))


def _kwh(spark, sf_dir):
    """Written once: quantiles read it twice and the outlier filter a third time."""
    return materialize(_derived(spark, sf_dir).select("city", "date", "kwh_per_capita"))


def _fences(kwh):
    return stats.iqr_fences(stats.exact_quantiles(kwh, "kwh_per_capita"))


@_query
def kwh_quartiles(spark, sf_dir):
    return _rounded(stats.exact_quantiles(_kwh(spark, sf_dir), "kwh_per_capita"))


@_query
def kwh_fences(spark, sf_dir):
    return _rounded(_fences(_kwh(spark, sf_dir)))


@_query
def kwh_outliers(spark, sf_dir):
    kwh = _kwh(spark, sf_dir)
    return _rounded(stats.outliers(kwh, "kwh_per_capita", _fences(kwh)))


@_query
def kwh_outlier_count(spark, sf_dir):
    kwh = _kwh(spark, sf_dir)
    return stats.outlier_count(stats.outliers(kwh, "kwh_per_capita", _fences(kwh)))


# Serving


@_query
def list_cities(spark, sf_dir):
    return _rounded(serving.list_cities(_trusted_year(spark, sf_dir), YEAR))


@_query
def city_history(spark, sf_dir):
    return _rounded(serving.city_history(_trusted_year(spark, sf_dir), CITY, YEAR, DAYS))


# Learning


@_query
def split_sizes(spark, sf_dir):
    return learning.split_sizes(_derived(spark, sf_dir))


@_query
def scaled_features(spark, sf_dir):
    return _rounded(learning.scaled_features(_derived(spark, sf_dir)))


@_query
def predict_linear(spark, sf_dir):
    return _rounded(learning.predict_linear(_derived(spark, sf_dir)))


@_query
def linear_rmse(spark, sf_dir):
    error = F.pow(F.col(learning.LABEL) - F.col("prediction"), F.lit(2.0))
    return _rounded(learning.predict_linear(_derived(spark, sf_dir)).agg(F.sqrt(F.avg(error)).alias("rmse")))


# What a forest or k-means finds, SQL cannot state. The queries below give facts computed from the
# fitted result that SQL can: green there proves the facts, not the predicted values or labels.


@_query
def predict_forest(spark, sf_dir):
    """Test rows with their label, and whether the prediction lies among the training labels."""
    derived = _derived(spark, sf_dir)
    train = learning.regression_rows(derived).where("is_train")
    least, most = (train.agg(f(learning.LABEL)).scalar() for f in (F.min, F.max))
    slack = 1e-9 * F.abs(F.col("prediction"))
    inside = (F.col("prediction") >= least - slack) & (F.col("prediction") <= most + slack)
    mart = learning.predict_forest(derived, SEED).withColumn("in_range", inside)
    return _rounded(mart.select("city", "avg_temperature", learning.LABEL, "in_range"))


@_query
def rmse_report(spark, sf_dir):
    """How many models were compared and chosen, and whether the chosen one has the least error."""
    report = learning.rmse_report(learning.score_both(_derived(spark, sf_dir), SEED))
    return report.agg(
        F.count("rmse").alias("n_models"),
        F.count_if("chosen").alias("n_chosen"),
        (F.min(F.when(F.col("chosen"), F.col("rmse"))) == F.min("rmse")).alias("chosen_is_least"),
    )


@_query
def electricity_predictions(spark, sf_dir):
    """Rows of the mart with their label, and whether the prediction is known."""
    mart = learning.electricity_predictions(learning.score_both(_derived(spark, sf_dir), SEED))
    known = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    return _rounded(mart.select("city", "avg_temperature", learning.LABEL, known.alias("is_known")))


def _clusters(spark, sf_dir):
    return learning.city_clusters(metrics.city_features(_derived(spark, sf_dir)), seed=SEED)


@_query
def city_clusters(spark, sf_dir):
    """Every city, and whether it has a cluster."""
    return _clusters(spark, sf_dir).select("city", F.col("cluster").isNotNull().alias("has_cluster"))


@_query
def cluster_sizes(spark, sf_dir):
    """Cities in the sizes of all clusters, those without one, and whether the labels are 0 to 3."""
    sizes = learning.cluster_sizes(_clusters(spark, sf_dir))
    return sizes.agg(
        F.sum("n_cities").alias("n_cities"),
        F.coalesce(F.sum(F.when(F.col("cluster").isNull(), F.col("n_cities"))), F.lit(0)).cast("long").alias("n_without"),
        ((F.min("cluster") >= 0) & (F.max("cluster") <= 3)).alias("labels_in_range"),
    )
