"""Trusted zone to refined zone.

Run as ``python -m thermopolis.plans.analysis`` or hand this file to ``spark-submit`` with the package in
``--py-files``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from thermopolis.operators import learning, metrics, serving, stats
from thermopolis.session import build_session, clean, materialize
from thermopolis.sources import sinks, zones


def read_derived(spark: SparkSession, trusted: str, year: int, fmt: str = "parquet") -> DataFrame:
    """One year of trusted rows with derived columns.

    Parquet is cheap to read again per analysis, with only the columns it needs. Text is parsed once
    and kept, as every analysis would parse whole lines.
    """
    if fmt == "csv":
        typed = metrics.typed_trusted(zones.read_trusted_text(spark, trusted))
        return materialize(metrics.derive_metrics(metrics.trusted_year(typed, year)))
    return metrics.derive_metrics(zones.read_trusted(spark, trusted, year, fmt))


def run(
    spark: SparkSession,
    trusted: str,
    output: str,
    year: int,
    fmt: str = "parquet",
    seed: int = 42,
) -> dict[str, DataFrame]:
    """Write the four marts together and return the reports, each computed when asked for."""
    derived = read_derived(spark, trusted, year, fmt)
    scored = learning.score_both(derived, seed)
    clusters = materialize(learning.city_clusters(metrics.city_features(derived), seed=seed))
    marts = {
        "temperature_per_city": metrics.temperature_per_city(derived),
        "consumption_ranking": serving.consumption_rankings(metrics.consumption_per_city(derived)),
        "electricity_predictions": learning.electricity_predictions(scored),
        "city_clusters": clusters,
    }
    sinks.write_marts(marts, output, fmt)

    quartiles = stats.exact_quantiles(derived, "kwh_per_capita")
    outliers = stats.outliers(derived, "kwh_per_capita", stats.iqr_fences(quartiles))
    return {
        "rmse_report": learning.rmse_report(scored),
        "cluster_sizes": learning.cluster_sizes(clusters),
        "correlation_matrix": stats.correlation_matrix(derived),
        "descriptive_stats": stats.descriptive_stats(derived),
        "kwh_quartiles": quartiles,
        "kwh_outlier_count": stats.outlier_count(outliers),
    }


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--trusted", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--year", type=int, required=True)
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    parser.add_argument("--input-bytes", type=int, help="trusted size, to choose shuffle partitions")
    args = parser.parse_args()
    spark = build_session("thermopolis-analysis", input_bytes=args.input_bytes)
    reports = run(spark, args.trusted, args.output, args.year, args.format)
    for name, report in reports.items():
        print(name)
        report.show(50, truncate=False)
    clean(spark)
    spark.stop()


if __name__ == "__main__":
    main()
