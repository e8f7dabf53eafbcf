"""Correlation matrix, descriptive statistics, quartiles and outliers."""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CORRELATED = [
    "avg_temperature",
    "electricity_kwh",
    "water_m3",
    "population",
    "temp_range",
    "kwh_per_capita",
]
DESCRIBED = ["avg_temperature", "electricity_kwh", "kwh_per_capita", "temp_range"]
QUARTILES = {"q1": 0.25, "q3": 0.75}
#: Buckets that the tasks' sketches are merged in first: the square root of the most scan tasks of a job.
SKETCH_FAN = 316


def correlation_matrix(derived: DataFrame, columns: list[str] = CORRELATED) -> DataFrame:
    """Full Pearson matrix in long form, over rows where every column is known.

    One pass keeps a deviation per column and a covariance per pair; the mirrored half and the
    diagonal are added to that one row.
    """
    complete = derived.where(reduce(and_, [F.col(c).isNotNull() for c in columns]))
    pairs = list(combinations(columns, 2))
    row = complete.agg(
        F.count("*").alias("n"),
        *[F.stddev_pop(c).alias(f"dev|{c}") for c in columns],
        *[F.covar_pop(a, b).alias(f"{a}|{b}") for a, b in pairs],
    )

    def cell(a, b, value):
        return F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"), value.alias("corr"))

    cells = [cell(c, c, F.when(F.col("n") > 0, F.lit(1.0))) for c in columns]
    for a, b in pairs:
        spread = F.col(f"dev|{a}") * F.col(f"dev|{b}")
        value = F.col(f"{a}|{b}") / F.nullif(spread, F.lit(0.0))
        cells += [cell(a, b, value), cell(b, a, value)]
    return row.select(F.inline(F.array(*cells)))


def descriptive_stats(derived: DataFrame, columns: list[str] = DESCRIBED) -> DataFrame:
    """Typed count, mean, sample deviation, least and greatest value, one row per variable."""
    row = derived.agg(
        *[
            F.struct(
                F.lit(c).alias("variable"),
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("stddev"),
                F.min(c).alias("min"),
                F.max(c).alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    return row.select(F.inline(F.array(*[F.col(c) for c in columns])))


def approx_quantiles(
    df: DataFrame, column: str, probs: dict[str, float] = QUARTILES, accuracy: int = 10_000
) -> DataFrame:
    """One row of quantiles, each within ``1/accuracy`` of its rank."""
    found = df.agg(
        F.percentile_approx(column, list(probs.values()), accuracy).alias("found")
    )
    return found.select(*[F.col("found")[i].alias(name) for i, name in enumerate(probs)])


def _points(rows: DataFrame, keys: list[str], inside: Column, size: int, fan: int) -> DataFrame:
    """Points that share out the rows of each key: (keys, value, weight, n, below, parts).

    Tasks are dealt to ``fan`` buckets, a sketch of each task meets those of its bucket, and of the
    merged one ``size`` values of equal depth go on. So no task receives more than a share of the
    tasks' sketches, and the last one ``fan * size`` points a key. ``n`` counts rows that are ``inside``,
    ``below`` the others, ``parts`` the buckets; each stands at one point of its bucket only.
    """
    bucket = F.pmod(F.spark_partition_id(), F.lit(fan))
    grid = [i / size for i in range(size + 1)]
    cuts = rows.withColumn("bucket", bucket).groupBy(*keys, "bucket").agg(
        F.count_if(inside).alias("n"),
        F.count_if(~inside).alias("below"),
        F.percentile_approx(F.when(inside, F.col("value")), grid, 4 * size).alias("cut"),
    )
    each = cuts.select(*keys, "n", "below", F.posexplode_outer("cut").alias("i", "value"))
    first = F.coalesce(F.col("i"), F.lit(0)) == 0
    return each.groupBy(*keys, "value").agg(
        F.sum(F.when(~first, F.col("n") / F.lit(float(size))).otherwise(0.0)).alias("weight"),
        *[F.sum(F.when(first, F.col(c)).otherwise(0)).alias(c) for c in ("n", "below")],
        F.count_if(first).alias("parts"),
    )


def _around(points: DataFrame, key: str, size: int) -> DataFrame:
    """``points`` with the totals of their key, and with the least and the greatest rank that a value's
    last row can have in it.

    A value of the grid is off by a quarter of its depth at most, and by what lies up to the next.
    """
    ordered = Window.partitionBy(key).orderBy(F.col("value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(key)
    found = points.withColumns(
        {"running": F.sum("weight").over(ordered)}
        | {f"all_{c}": F.sum(c).over(whole) for c in ("n", "below", "parts")}
    )
    reach = 1.25 / size * F.col("all_n") + 2 * F.col("all_parts")
    return found.withColumns({"least_rank": F.col("running") - reach, "most_rank": F.col("running") + reach})


def exact_quantiles(
    df: DataFrame, column: str, probs: dict[str, float] = QUARTILES, accuracy: int = 1_000, fan: int = SKETCH_FAN
) -> DataFrame:
    """One row of exact quantiles: the value at rank ``greatest(1, ceil(p * n))``.

    Reads the column three times, so hand in something cheap to read again. Sketches, merged in two levels,
    bracket each quantile. Sketches over the rows of each bracket narrow it down once more; only the
    distinct values between those ends are counted one by one. What meets there in one task is some
    ``10 / accuracy ** 2`` of the rows for any distribution, and equal values count as one. A
    quantile outside of what its step has kept is an error, not a result.
    """
    known = df.select(F.col(column).alias("value")).where(F.col("value").isNotNull())

    def bracket(low, high, target):
        """The nearest points that the row of rank ``target`` cannot lie before or behind."""
        return (
            F.coalesce(F.max(F.when(F.col("most_rank") <= target, F.col("value"))), F.min("value")).alias(low),
            F.coalesce(F.min(F.when(F.col("least_rank") >= target, F.col("value"))), F.max("value")).alias(high),
        )

    def target(p):
        return F.greatest(F.lit(1), F.ceil(F.lit(p) * F.col("all_n")))

    whole = _around(_points(known.withColumn("step", F.lit(1)), ["step"], F.lit(True), accuracy, fan), "step", accuracy)
    first = whole.groupBy("step").agg(
        F.max("all_n").alias("all_n"), *[edge for name, p in probs.items() for edge in bracket(f"low {name}", f"high {name}", target(p))]
    )
    brackets = first.select(
        F.array(
            *[
                F.struct(F.lit(name).alias("prob"), F.col(f"low {name}").alias("low"), F.col(f"high {name}").alias("high"), target(p).alias("target"))
                for name, p in probs.items()
            ]
        )
    ).scalar()

    rows = known.select("value", F.inline(brackets)).where(F.col("value") <= F.col("high"))
    pieces = _around(_points(rows, ["prob", "low", "target"], F.col("value") >= F.col("low"), 2 * accuracy, fan), "prob", 2 * accuracy)
    missed = F.raise_error(F.lit("quantile outside of its bracket")).cast("double")
    place = F.col("target") - F.col("all_below")
    narrow = pieces.groupBy("prob", "target").agg(
        F.max(place).alias("place"), F.max("all_n").alias("n"), *bracket("low", "high", place)
    )
    held = (F.col("place") >= 1) & (F.col("place") <= F.col("n"))
    chosen = narrow.agg(
        F.collect_list(F.struct("prob", "target", F.when(held, F.col("low")).otherwise(missed).alias("low"), "high"))
    ).scalar()
    running = Window.partitionBy("prob").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    reached = (
        known.select("value", F.inline(chosen))
        .where(F.col("value") <= F.col("high"))
        .groupBy("prob", "target", "low", F.greatest("value", "low").alias("value"))
        .agg(F.count("*").alias("weight"), F.count_if(F.col("value") < F.col("low")).alias("below"))
        .withColumn("rank", F.sum("weight").over(running))
        .where(F.col("rank") >= F.col("target"))
    )
    found = reached.groupBy("prob").agg(
        F.min(F.struct("value", (F.col("below") >= F.col("target")).alias("under"))).alias("first")
    )
    value = F.when(F.col("first.under"), missed).otherwise(F.col("first.value"))
    row = found.agg(
        F.count("*").alias("n_found"),
        *[F.min(F.when(F.col("prob") == name, value)).alias(name) for name in probs],
    )
    complete = F.col("n_found").isin(0, len(probs))  # none: no known value
    return row.select(*[F.when(complete, F.col(name)).otherwise(missed).alias(name) for name in probs])


def iqr_fences(quartiles: DataFrame) -> DataFrame:
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    return quartiles.select(
        (F.col("q1") - reach).alias("lower_bound"), (F.col("q3") + reach).alias("upper_bound")
    )


def outliers(df: DataFrame, column: str, fences: DataFrame) -> DataFrame:
    """Rows outside the fences. The one-row fences enter as scalar subqueries, not as a join."""
    bounds = fences.select(F.struct("lower_bound", "upper_bound")).scalar()
    return df.where(
        (F.col(column) < bounds["lower_bound"]) | (F.col(column) > bounds["upper_bound"])
    )


def outlier_count(found: DataFrame) -> DataFrame:
    return found.agg(F.count("*").alias("n_outliers"))
