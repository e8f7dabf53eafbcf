import math
import random

import numpy as np
import pytest

import micro
from pyspark.sql import functions as F
from thermopolis.operators import metrics, stats


def brute(values, p):
    known = sorted(v for v in values if v is not None)
    return known[max(1, math.ceil(p * len(known))) - 1] if known else None


def frame(spark, values, parts=6):
    return spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)


def cases():
    rng = random.Random(11)
    yield "uniform", [rng.random() for _ in range(20_000)]
    yield "third is one value", [5.0 if i % 3 == 0 else rng.gauss(5, 1) for i in range(20_000)]
    yield "quartile at a gap", [rng.gauss(0, 1e-6) if i % 4 else 1e9 * rng.random() for i in range(20_000)]
    yield "few values", [float(rng.randrange(4)) for _ in range(5_000)]
    yield "far outliers", [rng.random() * (1e9 if i % 500 == 0 else 1) for i in range(20_000)]
    yield "some unknown", [None if i % 4 == 0 else rng.expovariate(1) for i in range(8_000)]
    yield "negative", [-rng.paretovariate(0.5) for _ in range(8_000)]
    yield "one", [3.0]
    yield "two", [3.0, 4.0]
    yield "constant", [2.0] * 1000
    yield "none", []
    yield "only unknown", [None] * 10


@pytest.mark.parametrize("values", [c[1] for c in cases()], ids=[c[0] for c in cases()])
@pytest.mark.parametrize("accuracy", [20, 1_000])
def test_exact_quantiles(spark, values, accuracy):
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75, "low": 0.0, "high": 1.0}
    row = stats.exact_quantiles(frame(spark, values), "v", probs, accuracy).first()
    assert row.asDict() == {name: brute(values, p) for name, p in probs.items()}


def test_approximate_quantiles_stay_near_their_rank(spark):
    values = [float(i) for i in range(10_000)]
    row = stats.approx_quantiles(frame(spark, values), "v", accuracy=200).first()
    assert abs(row["q1"] - 2499) <= 10_000 / 200 + 1
    assert abs(row["q3"] - 7499) <= 10_000 / 200 + 1


def test_fences_and_outliers(spark):
    values = [1.0, 2.0, 2.0, 3.0, 3.0, 4.0, 50.0, -40.0, None]
    df = frame(spark, values)
    fences = stats.iqr_fences(stats.exact_quantiles(df, "v"))
    low, high = fences.first()
    q1, q3 = brute(values, 0.25), brute(values, 0.75)
    assert (low, high) == (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    found = stats.outliers(df, "v", fences)
    assert sorted(r["v"] for r in found.collect()) == [-40.0, 50.0]
    assert stats.outlier_count(found).first()["n_outliers"] == 2


def test_outliers_need_no_join(spark):
    df = frame(spark, [1.0, 2.0])
    fences = stats.iqr_fences(stats.exact_quantiles(df, "v"))
    plan = stats.outliers(df, "v", fences)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def derived(spark, n=200):
    rng = random.Random(3)
    rows = [
        {
            "city": f"c{i}",
            "avg_temperature": rng.gauss(15, 5),
            "max_temperature": 25 + rng.random(),
            "electricity_kwh": rng.uniform(1, 9) * 1000,
            "water_m3": rng.uniform(1, 9) * 100,
            "population": rng.randrange(0, 5),
        }
        for i in range(n)
    ]
    return metrics.derive_metrics(micro.trusted(spark, rows))


def test_matrix_against_numpy(spark):
    df = derived(spark)
    rows = [r for r in df.select(*stats.CORRELATED).collect() if None not in tuple(r)]
    assert 0 < len(rows) < 200
    expected = np.corrcoef(np.array([tuple(r) for r in rows], dtype=float).T)
    got = {(r["var_a"], r["var_b"]): r["corr"] for r in stats.correlation_matrix(df).collect()}
    assert len(got) == 36
    for i, a in enumerate(stats.CORRELATED):
        for j, b in enumerate(stats.CORRELATED):
            assert got[a, b] == pytest.approx(expected[i, j], abs=1e-12)


def test_matrix_with_a_constant_column(spark):
    df = metrics.derive_metrics(
        micro.trusted(spark, [{"avg_temperature": float(t)} for t in range(4)])
    )
    got = {(r["var_a"], r["var_b"]): r["corr"] for r in stats.correlation_matrix(df).collect()}
    assert got["avg_temperature", "water_m3"] is None
    assert got["water_m3", "water_m3"] == 1.0


def test_descriptive_statistics(spark):
    df = derived(spark)
    got = {r["variable"]: r for r in stats.descriptive_stats(df).collect()}
    assert got.keys() == set(stats.DESCRIBED)
    for name, row in got.items():
        values = [r[0] for r in df.select(name).collect() if r[0] is not None]
        assert row["n"] == len(values)
        assert row["mean"] == pytest.approx(np.mean(values))
        assert row["stddev"] == pytest.approx(np.std(values, ddof=1))
        assert (row["min"], row["max"]) == (min(values), max(values))


@pytest.mark.parametrize("fan", [1, 3, 316])
def test_sketches_meet_in_two_levels(spark, fan):
    """Sketches of 40 tasks go to ``fan`` buckets first; quantiles are exact for any of them."""
    rng = random.Random(fan)
    values = [rng.choice([rng.gauss(0, 1), float(rng.randrange(5)), 1e9 * rng.random()]) for _ in range(3000)]
    df = frame(spark, values).repartition(40)
    probs = {"a": 0.0, "b": 0.01, "c": 0.25, "d": 0.5, "e": 0.75, "f": 0.999, "g": 1.0}
    row = stats.exact_quantiles(df, "v", probs, accuracy=50, fan=fan).first()
    assert row.asDict() == {name: brute(values, p) for name, p in probs.items()}
    points = stats._points(df.select(df.v.alias("value")).withColumn("step", F.lit(1)), ["step"], F.lit(True), 50, fan)
    assert points.agg(F.sum("n"), F.sum("parts")).first() == (3000, min(fan, 40))
    plan = points._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "percentile_approx" in line:
            assert "bucket" in line.split("functions=")[0]
    tasks = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(fan)).alias("b")).agg(F.count_distinct(F.spark_partition_id()).alias("n"))
    assert max(r["n"] for r in tasks.collect()) <= -(-40 // fan)
