import math
import random

import numpy as np
import pytest

import micro
from pyspark.ml.functions import vector_to_array
from thermopolis.operators import learning, metrics
from thermopolis.session import materialize


@pytest.fixture(scope="module")
def derived(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        lat, lon, people = rng.uniform(-60, 60), rng.uniform(-180, 180), rng.randrange(1, 900)
        for day in range(1, 13):
            temp = rng.gauss(20 - abs(lat) / 4, 4)
            rows.append(
                {
                    "city": f"c{i}",
                    "date": f"2025-05-{day:02d}",
                    "avg_temperature": temp,
                    "min_temperature": temp - rng.uniform(1, 5),
                    "max_temperature": temp + rng.uniform(1, 5),
                    "latitude": lat,
                    "longitude": lon,
                    "population": people,
                    "water_m3": people * rng.uniform(1, 2),
                    "electricity_kwh": 40.0 * people + 7 * temp + rng.gauss(0, 50),
                }
            )
    rows.append({"city": "no day", "avg_temperature": None})
    rows.append({"city": "no use", "electricity_kwh": None})
    return materialize(metrics.derive_metrics(micro.trusted(spark, rows)))


def test_split_is_complete_disjoint_and_stable(spark, derived):
    sizes = {r["split"]: r["n_rows"] for r in learning.split_sizes(derived).collect()}
    assert sum(sizes.values()) == derived.count()
    assert 0.7 < sizes["train"] / derived.count() < 0.9

    def keys(df):
        return {(r["city"], r["date"]) for r in learning.with_split(df).where("is_train").collect()}

    assert keys(derived) == keys(derived.repartition(7, "electricity_kwh"))


def test_row_without_key_is_in_one_part(spark):
    df = learning.with_split(micro.trusted(spark, [{"date": None}, {"city": None}]))
    assert df.where("is_train IS NULL").count() == 0


def test_random_split_option(derived):
    train, test = learning.random_split(derived)
    assert train.count() + test.count() == derived.count()


def test_scaled_training_rows_have_unit_deviation(derived):
    scaled = learning.scale(learning.regression_rows(derived))
    train = scaled.where("is_train").select(vector_to_array("scaled_features").alias("x")).collect()
    assert np.array([r["x"] for r in train]).std(axis=0, ddof=1) == pytest.approx(np.ones(6))


def test_unknown_rows_are_left_out_of_models_only(derived):
    cities = {r["city"] for r in learning.scaled_features(derived).select("city").distinct().collect()}
    assert "no day" not in cities and "no use" not in cities and len(cities) == 60
    assert derived.count() == 722


def test_least_squares_residuals_are_orthogonal(derived):
    scaled = learning.scale(learning.regression_rows(derived)).where("is_train")
    model = learning._linear().fit(scaled)
    rows = model.transform(scaled).select(
        vector_to_array("scaled_features").alias("x"), learning.LABEL, learning.LINEAR
    ).collect()
    x = np.array([r["x"] for r in rows])
    residual = np.array([r[learning.LABEL] - r[learning.LINEAR] for r in rows])
    scale = np.abs(x).sum(axis=0) * np.abs(residual).max()
    assert np.abs(x.T @ residual / scale).max() < 1e-8
    assert abs(residual.mean()) < 1e-6


def test_predictions_cover_the_test_rows(derived):
    n_test = learning.regression_rows(derived).where("NOT is_train").count()
    for df in (learning.predict_linear(derived), learning.predict_forest(derived)):
        assert df.columns == ["city", "avg_temperature", "electricity_kwh", "prediction"]
        assert df.count() == n_test
        assert df.where("prediction IS NULL").isEmpty()


def test_report_and_choice(derived):
    scored = materialize(learning.score_both(derived))
    report = {r["model"]: r for r in learning.rmse_report(scored).collect()}
    rows = scored.collect()
    for name, row in report.items():
        expected = math.sqrt(sum((r[learning.LABEL] - r[name]) ** 2 for r in rows) / len(rows))
        assert row["rmse"] == pytest.approx(expected)
    best = min(report.values(), key=lambda r: r["rmse"])
    assert [r["model"] for r in report.values() if r["chosen"]] == [best["model"]]
    mart = sorted(r["prediction"] for r in learning.electricity_predictions(scored).collect())
    assert mart == pytest.approx(sorted(r[best["model"]] for r in rows))


@pytest.mark.parametrize(
    "linear, forest, chosen",
    [(1.0, 1.0, learning.LINEAR), (1.0, 0.5, learning.FOREST), (0.5, 1.0, learning.LINEAR)],
)
def test_forest_must_be_strictly_better(spark, linear, forest, chosen):
    scored = spark.createDataFrame(
        [(0.0, linear, forest)],
        f"{learning.LABEL} double, {learning.LINEAR} double, {learning.FOREST} double",
    )
    report = learning.rmse_report(scored).where("chosen").collect()
    assert [r["model"] for r in report] == [chosen]


def test_forest_repeats_itself(derived):
    layouts = (derived, derived.repartition(7, "electricity_kwh"), derived.coalesce(1))
    first, *others = (sorted(tuple(r) for r in learning.predict_forest(df).collect()) for df in layouts)
    assert all(other == first for other in others)


def test_clusters(spark, derived):
    features = metrics.city_features(derived)
    clusters = learning.city_clusters(features).collect()
    complete = {r["city"] for r in features.dropna().collect()}
    assert len(clusters) == features.count() == len({r["city"] for r in clusters})
    assert {r["city"] for r in clusters if r["cluster"] is not None} == complete
    assert {r["cluster"] for r in clusters} <= {0, 1, 2, 3, None}
    sizes = learning.cluster_sizes(learning.city_clusters(features)).collect()
    assert sum(r["n_cities"] for r in sizes) == features.count()
    labels = [r["cluster"] for r in sizes if r["cluster"] is not None]
    assert labels == sorted(labels)


def under_settings(spark, partitions, made):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        return made()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("part_rows", [learning.PART_ROWS, 100])
def test_models_depend_on_the_rows_only(spark, derived, monkeypatch, part_rows):
    """The same predictions and labels under any number of shuffle partitions and layout of files."""
    deal = learning._same_layout
    monkeypatch.setattr(learning, "_same_layout", lambda rows, *key: deal(rows, *key, part_rows=part_rows))
    features = metrics.city_features(derived)
    forests, labels = [], []
    for partitions, layout in ((2, derived), (8, derived.repartition(5, "population")), (200, derived.coalesce(1))):
        forests.append(under_settings(spark, partitions, lambda d=layout: sorted(learning.predict_forest(d).collect())))
        cities = features.repartition(partitions)
        labels.append(under_settings(spark, partitions, lambda c=cities: sorted(learning.city_clusters(c).na.fill(-1).collect())))
    assert labels[1:] == labels[:-1]
    for other in forests[1:]:
        assert [tuple(r)[:3] for r in other] == [tuple(r)[:3] for r in forests[0]]
        assert [r.prediction for r in other] == pytest.approx([r.prediction for r in forests[0]], rel=1e-9)


def test_clusters_are_numbered_by_their_centres(spark, derived):
    features = metrics.city_features(derived).dropna()
    labelled = learning.city_clusters(features).join(features, "city")
    means = {r["cluster"]: r for r in labelled.groupBy("cluster").avg("avg_temp").collect()}
    assert sorted(means) == [0, 1, 2, 3]
    assert [means[i]["avg(avg_temp)"] for i in range(4)] == sorted(r["avg(avg_temp)"] for r in means.values())
