"""Regression of electricity use, model choice and city segmentation with Spark ML.

Fitting reads its input several times, so callers hand in ``session.materialize(...)`` output.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermopolis import schemas
from thermopolis.functions.columns import is_train
from thermopolis.session import materialize

# The published features of both models.
REGRESSION_FEATURES = [
    "avg_temperature",
    "temp_range",
    "temp_squared",
    "population",
    "latitude",
    "longitude",
]
CLUSTER_FEATURES = [
    "avg_temp",
    "avg_kwh_per_capita",
    "avg_water_per_capita",
    "avg_temp_range",
    "latitude",
    "longitude",
]
LABEL = "electricity_kwh"
#: Rows of one part that a model is fitted on.
PART_ROWS = 250_000
LINEAR = "linear_regression"
FOREST = "random_forest"


def with_split(derived: DataFrame) -> DataFrame:
    return derived.withColumn("is_train", is_train("city", "date"))


def random_split(derived: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """80/20 by Spark's own sampler. The parts depend on how the rows are partitioned."""
    train, test = derived.randomSplit([0.8, 0.2], seed=seed)
    return train, test


def split_sizes(derived: DataFrame) -> DataFrame:
    split = F.when(F.col("is_train"), "train").otherwise("test")
    return with_split(derived).groupBy(split.alias("split")).agg(F.count("*").alias("n_rows"))


def _assemble(df: DataFrame, features: list[str]) -> DataFrame:
    """Rows with an unknown feature cannot enter a model; the marts keep them."""
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip").transform(df)


def _fit_scaler(assembled: DataFrame) -> StandardScalerModel:
    return StandardScaler(inputCol="features", outputCol="scaled_features").fit(assembled)


def _same_layout(rows: DataFrame, *key: str, part_rows: int = PART_ROWS) -> DataFrame:
    """Rows dealt by ``key`` into as many parts as their number asks for, each sorted by it: sampling
    and initial centres then depend on the rows, not on settings or on how they were laid out."""
    parts = max(1, -(-rows.count() // part_rows))
    return rows.repartition(parts, *key).sortWithinPartitions(*key)


def regression_rows(derived: DataFrame) -> DataFrame:
    """Materialized, assembled rows with their split; unlabelled rows have nothing to learn from."""
    rows = _assemble(with_split(derived.where(F.col(LABEL).isNotNull())), REGRESSION_FEATURES)
    rows = materialize(rows.select("city", "date", "avg_temperature", LABEL, "is_train", "features"))
    return _same_layout(rows, "city", "date")


def scale(rows: DataFrame) -> DataFrame:
    """Every row divided by the sample deviation of the training rows."""
    return _fit_scaler(rows.where("is_train")).transform(rows)


def scaled_features(derived: DataFrame) -> DataFrame:
    scaled = scale(regression_rows(derived)).select(
        "city", "date", vector_to_array("scaled_features").alias("scaled")
    )
    return scaled.select(
        "city", "date", *[F.col("scaled")[i].alias(f) for i, f in enumerate(REGRESSION_FEATURES)]
    )


def _linear() -> LinearRegression:
    return LinearRegression(featuresCol="scaled_features", labelCol=LABEL, predictionCol=LINEAR)


def _forest(seed: int) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="scaled_features", labelCol=LABEL, predictionCol=FOREST, numTrees=10, seed=seed
    )


def _mart(scored: DataFrame, model: str) -> DataFrame:
    return scored.withColumnRenamed(model, "prediction").select(*schemas.ELECTRICITY_PREDICTIONS.names)


def predict_linear(derived: DataFrame) -> DataFrame:
    scaled = scale(regression_rows(derived))
    model = _linear().fit(scaled.where("is_train"))
    return _mart(model.transform(scaled.where("NOT is_train")), LINEAR)


def predict_forest(derived: DataFrame, seed: int = 42) -> DataFrame:
    scaled = scale(regression_rows(derived))
    model = _forest(seed).fit(scaled.where("is_train"))
    return _mart(model.transform(scaled.where("NOT is_train")), FOREST)


def score_both(derived: DataFrame, seed: int = 42) -> DataFrame:
    """Test rows with a prediction of each model, sharing one assembler and one scaler.

    Scored once: the report and the mart read the stored predictions.
    """
    scaled = scale(regression_rows(derived))
    train, test = scaled.where("is_train"), scaled.where("NOT is_train")
    scored = _forest(seed).fit(train).transform(_linear().fit(train).transform(test))
    return materialize(scored.select("city", "date", "avg_temperature", LABEL, LINEAR, FOREST))


def rmse_report(scored: DataFrame) -> DataFrame:
    """Both errors in one pass. The forest is chosen only if strictly better."""

    def rmse(model):
        return F.sqrt(F.avg(F.pow(F.col(LABEL) - F.col(model), F.lit(2.0)))).alias(model)

    forest_wins = F.coalesce(F.col(FOREST) < F.col(LINEAR), F.lit(False))

    def line(model, chosen):
        return F.struct(
            F.lit(model).alias("model"), F.col(model).alias("rmse"), chosen.alias("chosen")
        )

    return scored.agg(rmse(LINEAR), rmse(FOREST)).select(
        F.inline(F.array(line(LINEAR, ~forest_wins), line(FOREST, forest_wins)))
    )


def electricity_predictions(scored: DataFrame) -> DataFrame:
    """Predictions of the better model, chosen inside the plan."""
    best = rmse_report(scored).where("chosen").select("model").scalar()
    chosen = F.when(best == FOREST, F.col(FOREST)).otherwise(F.col(LINEAR))
    return _mart(scored.withColumn("prediction", chosen), "prediction")


def city_clusters(features: DataFrame, k: int = 4, seed: int = 42) -> DataFrame:
    """Cities grouped by k-means over six features. Clusters are numbered in the order of their centres,
    feature by feature; NULL is the label of a city with an unknown feature.
    """
    rows = _same_layout(materialize(_assemble(features, CLUSTER_FEATURES).select("city", "features")), "city")
    scaled = _fit_scaler(rows).transform(rows)
    kmeans = KMeans(k=k, seed=seed, featuresCol="scaled_features", predictionCol="cluster")
    model = kmeans.fit(scaled)
    found = model.transform(scaled).select("city", _ordered(model.clusterCenters()).alias("cluster"))
    return features.select("city").join(found, "city", "left")


def _ordered(centres: list) -> Column:
    """The label of each cluster by the place of its centre among all ``k``. Centres are compared to nine
    digits, as their sums are added in no fixed order."""
    order = sorted(range(len(centres)), key=lambda i: [float(f"{x:.9g}") for x in centres[i]])
    return F.element_at(F.array(*[F.lit(order.index(i)) for i in range(len(centres))]), F.col("cluster") + 1)


def cluster_sizes(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("cluster").agg(F.count("*").alias("n_cities")).orderBy("cluster")
