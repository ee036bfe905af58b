"""Linear, logistic, naive Bayes and k-means learners on vector columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, NaiveBayes, NaiveBayesModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator, RegressionEvaluator
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit, TrainValidationSplitModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The elastic-net search grid.
LINEAR_GRID = {"regParam": (1.0, 0.1, 0.01), "fitIntercept": (False, True), "elasticNetParam": (0.0, 0.5, 1.0)}


def linear_regression(df: DataFrame, label: str = "label", features: str = "features") -> LinearRegressionModel:
    return LinearRegression(labelCol=label, featuresCol=features).fit(df)


def linear_grid_points(grid: dict[str, Sequence] = LINEAR_GRID) -> list[dict]:
    """The points in the order in which the grid search measures them."""
    points = [{}]
    for name, values in grid.items():
        points = [p | {name: v} for p in points for v in values]
    return points


def linear_regression_grid(
    df: DataFrame,
    grid: dict[str, Sequence] = LINEAR_GRID,
    label: str = "label",
    features: str = "features",
    parallelism: int = 2,
    seed: int = 11,
) -> TrainValidationSplitModel:
    estimator = LinearRegression(labelCol=label, featuresCol=features)
    points = ParamGridBuilder()
    for name, values in grid.items():
        points = points.addGrid(estimator.getParam(name), list(values))
    return TrainValidationSplit(
        estimator=estimator,
        estimatorParamMaps=points.build(),
        evaluator=RegressionEvaluator(metricName="rmse", labelCol=label),
        trainRatio=0.8,
        parallelism=parallelism,
        seed=seed,
    ).fit(df)


def logistic_regression(
    df: DataFrame,
    label: str = "label",
    features: str = "features",
    iterations: int = 100,
    reg: float = 0.0,
    elastic_net: float = 0.0,
) -> LogisticRegressionModel:
    """Multinomial logistic regression by L-BFGS (OWL-QN with an L1 part)."""
    return LogisticRegression(
        labelCol=label,
        featuresCol=features,
        family="multinomial",
        maxIter=iterations,
        regParam=reg,
        elasticNetParam=elastic_net,
    ).fit(df)


def naive_bayes(df: DataFrame, label: str = "label", features: str = "features", smoothing: float = 1.0) -> NaiveBayesModel:
    return NaiveBayes(labelCol=label, featuresCol=features, smoothing=smoothing, modelType="multinomial").fit(df)


def k_means(df: DataFrame, k: int = 2, seed: int = 1, features: str = "features", iterations: int = 20) -> KMeansModel:
    return KMeans(k=k, seed=seed, maxIter=iterations, featuresCol=features, predictionCol="cluster").fit(df)


def silhouette(predictions: DataFrame, features: str = "features") -> float:
    return ClusteringEvaluator(featuresCol=features, predictionCol="cluster").evaluate(predictions)


def assign_clusters(df: DataFrame, array: str, centres: Sequence[Sequence[float]]) -> DataFrame:
    """Add ``cluster`` and ``cost``: the nearest of a few given centres by squared distance."""
    costs = []
    for c, centre in enumerate(centres):
        spot = F.array(*(F.lit(float(x)) for x in centre))
        off = F.zip_with(F.col(array).cast("array<double>"), spot, lambda a, b: (a - b) * (a - b))
        cost = F.aggregate(off, F.lit(0.0), lambda acc, x: acc + x)
        costs.append(F.struct(cost.alias("cost"), F.lit(c).alias("cluster")))
    nearest = F.array_min(F.array(*costs)) if len(costs) > 1 else costs[0]
    return df.withColumn("_near", nearest).select(
        *df.columns, F.col("_near.cluster").alias("cluster"), F.col("_near.cost").alias("cost")
    )


def cluster_cost(assigned: DataFrame) -> DataFrame:
    """``cluster, n, cost``: sum of squared distances to the centre."""
    return assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("cost").alias("cost"))


def move_centres(assigned: DataFrame, array: str) -> DataFrame:
    """``cluster, dim, value, n``: the mean of every cluster, the update half of a k-means step."""
    slots = assigned.select("cluster", F.posexplode(F.col(array).cast("array<double>")).alias("dim", "x"))
    return slots.groupBy("cluster", "dim").agg(F.avg("x").alias("value"), F.count(F.lit(1)).alias("n"))
