"""Matrix factorization on indexed user and item ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit, TrainValidationSplitModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrec.functions.scalar import dot, total
from sitrec.operators.joins import lookup_join
from sitrec.storage import shared_folder

USER_I, ITEM_I = "useridI", "itemidI"

# The search grids.
GRID = {"regParam": (0.001, 0.01, 0.1, 1.0), "maxIter": (1, 10, 20), "rank": (1, 4, 8, 12)}
MANUAL_GRID = {"rank": (1, 5, 10), "regParam": (0.001, 0.01, 0.1), "maxIter": (5,)}


def als(
    rank: int = 10,
    reg: float = 0.1,
    iterations: int = 10,
    implicit: bool = False,
    nonnegative: bool = False,
    cold_start: str = "drop",
    checkpoint_interval: int = 2,
    seed: int = 0,
    blocks: int = 10,
) -> ALS:
    return ALS(
        rank=rank,
        regParam=reg,
        maxIter=iterations,
        implicitPrefs=implicit,
        nonnegative=nonnegative,
        coldStartStrategy=cold_start,
        checkpointInterval=checkpoint_interval,
        userCol=USER_I,
        itemCol=ITEM_I,
        ratingCol="rating",
        seed=seed,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
    )


def mean_pairs(ratings: DataFrame) -> DataFrame:
    """One row per user and item, the mean of its ratings.

    ALS holds all ratings of a user in one block.  Averaging first bounds a user to one row per item,
    at the price of giving repeated ratings the weight of one.
    """
    return ratings.groupBy(USER_I, ITEM_I).agg(F.avg("rating").alias("rating"))


BLOCK_ROWS = 4_000_000  # ratings of a block, about 100 MB in memory while it is sorted


def blocks_for(ratings: DataFrame) -> int:
    """Blocks of users and of items, so that a block holds ``BLOCK_ROWS`` ratings at most and every core has one.

    Every iteration sends a user's factors to each block that holds an item of the user, and the ratings are first dealt
    to all pairs of blocks.  Both grow with the number of blocks, so there are no more than memory asks for.
    """
    return max(10, ratings.sparkSession.sparkContext.defaultParallelism, -(-ratings.count() // BLOCK_ROWS))


def fit(ratings: DataFrame, **settings) -> ALSModel:
    shared_folder(ratings.sparkSession)
    return als(**{"blocks": blocks_for(ratings)} | settings).fit(ratings)


def save(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> ALSModel:
    return ALSModel.load(path)


def fit_grid(
    ratings: DataFrame,
    grid: dict[str, Sequence] = GRID,
    train_ratio: float = 0.8,
    parallelism: int = 2,
    seed: int = 0,
    **settings,
) -> TrainValidationSplitModel:
    """All grid points on one train/validation split; the best by RMSE is refitted on all rows.

    The ratings are worked out once: counted, split in two and refitted from the same kept rows.
    """
    shared_folder(ratings.sparkSession)
    kept = ratings.select(USER_I, ITEM_I, "rating").persist()
    try:
        estimator = als(**{"seed": seed, "blocks": blocks_for(kept)} | settings)
        points = ParamGridBuilder()
        for name, values in grid.items():
            points = points.addGrid(estimator.getParam(name), list(values))
        return TrainValidationSplit(
            estimator=estimator,
            estimatorParamMaps=points.build(),
            evaluator=RegressionEvaluator(metricName="rmse", labelCol="rating"),
            trainRatio=train_ratio,
            parallelism=parallelism,
            seed=seed,
        ).fit(kept)
    finally:
        kept.unpersist()


def factor_scores(
    pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame, spread: Column, output: str = "prediction"
) -> DataFrame:
    """Scores of (user, item) pairs from factor tables ``id, features``; pairs without factors are left out."""
    users = user_factors.select(F.col("id").alias(USER_I), F.col("features").alias("_uf"))
    items = item_factors.select(F.col("id").alias(ITEM_I), F.col("features").alias("_if"))
    kept = pairs.columns
    joined = lookup_join(pairs, users, USER_I, spread, how="inner")
    joined = lookup_join(joined, items, ITEM_I, spread, how="inner")
    return joined.select(*kept, dot(F.col("_uf"), F.col("_if")).alias(output))


def user_scores(
    items: DataFrame, user, user_factors: DataFrame, item_factors: DataFrame, rank: int
) -> DataFrame:
    """``itemidI, prediction`` of one user for the given items: the user's factors are one value."""
    vector = user_factors.filter(F.col("id") == user).select(F.col("features").cast("array<double>")).scalar()
    factors = item_factors.select(F.col("id").alias(ITEM_I), F.col("features").cast("array<double>").alias("_if"))
    beside = items.join(factors, ITEM_I).withColumn("_uf", vector)
    score = total([F.col("_if")[f] * F.col("_uf")[f] for f in range(rank)])
    return beside.select(*items.columns, score.alias("prediction")).filter(F.col("prediction").isNotNull())
