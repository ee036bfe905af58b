"""The batch run in four steps, with tables between them: prepare, design, train, predict.

Every step writes new tables and then, as its last act, a line to the run's manifest that names the tables that
belong together.  A step that fails leaves no line, so what was served before is served on; lists are made from the
dictionary that the model was trained with, whatever has been prepared since.  Design and train return what is
there if they are asked for the same once more.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from sitrec.models.fm import FMModel
from sitrec.models.fm_fit import FMSettings, fm_train_lbfgs
from sitrec.models.search import FM_GRID, best, fm_search, fm_settings, load_params, save_params, settings_row
from sitrec.operators.encoding import ENCODED, encode, feature_dictionary
from sitrec.operators.relational import rescale_ratings
from sitrec.plans.recommend import recommend_by_model
from sitrec.sources.features import load_table, save_table

MANIFEST = "version bigint, stage string, made_from string, tables map<string, string>"
MADE_BY = {"dictionary": "prepare", "features": "prepare", "search": "design", "params": "design", "model": "train"}


def commits(spark: SparkSession, path: str) -> DataFrame:
    """A row for every finished step of the run; none if there is no run yet."""
    try:
        return spark.read.schema(MANIFEST).json(f"{path}/manifest")
    except AnalysisException as gone:
        if gone.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def newest(spark: SparkSession, path: str, stage: str) -> Row | None:
    """The last finished ``stage``."""
    return commits(spark, path).where(F.col("stage") == stage).orderBy(F.desc("version"), "made_from").first()


def place(spark: SparkSession, path: str, name: str) -> str:
    """Path of the table that the last finished step of its kind has made."""
    return _last(spark, path, MADE_BY[name])[name]


def _last(spark: SparkSession, path: str, stage: str) -> dict[str, str]:
    found = newest(spark, path, stage)
    if found is None:
        raise ValueError(f"{path}: {stage} has not finished yet")
    return dict(found["tables"])


def run_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return load_table(spark, place(spark, path, name))


def _new(path: str, name: str) -> str:
    return f"{path}/{name}-{uuid.uuid4().hex}"


def _commit(spark: SparkSession, path: str, stage: str, made_from: str, tables: Mapping[str, str]) -> None:
    last = commits(spark, path).agg(F.max("version")).first()[0] or 0
    line = spark.createDataFrame([(last + 1, stage, made_from, dict(tables))], MANIFEST)
    line.coalesce(1).write.mode("append").json(f"{path}/manifest")


def prepare(ratings: DataFrame, path: str, row_id: str = "row_id", columns: Sequence[str] = ENCODED) -> None:
    """Rescaled ratings as feature rows, and the feature dictionary."""
    spark = ratings.sparkSession
    scaled = rescale_ratings(ratings)
    tables = {name: _new(path, name) for name in ("dictionary", "features")}
    save_table(feature_dictionary(scaled, columns), tables["dictionary"])
    dictionary = load_table(spark, tables["dictionary"])
    rows = encode(scaled.select(row_id, "rating", *columns), dictionary, F.col(row_id), columns)
    save_table(rows.select(F.col(row_id).alias("row_id"), F.col("rating").alias("label"), "idx", "val", *columns), tables["features"])
    _commit(spark, path, "prepare", "", tables)


def design(
    spark: SparkSession, path: str, grid: Mapping[str, Sequence] = FM_GRID, folds: int = 2, select: str = "mean"
) -> DataFrame:
    """Search the grid over the last prepared rows, keep the results and store the best parameters."""
    base = _last(spark, path, "prepare")
    features, dictionary = base["features"], base["dictionary"]
    made_from = json.dumps([features, {k: list(v) for k, v in grid.items()}, folds, select], sort_keys=True)
    done = newest(spark, path, "design")
    if done is not None and done["made_from"] == made_from:
        return load_table(spark, done["tables"]["search"])
    tables = {name: _new(path, name) for name in ("search", "params")}
    rows = load_table(spark, features).select("row_id", "label", "idx", "val")
    save_table(fm_search(rows, load_table(spark, dictionary).count(), grid, folds), tables["search"])
    results = load_table(spark, tables["search"])
    winner = best(results, select).select(F.from_json("params", GRID_POINT).alias("p")).first()
    if winner is None:
        raise ValueError("no grid point gave an error measure")
    save_params(spark, fm_settings(winner["p"].asDict()), tables["params"])
    _commit(spark, path, "design", made_from, base | tables)
    return results


# The names and types of one grid point.
GRID_POINT = (
    "iterations int, global_bias boolean, one_way boolean, factors int, reg_intercept double, "
    "reg_one_way double, reg_pairwise double, init_std double"
)


def train(spark: SparkSession, path: str, settings: FMSettings | None = None) -> FMModel:
    """Fit the last prepared rows with the stored (or given) parameters and serve the model from then on."""
    settings = settings or load_params(spark, place(spark, path, "params"))
    tables = _last(spark, path, "prepare")
    made_from = json.dumps([tables["features"], settings_row(settings)], sort_keys=True)
    done = newest(spark, path, "train")
    if done is not None and done["made_from"] == made_from:
        return FMModel.load(spark, done["tables"]["model"])
    tables["model"] = _new(path, "model")
    rows = load_table(spark, tables["features"]).select("label", "idx", "val")
    fm_train_lbfgs(rows, load_table(spark, tables["dictionary"]).count(), settings).save(tables["model"])
    model = FMModel.load(spark, tables["model"])
    _commit(spark, path, "train", made_from, tables)
    return model


def predict(spark: SparkSession, path: str, user: str, context: Mapping[str, str]) -> DataFrame:
    """Recommendations from the last trained model and the dictionary it was trained with."""
    served = _last(spark, path, "train")
    return recommend_by_model(load_table(spark, served["dictionary"]), FMModel.load(spark, served["model"]), user, context)
