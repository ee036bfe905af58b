"""Factorization machine: scores, gradient, steps, training, search, saved models."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from sitrec.checks.base import (
    dictionary_and_model,
    query,
    ratings,
    row,
    scaled,
)
from sitrec.functions.scalar import rounded
from sitrec.models import search
from sitrec.models.fm import CLASSIFICATION, FMModel, gradient, l2_update, mean_loss, row_slopes, score_contextual, score_long
from sitrec.models.fm_fit import FMSettings, fm_train_lbfgs, fm_train_sgd
from sitrec.operators.encoding import ENCODED, encode, feature_dictionary
from sitrec.operators.relational import arithmetic_bucket
from sitrec.sources.features import long_features
from sitrec.storage import new_path, written

STEP = 0.1
REG = (0.01, 0.001, 0.0001)


def encoded(spark, sf_dir, dictionary):
    rows = encode(scaled(spark, sf_dir).select("row_id", "rating", *ENCODED), dictionary, row())
    return rows.select("row_id", F.col("rating").alias("label"), "idx", "val")


def six(df, *columns):
    return df.withColumns({c: rounded(F.col(c)) for c in columns})


@query("fm_score", "select row_id, round(prediction, 6) + 0.0 as prediction from scored", "scored")
def fm_score(spark, sf_dir):
    """Every row where it stands: one join per column."""
    dictionary, model = dictionary_and_model(spark, sf_dir)
    scored = score_contextual(ratings(spark, sf_dir), dictionary, model, row())
    return six(scored.select("row_id", "prediction"), "prediction")


@query("fm_score_long", "select row_id, round(prediction, 6) + 0.0 as prediction from scored", "scored")
def fm_score_long(spark, sf_dir):
    """The general form for sparse rows."""
    dictionary, model = dictionary_and_model(spark, sf_dir)
    long = long_features(encoded(spark, sf_dir, dictionary), "row_id", empty=True)
    return six(score_long(long, model), "prediction")


@query(
    "fm_score_clamped",
    """select row_id, round(least(1.0, greatest(-1.0, 0.05 + lin + pair * 6.25)), 6) + 0.0 as prediction from scored""",
    "scored",
)
def fm_score_clamped(spark, sf_dir):
    """Larger factors, so that many scores leave the label range."""
    dictionary, model = dictionary_and_model(spark, sf_dir, scale=100.0)
    scored = score_contextual(ratings(spark, sf_dir), dictionary, model, row())
    return six(scored.select("row_id", "prediction"), "prediction")


@query(
    "fm_score_classify",
    "select row_id, round(1 / (1 + exp(-raw)), 6) + 0.0 as prediction from scored",
    "scored",
)
def fm_score_classify(spark, sf_dir):
    dictionary, model = dictionary_and_model(spark, sf_dir, task=CLASSIFICATION)
    scored = score_contextual(ratings(spark, sf_dir), dictionary, model, row())
    return six(scored.select("row_id", "prediction"), "prediction")


@query("fm_model_roundtrip", "select row_id, round(prediction, 6) + 0.0 as prediction from scored", "scored")
def fm_model_roundtrip(spark, sf_dir):
    dictionary, model = dictionary_and_model(spark, sf_dir)
    path = new_path(spark, "fm-model")
    model.save(path)
    scored = score_contextual(ratings(spark, sf_dir), dictionary, FMModel.load(spark, path), row())
    return six(scored.select("row_id", "prediction"), "prediction")


def _slopes(spark, sf_dir):
    dictionary, model = dictionary_and_model(spark, sf_dir)
    long = written(long_features(encoded(spark, sf_dir, dictionary), "row_id", "label", empty=True), "long")
    return long, written(row_slopes(long, model), "slopes"), model


@query(
    "fm_loss",
    """select count(*) as n, round(avg((raw - rating) * (raw - rating) / 2), 6) + 0.0 as loss,
    round(avg(raw - rating), 6) + 0.0 as dw0 from scored""",
    "scored",
)
def fm_loss(spark, sf_dir):
    return six(mean_loss(_slopes(spark, sf_dir)[1]), "loss", "dw0")


_ERR = ", e as (select row_id, raw - rating as e from scored), nn as (select count(*) as n from scored)"
_DW = "select idx, sum(e) / any_value(n) as dw from feat join e using (row_id), nn group by idx"
_DV = """select feat.idx, fv.f, sum(e * (s - v)) / any_value(n) as dv from feat join e on e.row_id = feat.row_id
  join fv on fv.idx = feat.idx join sums on sums.row_id = feat.row_id and sums.f = fv.f, nn group by feat.idx, fv.f"""
_V = range(8)


@query(
    "fm_gradient",
    f"""{_ERR}, gw as ({_DW}), gv as ({_DV})
    select idx, round(any_value(dw), 6) + 0.0 as dw,
      {", ".join(f"round(sum(dv) filter (where f = {f}), 6) + 0.0 as dv{f}" for f in _V)}
    from gw join gv using (idx) group by idx""",
    "scored feat fv sums",
)
def fm_gradient(spark, sf_dir):
    long, slopes, model = _slopes(spark, sf_dir)
    return six(gradient(long, slopes, model, slopes.count()), "dw", *(f"d{v}" for v in model.v))


_STEPPED = f"""{_ERR}, gw as ({_DW}), gv as ({_DV}),
  nw as (select idx, w - {STEP} * (dw + {REG[1]} * w) as w from fw join gw using (idx)),
  nv as (select idx, f, v - {STEP} * (dv + {REG[2]} * v) as v from fv join gv using (idx, f)),
  nb as (select 0.05::double - {STEP} * (avg(e) + {REG[0]} * 0.05) as w0 from e)"""


@query(
    "fm_l2_update",
    f"""{_STEPPED} select round(({REG[0]} * (select w0 * w0 from nb) + {REG[1]} * (select sum(w * w) from nw)
      + {REG[2]} * (select sum(v * v) from nv)) / 2, 6) + 0.0 as penalty""",
    "scored feat fv fw sums",
)
def fm_l2_update(spark, sf_dir):
    """Half the weighted squares after one step."""
    long, slopes, model = _slopes(spark, sf_dir)
    seen = mean_loss(slopes).first()
    _, penalty = l2_update(model, gradient(long, slopes, model, seen["n"]), seen["dw0"], STEP, reg=REG)
    return six(penalty, "penalty")


@query(
    "fm_sgd_step",
    f"""{_STEPPED} select idx, round(any_value(w), 6) + 0.0 as w,
      {", ".join(f"round(sum(v) filter (where f = {f}), 6) + 0.0 as v{f}" for f in _V)}
    from nw join nv using (idx) group by idx
    union all select -1, round(w0, 6) + 0.0, {", ".join("0.0" for _ in _V)} from nb""",
    "scored feat fv fw sums",
)
def fm_sgd_step(spark, sf_dir):
    """One full-batch descent step from the fixed parameters; the intercept has index -1."""
    long, slopes, model = _slopes(spark, sf_dir)
    seen = mean_loss(slopes).first()
    moved, _ = l2_update(model, gradient(long, slopes, model, seen["n"]), seen["dw0"], STEP, reg=REG)
    bias = mean_loss(slopes).select(
        F.lit(-1).cast("bigint").alias("idx"), F.lit(moved.intercept).alias("w"), *(F.lit(0.0).alias(v) for v in model.v)
    )
    return six(moved.factors.unionByName(bias), "w", *model.v)


# ---- training ----------------------------------------------------------------------------------


def _train(spark, sf_dir, fit, settings=FMSettings()):
    dictionary = feature_dictionary(ratings(spark, sf_dir))
    rows = encoded(spark, sf_dir, dictionary)
    model = fit(rows, dictionary.count(), settings)
    scored = score_contextual(scaled(spark, sf_dir), dictionary, model, row())
    return scored.select("row_id", F.col("rating").alias("label"), "prediction")


@query("fm_lbfgs")
def fm_lbfgs(spark, sf_dir):
    return _train(spark, sf_dir, fm_train_lbfgs, FMSettings(init_std=0.1, reg=(0.0, 0.01, 0.01)))


@query("fm_lbfgs_quality", "select count(*) as n, true as inside, true as better from resc", "resc")
def fm_lbfgs_quality(spark, sf_dir):
    """Every row is predicted inside the label range, and better than by the mean rating."""
    scored = fm_lbfgs(spark, sf_dir)
    inside = F.min(F.col("prediction").between(-1.0, 1.0))
    error = F.avg(F.pow(F.col("prediction") - F.col("label"), F.lit(2.0)))
    return scored.agg(
        F.count("prediction").alias("n"), inside.alias("inside"), (error < F.var_pop("label")).alias("better")
    )


@query("fm_lbfgs_table")
def fm_lbfgs_table(spark, sf_dir):
    """The form for parameters that do not fit one machine: the whole fit, to the tolerance or 100 iterations."""

    def fit(rows, n, settings):
        return fm_train_lbfgs(rows, n, settings, compact_bytes=0)

    return _train(spark, sf_dir, fit)


@query("fm_sgd")
def fm_sgd(spark, sf_dir):
    return _train(spark, sf_dir, fm_train_sgd, FMSettings(iterations=20))


@query("fm_classify")
def fm_classify(spark, sf_dir):
    return _train(spark, sf_dir, fm_train_lbfgs, FMSettings(task=CLASSIFICATION, init_std=0.1, reg=(0.0, 0.01, 0.01)))


# ---- search ------------------------------------------------------------------------------------

# Grid of the deterministic search, parts of the score switched and scaled.
PARTS = {"global_bias": (True, False), "one_way": (True, False), "init_std": (0.01, 0.1, 1.0)}


def _part_errors(spark, sf_dir):
    """Squared errors of every row under every grid point: rows are scored once, points are columns."""
    dictionary, model = dictionary_and_model(spark, sf_dir)
    scored = score_contextual(scaled(spark, sf_dir), dictionary, model, row(), parts=True)
    pair = F.col("raw") - F.lit(model.intercept) - F.col("lin")
    rows = scored.select(
        "rating",
        "lin",
        pair.alias("pair"),
        arithmetic_bucket(row(), buckets=2).alias("fold"),
        F.explode(search.grid_column(PARTS)).alias("p"),
    )
    on = F.when(F.col("p.global_bias"), model.intercept).otherwise(0.0)
    on = on + F.when(F.col("p.one_way"), F.col("lin")).otherwise(0.0)
    raw = on + F.col("pair") * F.col("p.init_std") * F.col("p.init_std")
    error = F.pow(F.greatest(F.least(raw, F.lit(1.0)), F.lit(-1.0)) - F.col("rating"), F.lit(2.0))
    return rows.select("fold", "p.*", error.alias("error"))


_ERRORS = """, points as (select unnest([true, false]) as global_bias),
  grid as (select global_bias, one_way, init_std from points,
    (select unnest([true, false]) as one_way), (select unnest([0.01, 0.1, 1.0])::double as init_std)),
  errors as (select (row_id * 7) % 2 as fold, global_bias, one_way, init_std,
    pow(least(1.0, greatest(-1.0, case when global_bias then 0.05 else 0 end + case when one_way then lin else 0 end
      + pair * init_std * init_std)) - rating, 2) as error from scored, grid),
  points_rmse as (select fold, global_bias, one_way, init_std, sqrt(avg(error)) as rmse from errors group by all)"""


@query(
    "param_grid",
    f"{_ERRORS} select fold::int as fold, global_bias, one_way, init_std, round(rmse, 6) + 0.0 as rmse from points_rmse",
    "scored",
)
def param_grid(spark, sf_dir):
    names = list(PARTS)
    results = _part_errors(spark, sf_dir).groupBy("fold", *names).agg(F.sqrt(F.avg("error")).alias("rmse"))
    return six(results.withColumn("fold", F.col("fold").cast("int")), "rmse")


@query(
    "search_best",
    f"""{_ERRORS}, m as (select global_bias, one_way, init_std, avg(rmse) as mean, min(rmse) as low
      from points_rmse group by all)
    select 'mean' as choice, arg_min(global_bias, mean) as global_bias, arg_min(one_way, mean) as one_way,
      arg_min(init_std, mean) as init_std, round(min(mean), 6) + 0.0 as rmse from m
    union all select 'min_fold', arg_min(global_bias, low), arg_min(one_way, low), arg_min(init_std, low),
      round(min(low), 6) + 0.0 from m""",
    "scored",
)
def search_best(spark, sf_dir):
    names = list(PARTS)
    results = _part_errors(spark, sf_dir).groupBy("fold", *names).agg(F.sqrt(F.avg("error")).alias("rmse"))
    best = [
        search.best(results, choice, names).select(F.lit(choice).alias("choice"), *names, "rmse")
        for choice in ("mean", "min_fold")
    ]
    return six(best[0].unionByName(best[1]), "rmse")


# The staged run has a whole search as one of its steps; two points keep it short.
STAGED_GRID = search.FM_GRID | {
    "iterations": (20,),
    "global_bias": (True,),
    "one_way": (True,),
    "reg_intercept": (0.0,),
    "reg_one_way": (0.0,),
    "reg_pairwise": (0.0, 0.1),
    "init_std": (0.1,),
}


@query("fm_search")
def fm_search(spark, sf_dir):
    """The whole design grid, 324 points on two folds."""
    dictionary = feature_dictionary(ratings(spark, sf_dir))
    return search.fm_search(encoded(spark, sf_dir, dictionary), dictionary.count())


@query(
    "params_roundtrip",
    f"""{_ERRORS}, m as (select global_bias, one_way, init_std, avg(rmse) as mean from points_rmse group by all)
    select arg_min(global_bias, mean) as global_bias, arg_min(one_way, mean) as one_way,
      arg_min(init_std, mean) as init_std from m""",
    "scored",
)
def params_roundtrip(spark, sf_dir):
    """The best point of the search, stored and read back typed."""
    names = list(PARTS)
    results = _part_errors(spark, sf_dir).groupBy("fold", *names).agg(F.sqrt(F.avg("error")).alias("rmse"))
    won = search.best(results, "mean", names).first()
    settings = replace(FMSettings(), dim=(won["global_bias"], won["one_way"], 8), init_std=won["init_std"])
    path = new_path(spark, "params")
    search.save_params(spark, settings, path)
    if search.load_params(spark, path) != settings:
        raise ValueError("parameters changed on the way through storage")
    return spark.read.schema(search.PARAMS).json(path).select(*names)
