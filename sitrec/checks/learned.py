"""ALS, the smaller learners, and evaluation."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sitrec.checks.base import CONTEXT, CONTEXT_VALUES, dictionary_and_model, fine, fixed_factors, query, ratings, row, scaled
from sitrec.functions.scalar import rounded
from sitrec.models import als, evaluate, learners, search
from sitrec.models.fm import score_contextual
from sitrec.operators import relational as ops
from sitrec.operators.encoding import assemble
from sitrec.operators.vectors import as_vector
from sitrec.plans.recommend import indexed_ratings
from sitrec.sources import tables
from sitrec.storage import new_path


def six(df, *columns):
    return df.withColumns({c: rounded(F.col(c)) for c in columns})


# ---- ALS ---------------------------------------------------------------------------------------


def _als_split(spark, sf_dir):
    coded, users, items = indexed_ratings(scaled(spark, sf_dir), row())
    split = ops.hash_split(coded.select("row_id", als.USER_I, als.ITEM_I, "rating"), {"train": 0.8, "test": 0.2}, "row_id")
    return split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test")


def _als_test(spark, sf_dir, **settings):
    train, test = _als_split(spark, sf_dir)
    return als.fit(train, **settings).transform(test).select("row_id", "rating", "prediction")


@query("als_fit")
def als_fit(spark, sf_dir):
    return _als_test(spark, sf_dir, rank=4, iterations=5)


@query("als_quality", "select count(*) as n, true as better from resc", "resc")
def als_quality(spark, sf_dir):
    """Fitted on all ratings, every row is predicted, and better than by the mean rating."""
    coded, _, _ = indexed_ratings(scaled(spark, sf_dir), row())
    coded = coded.select(als.USER_I, als.ITEM_I, "rating")
    scored = als.fit(coded, rank=8, iterations=8, reg=0.05).transform(coded)
    error = F.avg(F.pow(F.col("prediction") - F.col("rating"), F.lit(2.0)))
    return scored.agg(F.count("prediction").alias("n"), (error < F.var_pop("rating")).alias("better"))


@query("als_nonnegative")
def als_nonnegative(spark, sf_dir):
    return _als_test(spark, sf_dir, rank=4, iterations=3, nonnegative=True)


@query("als_implicit")
def als_implicit(spark, sf_dir):
    return _als_test(spark, sf_dir, rank=4, iterations=3, implicit=True)


@query("als_model_roundtrip")
def als_model_roundtrip(spark, sf_dir):
    train, test = _als_split(spark, sf_dir)
    path = new_path(spark, "als-model")
    als.save(als.fit(train, rank=2, iterations=2), path)
    return als.load(path).transform(test).select("row_id", "rating", "prediction")


@query("als_recommend_all")
def als_recommend_all(spark, sf_dir):
    train, _ = _als_split(spark, sf_dir)
    return als.fit(train, rank=4, iterations=3).recommendForAllUsers(5)


@query("als_recommend_items")
def als_recommend_items(spark, sf_dir):
    train, _ = _als_split(spark, sf_dir)
    return als.fit(train, rank=4, iterations=3).recommendForAllItems(5)


@query("als_recommend_subset")
def als_recommend_subset(spark, sf_dir):
    """Lists for the users who rated in the example context."""
    df = scaled(spark, sf_dir)
    coded, _, _ = indexed_ratings(df, row())
    model = als.fit(coded.select(als.USER_I, als.ITEM_I, "rating"), rank=4, iterations=3)
    chosen = ops.context_filter(coded, CONTEXT).select(als.USER_I).distinct()
    return model.recommendForUserSubset(chosen, 5)


@query("als_tvs")
def als_tvs(spark, sf_dir):
    train, test = _als_split(spark, sf_dir)
    fitted = als.fit_grid(train, nonnegative=True, parallelism=4)
    return fitted.bestModel.transform(test).select("row_id", "rating", "prediction")


@query("als_search")
def als_search(spark, sf_dir):
    return search.als_search(*_als_split(spark, sf_dir))


@query("factor_dot", "select userid, itemid, round(prediction, 6) + 0.0 as prediction from pairs", "pairs")
def factor_dot(spark, sf_dir):
    return six(_pair_scores(spark, sf_dir), "prediction")


def _pair_scores(spark, sf_dir):
    df = fine(spark, sf_dir)
    factors = fixed_factors(df)
    pairs = df.select("userid", "itemid").distinct()
    users = factors.users.join(factors.user_factors, F.col("idx") == F.col("id"))
    items = factors.items.join(factors.item_factors, F.col("idx") == F.col("id"))
    # ids and factors are both one row per name, so the name can stand for the id
    by_name = als.factor_scores(
        pairs.select(F.col("userid").alias(als.USER_I), F.col("itemid").alias(als.ITEM_I)),
        users.select(F.col("userid").alias("id"), "features"),
        items.select(F.col("itemid").alias("id"), "features"),
        F.hash(als.USER_I, als.ITEM_I),
    )
    return by_name.select(F.col(als.USER_I).alias("userid"), F.col(als.ITEM_I).alias("itemid"), "prediction")


# ---- regression and classification -------------------------------------------------------------


@query(
    "linreg_simple",
    """select round(regr_slope(rating, value), 6) + 0.0 as slope,
    round(regr_intercept(rating, value), 6) + 0.0 as intercept from rat""",
    "rat",
)
def linreg_simple(spark, sf_dir):
    df = tables.contextual_ratings(spark, sf_dir).select(F.col("rating").alias("label"), "value")
    model = learners.linear_regression(assemble(df, ["value"]))
    rows = [(float(model.coefficients[0]), float(model.intercept))]
    return six(spark.createDataFrame(rows, "slope double, intercept double"), "slope", "intercept")


def _context_vectors(spark, sf_dir):
    df = ratings(spark, sf_dir)
    flags = ops.pivot_values(df, CONTEXT_VALUES, ["row_id", "rating"])
    names = [c for c in flags.columns if c not in ("row_id", "rating")]
    vectors = assemble(flags, names).select("row_id", (F.col("rating") - 1).alias("label"), "features")
    return vectors, names


@query("linreg_grid")
def linreg_grid(spark, sf_dir):
    vectors, _ = _context_vectors(spark, sf_dir)
    model = learners.linear_regression_grid(vectors).bestModel
    return model.transform(vectors).select("row_id", "label", "prediction")


@query("logreg")
def logreg(spark, sf_dir):
    vectors, _ = _context_vectors(spark, sf_dir)
    model = learners.logistic_regression(vectors, iterations=20, reg=0.1, elastic_net=0.3)
    return model.transform(vectors).select("row_id", "label", "prediction")


_CONTEXT_FLAGS = " union all ".join(
    f"""select row_id, rating - 1 as label, '{c}_' || "{c}" as feature from rat""" for c in ("Time", "Location", "Companion")
)


@query(
    "naive_bayes_params",
    f""", f as ({_CONTEXT_FLAGS}), names as (select distinct feature from f),
    classes as (select rating - 1 as label, count(*) as n from rat group by rating),
    hits as (select label, feature, count(*) as s from f group by label, feature),
    sums as (select label, sum(s) as s from hits group by label)
    select c.label, names.feature,
      round(ln((coalesce(h.s, 0) + 1) / (sums.s + (select count(*) from names))), 6) + 0.0 as theta,
      round(ln((c.n + 1) / ((select sum(n) from classes) + (select count(*) from classes))), 6) + 0.0 as pi
    from classes c join sums on sums.label = c.label cross join names
    left join hits h on h.label = c.label and h.feature = names.feature""",
    "rat",
)
def naive_bayes_params(spark, sf_dir):
    """Log priors and conditionals: classes times context values, a small table."""
    vectors, names = _context_vectors(spark, sf_dir)
    model = learners.naive_bayes(vectors)
    theta, pi = model.theta.toArray(), model.pi.toArray()
    rows = [(float(c), n, float(theta[c, j]), float(pi[c])) for c in range(len(pi)) for j, n in enumerate(names)]
    return six(spark.createDataFrame(rows, "label double, feature string, theta double, pi double"), "theta", "pi")


# ---- clusters ----------------------------------------------------------------------------------

DIMS = 64
CENTRES = [[((d * 7 + c * 13) % 11 - 5) / 50.0 for d in range(DIMS)] for c in range(2)]


@query("kmeans")
def kmeans(spark, sf_dir):
    df = as_vector(tables.table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding")
    return learners.k_means(df).transform(df).select("vec_id", "cluster")


@query(
    "kmeans_step",
    """, d as (select vec_id, c, sum(pow(x - ((dim * 7 + c * 13) % 11 - 5) / 50.0, 2)) as cost
      from emb, (select unnest([0, 1]) as c) group by vec_id, c),
    a as (select vec_id, arg_min(c, cost) as cluster from d group by vec_id)
    select cluster::int as cluster, dim::int as dim, round(avg(x), 6) + 0.0 as value, count(*) as n
    from emb join a using (vec_id) group by cluster, dim""",
    "emb",
)
def kmeans_step(spark, sf_dir):
    df = tables.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return six(learners.move_centres(learners.assign_clusters(df, "embedding", CENTRES), "embedding"), "value")


@query(
    "kmeans_cost",
    """, d as (select vec_id, c, sum(pow(x - ((dim * 7 + c * 13) % 11 - 5) / 50.0, 2)) as cost
      from emb, (select unnest([0, 1]) as c) group by vec_id, c),
    a as (select vec_id, arg_min(c, cost) as cluster, min(cost) as cost from d group by vec_id)
    select cluster::int as cluster, count(*) as n, round(sum(cost), 6) + 0.0 as cost from a group by cluster""",
    "emb",
)
def kmeans_cost(spark, sf_dir):
    df = tables.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return six(learners.cluster_cost(learners.assign_clusters(df, "embedding", CENTRES)), "cost")


# ---- evaluation --------------------------------------------------------------------------------


def _scored(spark, sf_dir):
    dictionary, model = dictionary_and_model(spark, sf_dir)
    return score_contextual(scaled(spark, sf_dir), dictionary, model, row())


def _split(spark, sf_dir):
    return ops.modulo_split(ops.rescale_ratings(tables.contextual_ratings(spark, sf_dir)), "ts_s")


@query(
    "rmse",
    "select round(sqrt(avg(pow(rating - prediction, 2))), 6) + 0.0 as rmse, count(*) as n, 0::bigint as dropped from scored",
    "scored",
)
def rmse(spark, sf_dir):
    return six(evaluate.rmse(_scored(spark, sf_dir)), "rmse")


@query(
    "rmse_joined",
    """, j5 as (select pow(prediction - rating, 2) as e from pairs join resc5 using (userid, itemid)
      where round(prediction, 9) > 0)
    select 'matched' as denominator, round(sqrt(avg(e)), 6) + 0.0 as rmse, count(*) as matched from j5
    union all select 'all', round(sqrt(sum(e) / (select count(*) from resc5)), 6) + 0.0, count(*) from j5""",
    "pairs resc5",
)
def rmse_joined(spark, sf_dir):
    """Predictions exist only for pairs with a positive score, so the two denominators differ."""
    truth = ops.rescale_ratings(fine(spark, sf_dir)).select("userid", "itemid", "rating")
    known = _pair_scores(spark, sf_dir).filter(F.round("prediction", 9) > 0)
    return six(evaluate.rmses_joined(known, truth), "rmse")


@query(
    "baseline_rmse",
    """, m as (select avg(rating) filter (where split = 'train') as a,
      avg(rating) filter (where split <> 'test') as b from split)
    select 'train' as mean_of, round(any_value(a), 6) + 0.0 as mean_rating,
      round(sqrt(avg(pow(rating - a, 2))), 6) + 0.0 as baseline_rmse from split, m where split = 'test'
    union all select 'train+validation', round(any_value(b), 6) + 0.0,
      round(sqrt(avg(pow(rating - b, 2))), 6) + 0.0 from split, m where split = 'test'""",
    "split",
)
def baseline_rmse(spark, sf_dir):
    df = _split(spark, sf_dir).select("split", "rating")
    test = df.filter(F.col("split") == "test")
    means = {"train": df.filter(F.col("split") == "train"), "train+validation": df.filter(F.col("split") != "test")}
    parts = [
        evaluate.baseline(of, test).select(F.lit(name).alias("mean_of"), "mean_rating", "baseline_rmse")
        for name, of in means.items()
    ]
    return six(parts[0].unionByName(parts[1]), "mean_rating", "baseline_rmse")


@query(
    "eval_report",
    """, s as (select sc.*, sp.split from scored sc join split sp using (row_id)),
    m as (select avg(rating) as mean_rating from s where split = 'train'),
    r as (select any_value(mean_rating) as mean_rating, sqrt(avg(pow(rating - mean_rating, 2))) as baseline_rmse,
      sqrt(avg(pow(rating - prediction, 2))) as rmse from s, m where split = 'test'),
    t as (select *, (baseline_rmse - rmse) / baseline_rmse * 100 as improvement from r)
    select round(mean_rating, 6) + 0.0 as mean_rating, round(baseline_rmse, 6) + 0.0 as baseline_rmse,
      round(rmse, 6) + 0.0 as rmse, round(improvement, 6) + 0.0 as improvement,
      printf('mean rating %.3f, baseline RMSE %.3f, model RMSE %.3f, improvement %1.2f',
        mean_rating, baseline_rmse, rmse, improvement) as report from t""",
    "scored split",
)
def eval_report(spark, sf_dir):
    dictionary, model = dictionary_and_model(spark, sf_dir)
    train, test = (_split(spark, sf_dir).filter(F.col("split") == s) for s in ("train", "test"))
    scored = score_contextual(test, dictionary, model, row()).select("rating", "prediction")
    return six(evaluate.report(train, scored), "mean_rating", "baseline_rmse", "rmse", "improvement")


@query(
    "rounded_accuracy",
    "select round(avg((round(rating) = round(prediction))::int), 6) + 0.0 as accuracy from scored",
    "scored",
)
def rounded_accuracy(spark, sf_dir):
    return six(evaluate.rounded_accuracy(_scored(spark, sf_dir)), "accuracy")


def _classes(spark, sf_dir):
    df = _scored(spark, sf_dir)
    return df.select(
        F.round("rating").cast("int").alias("label"), F.round(F.col("prediction") * 3).cast("int").alias("prediction")
    )


_CONFUSION = """, cm as (select round(rating)::int as label, round(prediction * 3)::int as predicted, count(*) as n
  from scored group by all)"""


@query("confusion", f"{_CONFUSION} select label, predicted, n from cm", "scored")
def confusion(spark, sf_dir):
    return evaluate.confusion(_classes(spark, sf_dir))


@query(
    "multiclass_metrics",
    f"""{_CONFUSION}, c as (select label as c from cm union select predicted from cm),
    p as (select c.c, coalesce((select sum(n) from cm where label = c.c), 0) as actual,
      coalesce((select sum(n) from cm where predicted = c.c), 0) as claimed,
      coalesce((select sum(n) from cm where predicted = c.c and label = c.c), 0) as hit from c)
    select round(sum(hit) / sum(actual), 6) + 0.0 as accuracy,
      round(sum(coalesce(hit / nullif(actual, 0), 0) * actual) / sum(actual), 6) + 0.0 as recall,
      round(sum(coalesce(hit / nullif(claimed, 0), 0) * actual) / sum(actual), 6) + 0.0 as precision,
      round(sum(2 * hit / (actual + claimed) * actual) / sum(actual), 6) + 0.0 as f_measure from p""",
    "scored",
)
def multiclass_metrics(spark, sf_dir):
    metrics = evaluate.multiclass_metrics(evaluate.confusion(_classes(spark, sf_dir)))
    return six(metrics, "accuracy", "recall", "precision", "f_measure")


@query(
    "auc",
    """, s as (select round(prediction, 6) as score, rating > 0 as pos from scored),
    k as (select pos, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0 as r from s)
    select round((sum(r) filter (where pos) - count(*) filter (where pos) * (count(*) filter (where pos) + 1) / 2)
      / (count(*) filter (where pos) * count(*) filter (where not pos)), 6) + 0.0 as auc from k""",
    "scored",
)
def auc(spark, sf_dir):
    df = _scored(spark, sf_dir).withColumn("prediction", rounded(F.col("prediction")))
    return six(evaluate.auc(df, F.col("rating") > 0, "prediction"), "auc")


@query(
    "residuals",
    """select row_id, rating as label, round(prediction, 6) + 0.0 as prediction,
    round(abs(rating - prediction), 6) + 0.0 as delta from scored""",
    "scored",
)
def residuals(spark, sf_dir):
    return six(evaluate.residuals(_scored(spark, sf_dir), "row_id"), "prediction", "delta")
