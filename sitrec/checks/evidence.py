"""Facts about learned models that SQL can state: optimum conditions, contents of lists, errors on held-out rows.

Held-out errors are measured on planted labels, the scores of a fixed model, as the ratings of the test tables
are random.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from sitrec.checks.base import (
    CONTEXT,
    USER_ID,
    dictionary_and_model,
    fine,
    fixed_model,
    query,
    ratings,
    row,
    scaled,
    spot_split,
)
from sitrec.checks.feature import _embeddings, _vectors, _words
from sitrec.checks.learned import _CONTEXT_FLAGS, _context_vectors
from sitrec.checks.machine import STAGED_GRID, encoded
from sitrec.functions.scalar import rounded
from sitrec.models import als, evaluate, learners, search
from sitrec.models.fm import CLASSIFICATION, mean_loss, row_slopes, score_contextual
from sitrec.models.fm_fit import FMSettings, fm_train_lbfgs, fm_train_sgd
from sitrec.operators import relational as ops
from sitrec.operators import text, vectors
from sitrec.operators.encoding import ENCODED, encode, feature_dictionary
from sitrec.operators.joins import hot_of_counts, lookup_join
from sitrec.plans import recommend, stages
from sitrec.sources.features import load_table, long_features
from sitrec.storage import new_path, written

SHARES = {"train": 0.8, "test": 0.2}


# ---- vectors and text --------------------------------------------------------------------------


@query("pca_axes", "select a.i, b.i as j, (a.i = b.i)::int::double as dot, 0.0::double as gap from range(3) a(i), range(3) b(i)")
def pca_axes(spark, sf_dir):
    """The axes are orthonormal, and the covariance matrix only stretches each of them."""
    axes = vectors.fit_pca(_vectors(spark, sf_dir), 3).pc.toArray()
    cov = np.zeros((len(axes), len(axes)))
    for r in vectors.covariance(_embeddings(spark, sf_dir), "embedding").collect():  # a row per pair of slots
        cov[r.i, r.j] = cov[r.j, r.i] = r.covariance
    dots, moved = axes.T @ axes, cov @ axes
    gaps = moved - axes * (axes * moved).sum(axis=0)
    rows = [(i, j, abs(round(float(dots[i, j]), 6)), round(float(np.abs(gaps[:, i]).max()), 6)) for i in range(3) for j in range(3)]
    return spark.createDataFrame(rows, "i bigint, j bigint, dot double, gap double")


@query(
    "covariance_shifted",
    """, far as (select vec_id, dim, x + (dim % 3) * 1e9 as x from emb where dim < 6)
    select a.dim::int as i, b.dim::int as j, round(covar_samp(a.x, b.x), 4) + 0.0 as covariance
    from far a join far b on a.vec_id = b.vec_id and a.dim <= b.dim group by a.dim, b.dim""",
    "emb",
)
def covariance_shifted(spark, sf_dir):
    """Columns far from zero."""
    moved = F.transform(F.slice("embedding", 1, 6), lambda x, i: x.cast("double") + (i % 3) * F.lit(1e9))
    df = vectors.covariance(_embeddings(spark, sf_dir).select(moved.alias("a")), "a")
    return df.withColumn("covariance", rounded(F.col("covariance"), 4))


@query("word2vec_mean", "select doc_id, count(*) as n, 0.0::double as gap from tok group by doc_id", "tok")
def word2vec_mean(spark, sf_dir):
    """A text's vector is the mean of the vectors of its words."""
    df = _words(spark, sf_dir)
    model = text.fit_word2vec(df, size=3, min_count=0)
    made = model.transform(df).select("doc_id", vector_to_array("vector").alias("v"))
    words = model.getVectors().select(F.col("word").alias("term"), vector_to_array("vector").alias("w"))
    held = lookup_join(
        text.term_counts(df, "doc_id"), words, "term", F.col("doc_id"), how="inner",
        hot=lambda: hot_of_counts(model.table, "term", "n"), task_bytes=text.VOCABULARY_BYTES,
    )
    sums = held.groupBy("doc_id").agg(
        F.sum("tf").alias("n"), *(F.sum(F.col("tf") * F.col("w")[i]).alias(f"s{i}") for i in range(3))
    )
    gap = F.greatest(*(F.abs(F.col(f"s{i}") / F.col("n") - F.col("v")[i]) for i in range(3)))
    return sums.join(made, "doc_id").select("doc_id", "n", rounded(gap).alias("gap"))


# ---- factor models -----------------------------------------------------------------------------

_PLANTED = f""", p as (select userid, itemid, {spot_split("'5:' || userid || ':' || itemid", train=800000)} as split
    from (select distinct userid, itemid from rat)),
  seen as (select * from p where split = 'test' and userid in (select userid from p where split = 'train')
    and itemid in (select itemid from p where split = 'train'))"""


def _planted(spark, sf_dir):
    """Ratings that one factor explains, for the pairs of the table, split by user and item, with indexes."""
    taste, appeal = (F.pmod(F.col(c).cast("int"), F.lit(m)) + 1 for c, m in (("userid", 7), ("itemid", 5)))
    df = ratings(spark, sf_dir).select("userid", "itemid").distinct().withColumn("rating", taste * appeal / F.lit(10.0))
    coded, users, items = recommend.indexed_ratings(df, F.hash("userid", "itemid"))
    split = written(ops.hash_split(coded, SHARES, "userid", "itemid", seed=5), "planted")
    return split.filter("split = 'train'"), split.filter("split = 'test'"), users, items


@query(
    "als_held_out",
    f"""{_PLANTED} select kind, count(*) as n, true as better from seen,
    (select unnest(['explicit', 'nonnegative', 'reloaded', 'searched']) as kind) group by kind""",
    "rat",
)
def als_held_out(spark, sf_dir):
    """Fitted on the training pairs, the test pairs are predicted better than by the training mean."""
    train, test, _, _ = _planted(spark, sf_dir)
    explicit = als.fit(train, rank=4, reg=0.01)
    path = new_path(spark, "als-model")
    als.save(explicit, path)
    results = search.als_search(train, test, {"rank": (2, 4), "regParam": (0.01, 0.1), "maxIter": (5,)})
    best = search.best(results).select(F.from_json("params", "rank int, regParam double, maxIter int").alias("p")).first()["p"]
    models = {
        "explicit": explicit,
        "nonnegative": als.fit(train, rank=4, reg=0.01, nonnegative=True),
        "reloaded": als.load(path),
        "searched": als.fit(train, rank=best["rank"], reg=best["regParam"], iterations=best["maxIter"]),
    }
    out = None
    for kind, model in models.items():
        report = evaluate.report(train, model.transform(test).filter("not isnan(prediction)"))
        n = model.transform(test).agg(F.count("prediction").alias("n"))
        part = report.select(F.lit(kind).alias("kind"), n.scalar().alias("n"), (F.col("improvement") > 0).alias("better"))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "als_lists",
    f"""{_PLANTED} select 'users' as kind, count(distinct userid) as lists, true as whole, true as ordered, true as scored
    from p where split = 'train' union all
    select 'items', count(distinct itemid), true, true, true from p where split = 'train'""",
    "rat",
)
def als_lists(spark, sf_dir):
    """Everybody gets five different entries in falling order, with the scores that the factors give."""
    train, _, _, _ = _planted(spark, sf_dir)
    model = als.fit(train, rank=4, iterations=3)
    parts = []
    for kind, mine, other, lists in (
        ("users", als.USER_I, als.ITEM_I, model.recommendForAllUsers(5)),
        ("items", als.ITEM_I, als.USER_I, model.recommendForAllItems(5)),
    ):
        place = F.posexplode("recommendations").alias("at", "r")
        rows = lists.select(mine, place).select(mine, "at", F.col(f"r.{other}").alias(other), F.col("r.rating").alias("rating"))
        scored = als.factor_scores(rows, model.userFactors, model.itemFactors, F.col("at"))
        falling = F.lag("rating").over(Window.partitionBy(mine).orderBy("at"))
        checked = scored.withColumn("before", falling).groupBy(mine).agg(
            (F.count_distinct(other) == 5).alias("whole"),
            F.min(F.coalesce(F.col("before") >= F.col("rating"), F.lit(True))).alias("ordered"),
            F.min(F.abs(F.col("rating") - F.col("prediction")) < 1e-4).alias("scored"),
        )
        parts.append(
            checked.agg(
                F.count(F.lit(1)).alias("lists"), *(F.min(c).alias(c) for c in ("whole", "ordered", "scored"))
            ).withColumn("kind", F.lit(kind))
        )
    return parts[0].unionByName(parts[1])


@query(
    "als_flows",
    "select unnest(['prefilter', 'postfilter', 'itemsplit']) as flow, true as contained, true as positive, true as some",
)
def als_flows(spark, sf_dir):
    """Lists of the fitted flows hold candidates only, with positive scores."""
    df = fine(spark, sf_dir)
    coded, users, items = recommend.indexed_ratings(df, row())
    model = als.fit(coded.select(als.USER_I, als.ITEM_I, "rating"), rank=4, iterations=5, nonnegative=True)
    factors = recommend.als_factors(model, users, items)
    split = ops.split_items(df)
    coded, users, items = recommend.indexed_ratings(split, row())
    split_model = als.fit(coded.select(als.USER_I, als.ITEM_I, "rating"), rank=5, iterations=5)
    flows = {
        "prefilter": (recommend.recommend_prefiltered(df, factors, USER_ID, CONTEXT), recommend.prefilter_candidates(df, USER_ID, CONTEXT)),
        "postfilter": (recommend.recommend_postfiltered(df, factors, USER_ID, CONTEXT), recommend.postfilter_candidates(df, USER_ID, CONTEXT)),
        "itemsplit": (
            recommend.recommend_split_items(df, recommend.als_factors(split_model, users, items), USER_ID),
            ops.unseen_items(split, USER_ID),
        ),
    }
    out = None
    for name, (found, candidates) in flows.items():
        inside = found.join(candidates.withColumn("inside", F.lit(True)), "itemid", "left")
        part = inside.agg(
            F.min(F.coalesce("inside", F.lit(False))).alias("contained"),
            F.min(F.col("rating") > 0).alias("positive"),
            (F.count(F.lit(1)) > 0).alias("some"),
        ).withColumn("flow", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


# ---- smaller learners --------------------------------------------------------------------------


@query("kmeans_nearest", "select count(*) as n, count(*) as nearest from embeddings")
def kmeans_nearest(spark, sf_dir):
    """After the fit every vector is in the cluster of its nearest centre."""
    df = _embeddings(spark, sf_dir)
    model = learners.k_means(vectors.as_vector(df, "embedding"))
    mine = model.transform(vectors.as_vector(df, "embedding")).select("vec_id", F.col("cluster").alias("fitted"))
    nearest = learners.assign_clusters(df, "embedding", [c.tolist() for c in model.clusterCenters()])
    return mine.join(nearest, "vec_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("fitted") == F.col("cluster")).alias("nearest")
    )


@query("logreg_balance", "select rating - 1 as label, round(count(*) / (select count(*) from rat), 2) + 0.0 as share from rat group by 1", "rat")
def logreg_balance(spark, sf_dir):
    """At the optimum the mean probability of a class is its share of the rows."""
    vectors_, _ = _context_vectors(spark, sf_dir)
    model = learners.logistic_regression(vectors_)
    chance = model.transform(vectors_).select(F.posexplode(vector_to_array("probability")).alias("c", "p"))
    return chance.groupBy(F.col("c").cast("double").alias("label")).agg(rounded(F.avg("p"), 2).alias("share")).filter("share > 0")


@query(
    "linreg_best",
    "select 18 as points, true as best_is_least, count(*) as n from rat",
    "rat",
)
def linreg_best(spark, sf_dir):
    """All points of the grid are measured, the chosen one has the least error, and it predicts every row."""
    vectors_, _ = _context_vectors(spark, sf_dir)
    model = learners.linear_regression_grid(vectors_)
    metrics, points = model.validationMetrics, learners.linear_grid_points()
    chosen = {p: model.bestModel.getOrDefault(p) for p in points[0]}
    least = points[int(np.argmin(metrics))] == chosen
    n = model.bestModel.transform(vectors_).agg(F.count("prediction")).first()[0]
    return spark.createDataFrame([(len(metrics), least, n)], "points int, best_is_least boolean, n bigint")


_BAYES = f""", f as ({_CONTEXT_FLAGS}), names as (select distinct feature from f),
  classes as (select rating - 1 as label, count(*) as n from rat group by rating),
  hits as (select label, feature, count(*) as s from f group by label, feature),
  sums as (select label, sum(s) as s from hits group by label),
  theta as (select c.label, names.feature, ln((coalesce(h.s, 0) + 1) / (sums.s + (select count(*) from names))) as t
    from classes c join sums on sums.label = c.label cross join names
    left join hits h on h.label = c.label and h.feature = names.feature),
  pi as (select label, ln((n + 1) / ((select sum(n) from classes) + (select count(*) from classes))) as p from classes),
  score as (select row_id, f.label as label, theta.label as c, sum(t) + any_value(p) as s
    from f join theta using (feature) join pi on pi.label = theta.label group by row_id, f.label, theta.label),
  made as (select row_id, label, arg_max(c, s) as predicted from score group by row_id, label)"""


@query("naive_bayes_predict", f"{_BAYES} select row_id, label, predicted as prediction from made", "rat")
def naive_bayes_predict(spark, sf_dir):
    vectors_, _ = _context_vectors(spark, sf_dir)
    return learners.naive_bayes(vectors_).transform(vectors_).select("row_id", "label", "prediction")


@query("naive_bayes_confusion", f"{_BAYES} select label, predicted, count(*) as n from made group by label, predicted", "rat")
def naive_bayes_confusion(spark, sf_dir):
    return evaluate.confusion(naive_bayes_predict(spark, sf_dir))


# ---- factorization machine ---------------------------------------------------------------------


def _planted_rows(spark, sf_dir):
    """The ratings with the scores of the fixed model as labels, split by row."""
    dictionary, model = dictionary_and_model(spark, sf_dir)
    scored = score_contextual(ratings(spark, sf_dir), dictionary, model, row())
    rows = encode(scored.select("row_id", F.col("prediction").alias("label"), *ENCODED), dictionary, row())
    split = written(ops.hash_split(rows, SHARES, "row_id", seed=5), "planted")
    return dictionary.count(), split.filter("split = 'train'"), split.filter("split = 'test'")


@query(
    "fm_held_out",
    f"""select unnest(['lbfgs', 'sgd']) as kind, n, true as better from (select count(*) as n from rat
    where {spot_split("'5:' || row_id", train=800000)} = 'test')""",
    "rat",
)
def fm_held_out(spark, sf_dir):
    """Fitted on the training rows, the test rows are predicted better than by the training mean."""
    n, train, test = _planted_rows(spark, sf_dir)
    settings = FMSettings(iterations=25, init_std=0.1, reg=(0.0, 0.001, 0.001))
    ref = evaluate.baseline(train, test, "label").first()["baseline_rmse"]
    rows = [
        ("lbfgs", test.count(), search.fm_rmse(fm_train_lbfgs(train, n, settings), test) < ref),
        ("sgd", test.count(), search.fm_rmse(fm_train_sgd(train, n, replace(settings, iterations=4)), test) < ref),
    ]
    return spark.createDataFrame(rows, "kind string, n bigint, better boolean")


@query(
    "fm_classify_held_out",
    f"""select n, true as better from (select count(*) as n from rat where {spot_split("'5:' || row_id", train=800000)} = 'test')""",
    "rat",
)
def fm_classify_held_out(spark, sf_dir):
    """The planted sign is told for more test rows than the commoner class has."""
    n, train, test = _planted_rows(spark, sf_dir)
    sign = F.when(F.col("label") > 0.05, 1.0).otherwise(-1.0)
    train, test = train.withColumn("label", sign), test.withColumn("label", sign)
    model = fm_train_lbfgs(train, n, FMSettings(task=CLASSIFICATION, iterations=25, init_std=0.1, reg=(0.0, 0.001, 0.001)))
    long = long_features(test, "row_id", "label", empty=True)
    # the slope of a row on the right side is below a half
    right = row_slopes(long, model).agg(F.avg((F.abs("e") < 0.5).cast("double")).alias("a"), F.count(F.lit(1)).alias("n"))
    common = test.agg(F.greatest(F.avg((F.col("label") > 0).cast("double")), F.avg((F.col("label") <= 0).cast("double")))).first()[0]
    return right.select("n", (F.col("a") > common).alias("better"))


@query("fm_lbfgs_forms", "select count(*) as n, 0.0::double as w0, 0.0::double as factors from dic", "dic")
def fm_lbfgs_forms(spark, sf_dir):
    """Both forms of training give one model."""
    dictionary = feature_dictionary(ratings(spark, sf_dir))
    rows, n = written(encoded(spark, sf_dir, dictionary), "rows"), dictionary.count()
    settings = FMSettings(iterations=2, dim=(True, True, 4), init_std=0.1)
    a, b = (fm_train_lbfgs(rows, n, settings, compact_bytes=limit) for limit in (1 << 30, 0))
    both = a.factors.alias("a").join(b.factors.alias("b"), "idx")
    gap = F.greatest(*(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) for c in ("w", *a.v)))
    return both.agg(
        F.count(F.lit(1)).alias("n"), F.lit(round(abs(a.intercept - b.intercept), 6)).alias("w0"), rounded(F.max(gap)).alias("factors")
    )


@query(
    "fm_loss_empty",
    """select count(*) as n, round(avg(case when row_id % 2 = 0 then pow(0.05 - rating, 2) else pow(raw - rating, 2) end / 2), 6) + 0.0
      as loss, round(avg(case when row_id % 2 = 0 then 0.05 - rating else raw - rating end), 6) + 0.0 as dw0 from scored""",
    "scored",
)
def fm_loss_empty(spark, sf_dir):
    """Every second row without features: such rows are predicted by the intercept, and count."""
    dictionary, model = dictionary_and_model(spark, sf_dir)
    bare = F.col("row_id") % 2 == 0
    rows = encoded(spark, sf_dir, dictionary).withColumns(
        {c: F.when(bare, F.array().cast(kind)).otherwise(F.col(c)) for c, kind in (("idx", "array<bigint>"), ("val", "array<double>"))}
    )
    found = mean_loss(row_slopes(long_features(rows, "row_id", "label", empty=True), model))
    return found.withColumns({c: rounded(F.col(c)) for c in ("loss", "dw0")})


@query("fm_recommend_renamed", "select itemid, round(rating, 6) + 0.0 as rating from reqscore where rating > 0", "reqscore")
def fm_recommend_renamed(spark, sf_dir):
    """Context columns of other names."""
    names = {"Time": "When", "Location": "Where", "Companion": "With whom"}
    df = ratings(spark, sf_dir).withColumnsRenamed(names)
    dictionary = feature_dictionary(df, ("userid", "itemid", *names.values()))
    asked = {names[c]: v for c, v in CONTEXT.items()}
    found = recommend.recommend_by_model(dictionary, fixed_model(dictionary), USER_ID, asked)
    return found.withColumn("rating", rounded(F.col("rating")))


# ---- whole flows -------------------------------------------------------------------------------


@query(
    "staged_facts",
    """select (select count(*) from rat) as features, (select count(*) from dic) as dictionary, 4 as searched,
    1 as params, true as known from dic limit 1""",
    "rat dic",
)
def staged_facts(spark, sf_dir):
    """Prepare, design, train with the stored parameters, predict: what the tables between the steps hold."""
    path = new_path(spark, "run")
    stages.prepare(ratings(spark, sf_dir), path)
    stages.design(spark, path, STAGED_GRID)
    stages.train(spark, path)
    found = stages.predict(spark, path, USER_ID, CONTEXT)
    items = stages.run_table(spark, path, "dictionary").filter("name = 'itemid'").select(F.col("val").alias("itemid"))
    strange = found.join(items, "itemid", "left_anti").count()
    counts = [stages.run_table(spark, path, t).count() for t in ("features", "dictionary", "search")]
    row_ = (*counts, spark.read.json(stages.place(spark, path, "params")).count(), strange == 0)
    return spark.createDataFrame([row_], "features bigint, dictionary bigint, searched int, params int, known boolean")


@query(
    "staged_versions",
    """select (select count(*) from dic) as served, (select count(*) from rat where row_id % 2 = 0) as prepared,
    3 as finished, true as same_list, true as same_model from dic limit 1""",
    "rat dic",
)
def staged_versions(spark, sf_dir):
    """Rows prepared after the training do not touch what is served; the same training again gives the same model."""
    path = new_path(spark, "run")
    few = FMSettings(iterations=5)
    df = ratings(spark, sf_dir)
    stages.prepare(df, path)
    model = stages.train(spark, path, few)
    again = stages.train(spark, path, few).intercept == model.intercept
    before = written(stages.predict(spark, path, USER_ID, CONTEXT), "before")
    served = load_table(spark, stages.newest(spark, path, "train")["tables"]["dictionary"])
    stages.prepare(df.filter("row_id % 2 = 0"), path)
    after = stages.predict(spark, path, USER_ID, CONTEXT)
    same = before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()
    row_ = (served.count(), stages.run_table(spark, path, "features").count(), stages.commits(spark, path).count(), same, again)
    return spark.createDataFrame([row_], "served bigint, prepared bigint, finished int, same_list boolean, same_model boolean")


@query(
    "personal_recommend",
    """select 5 as listed, true as fresh, true as falling""",
)
def personal_recommend(spark, sf_dir):
    """A new user's own ratings join the training rows; the fitted model lists items that the user has not rated."""
    df = scaled(spark, sf_dir).select("userid", "itemid", "rating")
    own = df.filter(F.col("userid") == USER_ID).withColumn("userid", F.lit("new"))
    everything = ops.with_personal(df, own)
    coded, users, items = recommend.indexed_ratings(everything, F.hash("userid", "itemid"))
    model = als.fit(coded.select(als.USER_I, als.ITEM_I, "rating"), rank=4, iterations=5)
    fresh = ops.unseen_items(everything, "new")
    scored = recommend.als_factors(model, users, items).score(fresh, "new")
    best = recommend.top_k(scored, 5, F.col("rating").desc(), F.col("itemid").asc())
    rated = own.select("itemid").distinct().withColumn("rated", F.lit(True))
    rows = best.join(rated, "itemid", "left").withColumn("before", F.lag("rating").over(Window.orderBy("rank")))
    return rows.agg(
        F.count(F.lit(1)).cast("int").alias("listed"),
        F.min(F.col("rated").isNull()).alias("fresh"),
        F.min(F.coalesce(F.col("before") >= F.col("rating"), F.lit(True))).alias("falling"),
    )
