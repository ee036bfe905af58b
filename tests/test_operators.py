"""Operators on small tables with results worked out by hand or by brute force."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sitrec.operators import encoding, joins, ordering, relational, text, vectors
from sitrec.sources import features
from sitrec.sources import ratings as readers
from sitrec.storage import new_path

RATINGS = "row_id bigint, userid string, itemid string, rating double, Time string, Location string, Companion string"


def table(spark):
    rows = [
        (1, "u1", "a", 5.0, "Weekend", "Home", "Family"),
        (2, "u1", "b", 1.0, "Weekday", "Home", "Alone"),
        (3, "u2", "a", 3.0, "NA", "NA", "NA"),
        (4, "u2", "c", 4.0, "Weekend", "Home", "Family"),
        (5, "u3", "c", 2.0, "Weekend", "Cinema", "Partner"),
        (6, "u1", "a", 5.0, "Weekend", "Home", "Family"),
    ]
    return spark.createDataFrame(rows, RATINGS)


def column(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


# ---- readers -----------------------------------------------------------------------------------


def lines(spark, path, *text_lines):
    spark.createDataFrame([(t,) for t in text_lines], "value string").coalesce(1).write.text(path)


def test_load_ratings_takes_named_columns_only(spark):
    path = new_path(spark, "csv")
    lines(spark, path, "extra,itemid,userid,rating,Companion,Time,Location", "x,i1,7,4,Alone,NA,Home", "y,i2,8,bad,NA,NA,NA")
    df = readers.load_ratings(spark, path)
    assert df.columns == ["userid", "itemid", "rating", "Time", "Location", "Companion"]
    assert column(df, "userid", "itemid", "Time")[0] == ("7", "i1", "NA")
    assert [r.rating for r in df.orderBy("userid").collect()] == [4.0, None]


def test_header_line_of_plain_ratings(spark):
    path = new_path(spark, "csv")
    lines(spark, path, "user,item,rating,seconds", "4,17,3.5,1700000000")
    assert readers.load_plain_ratings(spark, path, header=True).collect() == [(4, 17, 3.5)]
    assert (None, None, None) in [tuple(r) for r in readers.load_plain_ratings(spark, path).collect()]
    assert readers.load_timed_ratings(spark, path, header=True).collect() == [(4, 17, 3.5, 1700000000)]


def test_delimited_lines(spark):
    df = spark.createDataFrame([("1,2,3.5,99",), ("1,2,3",), ("1,2,3,4,5",)], "line string")
    assert readers.parse_delimited(df, "line", on_bad="drop").collect() == [(1, 2, 3.5, 99)]
    with pytest.raises(Exception, match="not four fields"):
        readers.parse_delimited(df, "line").collect()
    with pytest.raises(ValueError):
        readers.parse_delimited(df, "line", on_bad="skip")


def test_quoted_commas(spark):
    df = spark.createDataFrame([('5,"ring, red","a ""b"" c"',)], "line string")
    got = readers.parse_quoted(df, "line", "id int, name string, genre string").first()
    assert (got.id, got.name, got.genre) == (5, "ring, red", 'a "b" c')


def test_libsvm_text_and_back(spark):
    rows = spark.createDataFrame(
        [(0.5, [0, 4], [1.0, 2.5]), (-1.0, [], []), (1.0, [2], [1.0])], "label double, idx array<bigint>, val array<double>"
    )
    path = new_path(spark, "svm")
    features.save_libsvm(rows, path)
    assert sorted(r.value.strip() for r in spark.read.text(path).collect()) == ["-1.0", "0.5 1:1.0 5:2.5", "1.0 3:1.0"]
    assert column(features.load_libsvm(spark, path), "label", "idx", "val") == column(rows, "label", "idx", "val")
    loaded = features.load_libsvm_vectors(spark, path, 5)
    assert {r.features.size for r in loaded.collect()} == {5}


def test_vector_parts_drops_zeros(spark):
    df = spark.createDataFrame(
        [(1, Vectors.dense(0.0, 2.0, 0.0, -1.5)), (2, Vectors.sparse(4, [0, 3], [7.0, 0.0]))], ["id", "features"]
    )
    got = {r.id: (r.idx, r.val) for r in features.vector_parts(df).collect()}
    assert got == {1: ([1, 3], [2.0, -1.5]), 2: ([0], [7.0])}


# ---- ordering ----------------------------------------------------------------------------------


def test_totals_over_many_partitions(spark):
    """The running totals are right when the sorted rows lie in several partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 5).alias("n"))
        got = ordering.totals_before(df, [F.col("k").asc()], {"before": F.col("n"), "pos": F.lit(1)})
        parts = got.select("k", "n", "before", "pos").orderBy("k").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    total = 0
    for i, r in enumerate(parts):
        assert (r.k, r.before, r.pos) == (i, total, i)
        total += r.n


def test_numbered_descending_with_ties(spark):
    df = spark.createDataFrame([("a", 2), ("b", 3), ("c", 2)], "v string, n int")
    got = ordering.numbered(df, F.col("n").desc(), F.col("v").asc())
    assert column(got, "v", "idx") == [("a", 1), ("b", 0), ("c", 2)]


def test_top_k(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", 3.0), ("z", 3.0), ("w", 2.0)], "name string, score double")
    got = ordering.top_k(df, 3, F.col("score").desc(), F.col("name").asc())
    assert [(r.name, r["rank"]) for r in got.orderBy("rank").collect()] == [("y", 1), ("z", 2), ("w", 3)]
    per = ordering.top_k_per(df.withColumn("g", F.lit(1)), ["g"], 1, F.col("score").desc(), F.col("name").asc())
    assert [r.name for r in per.collect()] == ["y"]


def test_top_k_per_prunes_before_the_shuffle(spark, capsys):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), "id")
    ordering.top_k_per(df, ["g"], 3, F.col("id").desc()).explain()
    assert "Partial" in capsys.readouterr().out


def test_sample_is_repeatable(spark):
    df = table(spark)
    first = ordering.sample_one(df, "userid", 3).first()[0]
    assert first == ordering.sample_one(df.repartition(5), "userid", 3).first()[0]


# ---- joins -------------------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    """A key with a third of all rows, keys without match, lookup rows without facts."""
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"))
    names = [("hot", 1)] + [(str(i), i) for i in range(5, 60)]
    lookup = spark.createDataFrame(names, "k string, x int")
    plain = facts.join(lookup, "k", how)
    salted = joins.lookup_join(facts, lookup, "k", F.col("id"), how, broadcast_bytes=-1)
    assert column(salted.na.fill(-1), "id", "k", "x") == column(plain.na.fill(-1), "id", "k", "x")


def test_hot_key_is_spread(spark):
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    hot = joins.hot_keys(facts, "k", tasks=100)
    assert [r.k for r in hot.collect()] == [0]
    spread = joins.salted(facts, "k", hot, F.col("id")).groupBy("k", "_salt").count()
    assert spread.filter("k = 0").count() > 32
    assert spread.agg(F.max("count")).first()[0] < 100


def test_missing_keys_are_spread_and_kept(spark):
    facts = spark.range(900).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("k"))
    lookup = spark.createDataFrame([(i, i) for i in range(7)], "k bigint, x int")
    spread = joins.salted(facts, "k", joins.hot_keys(facts, "k"), F.col("id")).filter("k is null")
    assert spread.select("_salt").distinct().count() > 32
    joined = joins.lookup_join(facts, lookup, "k", F.col("id"), broadcast_bytes=-1)
    assert joined.count() == 900 and joined.filter("x is null").count() == 300


def test_table_bytes_counts_text(spark):
    small = spark.createDataFrame([("ab", 1)], "k string, x int")
    assert joins.table_bytes(small) == 2 + 32
    assert joins.table_bytes(small.filter("x > 5")) == 0


def test_lookup_join_rejects_other_joins(spark):
    with pytest.raises(ValueError):
        joins.lookup_join(spark.range(1), spark.range(1), "id", F.col("id"), "outer")


# ---- relational --------------------------------------------------------------------------------


def test_context_filters(spark):
    df = table(spark)
    assert column(relational.context_filter(df, {"Time": "Weekend", "Location": "Home"}), "row_id") == [(1,), (4,), (6,)]
    assert relational.context_filter(df, {}).count() == 6
    assert column(relational.known_context(df), "row_id") == [(1,), (2,), (4,), (5,), (6,)]


def test_unseen_items_with_null(spark):
    df = spark.createDataFrame([("u", "a"), ("u", None), ("v", "b"), ("v", None)], "userid string, itemid string")
    assert column(relational.unseen_items(df, "u"), "itemid") == [("b",)]
    assert relational.unseen_items(df, "nobody").count() == 2


def test_positive_required(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,)], "rating double")
    assert relational.positive(df).isEmpty()
    with pytest.raises(ValueError):
        relational.positive(df, required=True)


def test_rescale(spark):
    got = column(relational.rescale_ratings(table(spark)), "row_id", "rating")
    assert [r for _, r in got] == [1.0, -1.0, 0.0, 0.5, -0.5, 1.0]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "rating double")
    assert [r[0] for r in relational.rescale_ratings(flat).collect()] == [None, None]


def test_modulo_split_of_negative_numbers(spark):
    df = spark.createDataFrame([(-1,), (0,), (5,), (6,), (7,), (8,), (-8,)], "t int")
    got = {r.t: r.split for r in relational.modulo_split(df, "t").collect()}
    assert got == {-1: "test", 0: "train", 5: "train", 6: "validation", 7: "validation", 8: "test", -8: "train"}


def test_hash_split_shares_and_stability(spark):
    df = spark.range(20000)
    weights = {"a": 6.0, "b": 2.0, "c": 2.0}
    sizes = {r.split: r.n for r in relational.split_sizes(relational.hash_split(df, weights, "id", seed=1)).collect()}
    assert sum(sizes.values()) == 20000
    assert abs(sizes["a"] / 20000 - 0.6) < 0.02 and abs(sizes["c"] / 20000 - 0.2) < 0.02
    again = relational.hash_split(df.repartition(3), weights, "id", seed=1)
    assert {r.split: r.n for r in relational.split_sizes(again).collect()} == sizes
    with pytest.raises(ValueError):
        relational.hash_split(df, {"a": 0.0}, "id")


def test_personal_ratings_stay_twice(spark):
    df = table(spark)
    own = df.filter("userid = 'u1'")
    assert relational.with_personal(df, own).count() == 9


def test_pivot(spark):
    df = table(spark)
    wide = relational.pivot_values(df, {"Location": ["Cinema", "Home", "NA"]}, ["row_id"])
    assert wide.filter("row_id = 5").first().asDict() == {
        "row_id": 5,
        "Location_Cinema": 1.0,
        "Location_Home": 0.0,
        "Location_NA": 0.0,
    }
    long = relational.pivot_long(df, ["Location", "Time"], ["row_id"])
    assert {r.feature for r in long.filter("row_id = 5").collect() if r.feature.startswith("Location")} == {"Location_Cinema"}


def test_row_ids_are_written_once(spark):
    df = relational.with_row_id(table(spark).drop("row_id").repartition(4))
    first = column(df, "row_id", "userid", "itemid")
    assert first == column(df, "row_id", "userid", "itemid") and len({r[0] for r in first}) == 6


def test_rows_in_wanted_contexts(spark):
    df = table(spark)
    wanted = spark.createDataFrame([("Weekend", "Home", "Family"), ("Weekend", "Home", "Family"), ("x", "y", "z")], "Time string, Location string, Companion string")
    assert column(relational.in_contexts(df, wanted), "row_id") == [(1,), (4,), (6,)]


def test_roll_up_and_stats(spark):
    events = spark.createDataFrame([("u", "i", 2, 1.5), ("u", "i", 5, 1.0), ("u", "j", 1, 3.0)], "userid string, itemid string, Weight int, Value double")
    assert column(relational.roll_up(events, ["userid", "itemid"]), "itemid", "rating") == [("i", 8.0), ("j", 3.0)]
    assert relational.dataset_stats(table(spark)).first() == (6, 3, 3)
    assert relational.dataset_stats(table(spark), exact=False).first()[0] == 6


# ---- encoding ----------------------------------------------------------------------------------


def test_index_orders(spark):
    df = table(spark)
    assert column(encoding.index_table(df, "itemid"), "idx", "itemid") == [(0, "a"), (1, "c"), (2, "b")]
    assert column(encoding.index_table(df, "itemid", "alphabetAsc"), "idx", "itemid") == [(0, "a"), (1, "b"), (2, "c")]
    with pytest.raises(ValueError):
        encoding.index_table(df, "itemid", "random")


def test_index_equals_the_ml_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    df = table(spark)
    mine = dict(column(encoding.index_table(df, "Companion"), "Companion", "idx"))
    labels = StringIndexer(inputCol="Companion", outputCol="i").fit(df).labels
    assert mine == {label: i for i, label in enumerate(labels)}


def test_dictionary_blocks_and_unknown_values(spark):
    df = table(spark)
    dictionary = encoding.feature_dictionary(df)
    rows = dictionary.orderBy("idx").collect()
    assert [r.idx for r in rows] == list(range(len(rows)))
    assert [(r.block, r.val) for r in rows] == sorted((r.block, r.val) for r in rows)
    assert sum(r.n for r in rows if r.block == 0) == 6
    stranger = spark.createDataFrame([(9, "u9", "a", 1.0, "Weekend", "Space", "Alone")], RATINGS)
    coded = encoding.encode(stranger, dictionary, F.col("row_id")).first()
    assert coded.unknown == 2 and len(coded.idx) == 3 and coded.val == [1.0] * 3
    assert coded.idx == sorted(coded.idx)


def test_encoding_by_salted_join_is_the_same(spark):
    df = table(spark)
    dictionary = encoding.feature_dictionary(df)
    plain = encoding.encode(df, dictionary, F.col("row_id"))
    salted = encoding.encode(df, dictionary, F.col("row_id"), broadcast_bytes=-1)
    assert column(plain, "row_id", "idx") == column(salted, "row_id", "idx")


def test_encoding_equals_one_hot_vectors(spark):
    df = base = table(spark)
    dictionary = encoding.feature_dictionary(df)
    want = column(encoding.encode(df, dictionary, F.col("row_id")), "row_id", "idx")
    for c in encoding.ENCODED:
        df = encoding.string_index(df, c, f"{c}I", encoding.index_table(base, c, "alphabetAsc"), F.col("row_id"))
    hot = encoding.one_hot_vectors(df, [f"{c}I" for c in encoding.ENCODED])
    assert hot.first().features.size == dictionary.count()
    assert column(features.vector_parts(hot.select("row_id", "features")), "row_id", "idx") == want


def test_index_to_string_round_trip(spark):
    df = table(spark)
    index = encoding.index_table(df, "itemid")
    coded = encoding.string_index(df, "itemid", "i", index, F.col("row_id"))
    back = encoding.index_to_string(coded, "i", "name", index, "itemid", F.col("row_id"))
    assert all(r.itemid == r.name for r in back.collect())


# ---- vectors and text --------------------------------------------------------------------------


def test_dct_and_back(spark):
    x = [1.0, -2.0, 0.5, 3.0]
    df = spark.createDataFrame([(1, x)], "id int, a array<double>")
    coded = vectors.cosine_transform(vectors.as_vector(df, "a"))
    got = coded.first().dct.toArray()
    n = len(x)
    want = [
        math.sqrt((1 if k == 0 else 2) / n) * sum(v * math.cos(math.pi * (i + 0.5) * k / n) for i, v in enumerate(x))
        for k in range(n)
    ]
    assert np.allclose(got, want)
    back = vectors.cosine_transform(coded.drop("features"), "dct", "back", inverse=True).first().back.toArray()
    assert np.allclose(back, x)


def test_slices_by_index_and_name(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "f1 double, f2 double, f3 double")
    rows = encoding.assemble(df, ["f1", "f2", "f3"])
    assert list(vectors.slice_vector(rows, indices=(1, 2)).first().sliced) == [2.0, 3.0]
    assert list(vectors.slice_vector(rows, names=("f3",)).first().sliced) == [3.0]


def test_min_max_of_constant_slot(spark):
    df = spark.createDataFrame([([1.0, 5.0],), ([3.0, 5.0],)], "a array<double>")
    got = [list(r.scaled) for r in vectors.min_max_scale(vectors.as_vector(df, "a")).collect()]
    assert got == [[0.0, 0.5], [1.0, 0.5]]


def test_covariance_over_partitions(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(200, 4))
    df = spark.createDataFrame([(r.tolist(),) for r in data], "a array<double>").repartition(5)
    want = np.cov(data.T)
    for r in vectors.covariance(df, "a").collect():
        assert r.covariance == pytest.approx(want[r.i, r.j])


def test_pca_spans_the_data(spark):
    df = spark.createDataFrame([([float(i), 2.0 * i, 0.0],) for i in range(10)], "a array<double>")
    model = vectors.fit_pca(vectors.as_vector(df, "a"), 2)
    assert model.explainedVariance[0] == pytest.approx(1.0)


def test_average_ranks_with_ties(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (2.0,), (9.0,)], "x double")
    assert column(vectors.average_ranks(df, "x", "r"), "x", "r") == [(1.0, 1.0), (2.0, 3.0), (9.0, 5.0)]


def test_terms_and_frequencies(spark):
    docs = [(1, "b a  b\nC"), (2, "a"), (3, ""), (4, "c c c c")]
    df = text.tokenize(spark.createDataFrame(docs, "doc_id int, text string"))
    words = {r.doc_id: r.words for r in df.collect()}
    assert words[1] == ["b", "a", "", "b", "c"]
    got = {(r.doc_id, r.term): r.tf for r in text.term_counts(df, "doc_id").collect()}
    want = {(d, t): n for d, ws in words.items() for t, n in Counter(ws).items()}
    assert got == want
    weights = {(r.doc_id, r.term): r.idf for r in text.tf_idf(df, "doc_id").collect()}
    assert weights[(1, "a")] == pytest.approx(math.log(5 / 3))


@pytest.mark.parametrize("held", [True, False])
def test_large_vocabulary_is_held_by_tasks(spark, monkeypatch, held):
    """Too large to broadcast, the vocabulary is hashed where a task can hold its part, and merged where not."""
    df = spark.createDataFrame([(i, ["all", f"w{i % 7}", f"w{i % 5}", f"one{i}"]) for i in range(40)], "doc_id bigint, words array<string>")
    expected = sorted(text.tf_idf(df, "doc_id").collect())
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    if not held:
        monkeypatch.setattr(text, "VOCABULARY_BYTES", 0)
    shuffled = text.tf_idf(df, "doc_id")
    plan = shuffled._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=shuffle_hash" in plan) == held
    assert sorted(shuffled.collect()) == expected


def test_hashing_keeps_the_token_count(spark):
    df = text.tokenize(spark.createDataFrame([(1, "a b a c"), (2, "x")], "doc_id int, text string"))
    got = text.hashing_tf(df, 20).select("doc_id", F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x).alias("n"))
    assert column(got, "doc_id", "n") == [(1, 4.0), (2, 1.0)]


def test_word2vec_is_the_mean_of_the_words(spark):
    df = text.tokenize(spark.createDataFrame([(i, "red green blue red") for i in range(5)], "doc_id int, text string"))
    model = text.fit_word2vec(df, size=3, partitions=1)
    words = {r.word: r.vector.toArray() for r in model.getVectors().collect()}
    want = (2 * words["red"] + words["green"] + words["blue"]) / 4
    assert np.allclose(model.transform(df).first().vector.toArray(), want)


def test_covariance_of_shifted_columns(spark):
    """Columns around a billion: products of raw values would leave no digit of the variance."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 3)) * [0.5, 0.5, 2.0] + [1e9, -1e9, 3.0]
    df = spark.createDataFrame([(v.tolist(),) for v in x], "a array<double>").repartition(5)
    got = {(r.i, r.j): r.covariance for r in vectors.covariance(df, "a").collect()}
    want = np.cov(x.T)
    assert all(got[i, j] == pytest.approx(want[i, j], rel=1e-5, abs=1e-6) for i in range(3) for j in range(i, 3))


@pytest.mark.parametrize("bad", [[[1.0, 2.0], None], [[1.0, 2.0], [1.0]], [[1.0, None], [1.0, 2.0]]])
def test_covariance_refuses_ragged_rows(spark, bad):
    df = spark.createDataFrame([(v,) for v in bad], "a array<double>").coalesce(1)
    with pytest.raises(Exception, match="one length"):
        vectors.covariance(df, "a").collect()


def test_large_top_k_is_cut_in_two_steps(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), (F.col("id") * 7919 % 5003).alias("x"))
    want = ordering.top_k_per(df, ["g"], 900, F.col("x").desc())
    got = ordering.top_k_per(df, ["g"], 1100, F.col("x").desc())
    assert got.columns == want.columns and got.count() == 2200
    assert column(got.filter("rank <= 900"), "g", "x", "rank") == column(want, "g", "x", "rank")


def test_joined_rmse_keeps_small_errors(spark):
    from sitrec.models import evaluate

    rows = [(str(i % 5), "a", 1e6 + i) for i in range(50)]
    truth = spark.createDataFrame(rows, "userid string, itemid string, rating double")
    exact = truth.groupBy("userid", "itemid").agg((F.avg("rating") + 1e-4).alias("prediction"))
    got = evaluate.rmse_joined(exact, truth).first()
    spread = np.sqrt(np.mean([(r - np.mean([x[2] for x in rows if x[0] == u]) - 1e-4) ** 2 for u, _, r in rows]))
    assert got.rmse == pytest.approx(spread, rel=1e-9) and got.matched == 50


def test_spearman_matrix(spark):
    import pandas as pd

    rng = np.random.default_rng(5)
    data = rng.integers(0, 4, (60, 3)).astype(float)  # many ties
    data = np.column_stack([data, data[:, 0] * -2.0, np.ones(60)])
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(data)], "id long, v array<double>").repartition(5)
    want = pd.DataFrame(data).corr("spearman").to_numpy()
    got = {(r.i, r.j): r.correlation for r in vectors.spearman_matrix(df, "id", "v").collect()}
    assert set(got) == {(i, j) for i in range(5) for j in range(i, 5)}
    for (i, j), r in got.items():
        assert r is None if 4 in (i, j) else abs(r - want[i, j]) < 1e-12
    assert vectors.spearman_matrix(df.limit(0), "id", "v").collect() == []
    for bad in ([(1, [1.0, None]), (2, [1.0, 2.0])], [(1, [1.0]), (2, [1.0, 2.0])], [(1, None), (2, [1.0])], [(1, [1.0]), (1, [2.0])]):
        with pytest.raises(ValueError):
            vectors.spearman_matrix(spark.createDataFrame(bad, "id long, v array<double>"), "id", "v")


def test_code_lengths_are_those_of_a_huffman_tree():
    import heapq
    import random

    from sitrec.operators.word_vectors import code_lengths

    rng = random.Random(3)
    for words in (0, 1, 2, 3, 50, 400):
        weights = [rng.choice((1, 1, 1, 2, 3, 5, 8, 40, 900)) for _ in range(words)]
        found = code_lengths(sorted(Counter(weights).items()))
        heap, cost = list(weights), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            a = heapq.heappop(heap) + heapq.heappop(heap)
            cost += a
            heapq.heappush(heap, a)
        lengths = [n for n, many in found.items() for _ in range(many)]
        assert len(lengths) == words and sum(a * b for a, b in zip(sorted(weights, reverse=True), lengths)) == cost
        assert words < 2 or sum(2.0**-n for n in lengths) == 1.0


def test_word2vec_keeps_its_vocabulary_in_a_table(spark):
    """All words get vectors through tables; words that occur together come to be alike; the driver gets no word."""
    rng = np.random.default_rng(2)
    groups = [[f"{g}{i}" for i in range(6)] for g in "ab"]
    texts = [(i, " ".join(rng.choice(groups[i % 2], 30))) for i in range(400)] + [(400, None), (401, ""), (1, "a0 a0")]
    df = text.tokenize(spark.createDataFrame(texts, "doc_id int, text string").where("text is not null").repartition(3))
    model = text.fit_word2vec(df, size=3, iterations=6, partitions=3, min_count=2)
    assert type(model).__module__.startswith("sitrec.")
    vectors = {r.word: r.vector.toArray() for r in model.getVectors().collect()}
    assert set(vectors) == {w for g in groups for w in g}
    unit = {w: v / np.linalg.norm(v) for w, v in vectors.items()}
    same = np.mean([unit[a] @ unit[b] for g in groups for a in g for b in g if a != b])
    assert same > np.mean([unit[a] @ unit[b] for a in groups[0] for b in groups[1]]) + 0.3
    made = Counter((r.doc_id, tuple(np.round(r.vector.toArray(), 9))) for r in model.transform(df).collect())
    held = [(r.doc_id, r.words) for r in df.collect()]
    want = [(d, sum((vectors.get(w, np.zeros(3)) for w in ws), np.zeros(3)) / len(ws)) for d, ws in held]
    assert made == Counter((d, tuple(np.round(v, 9))) for d, v in want)


def test_word2vec_leaves_no_tables_behind(spark):
    """What only the training reads is deleted: sentences, vocabulary, needed words, parts' vectors, nodes."""
    import os

    from sitrec.storage import shared_folder

    folder = shared_folder(spark)
    df = text.tokenize(spark.createDataFrame([(i, f"a b c{i % 3} d{i}") for i in range(40)], "doc_id int, text string"))
    for iterations in (1, 3):
        before = set(os.listdir(folder))
        model = text.fit_word2vec(df, size=2, iterations=iterations, partitions=2)
        assert [name.split("-")[0] for name in set(os.listdir(folder)) - before] == ["vectors"]
        assert model.getVectors().count() == 45


def test_word2vec_steps_by_hand():
    """Steps of a part, word by word in plain loops; large vectors, so that some pairs are beyond the limit."""
    import pyarrow as pa

    from sitrec.operators import word_vectors as wv

    rng, size, words = np.random.default_rng(7), 2, 6
    spelt = ["0", "10", "110", "1110", "11110", "11111"]
    start = rng.normal(size=(words, size)) * 30
    nodes = {b[:d]: rng.normal(size=size) for b in spelt for d in range(len(b))}
    texts = [rng.integers(0, words, n).tolist() for n in (25, 3, 9)]
    name = lambda prefix: int("1" + prefix, 2)
    rows = [(wv.WORD, i, f"t{i}", len(b), int(b, 2), start[i].tolist()) for i, b in enumerate(spelt)]
    rows += [(wv.NODE, name(p), None, None, None, v.tolist()) for p, v in nodes.items()]
    kinds = (pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.list_(pa.float64()))
    held = pa.table({c: pa.array([r[j] for r in rows], k) for j, (c, k) in enumerate(zip(("kind", "id", "term", "size", "code", "vec"), kinds))})
    given = [[f"t{w}" for w in t] + ["strange", None] for t in texts]
    sentences = pa.table({"sentence": pa.array([5, 6, 9]), "words": pa.array(given, pa.list_(pa.string()))})
    got = wv._learn(sentences, held, 4, size, 1, 2, 3, 10.0, 1000.0, True)

    want, inner, draw, skipped = start.copy(), {p: v.copy() for p, v in nodes.items()}, np.random.default_rng([1, 2, 4]), 0
    for t in texts:
        reach = wv.WINDOW - draw.integers(0, wv.WINDOW, len(t))
        for at in range(0, len(t), wv.CENTRES):
            old, old_inner = want.copy(), {p: v.copy() for p, v in inner.items()}
            for c in range(at, min(at + wv.CENTRES, len(t))):
                for o in range(max(0, c - reach[c]), min(len(t), c + reach[c] + 1)):
                    for d, bit in enumerate(spelt[t[c]]) if o != c else ():
                        p = spelt[t[c]][:d]
                        f = old[t[o]] @ old_inner[p]
                        if abs(f) >= wv.CLIP:
                            skipped += 1
                            continue
                        g = (1 - int(bit) - 1 / (1 + np.exp(-f))) * wv.RATE
                        inner[p] += g * old[t[o]]
                        want[t[o]] += g * old_inner[p]
    assert skipped
    found = {(r["kind"], r["id"]): r["vec"] for r in got.to_pylist()}
    for i in range(words):
        assert found[wv.WORD, i] == pytest.approx(want[i].tolist(), rel=1e-9)
    for p, v in inner.items():
        assert found.get((wv.NODE, name(p)), v.tolist()) == pytest.approx(v.tolist(), rel=1e-9)
