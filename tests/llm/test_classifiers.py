import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import SCHEMA, rows

from sitrec.llm.language import identify, identify_language, learn
from sitrec.llm.quality_fm import Model, fit, score_quality, text_features
from sitrec.llm.quality_fm import learn as learn_quality


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.fixture(scope="module")
def tables(spark, request):
    sf_dir = request.getfixturevalue("sf_dir")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs, spark.read.parquet(f"{sf_dir}/labels.parquet")


def test_languages_held_out(tables):
    docs, _ = tables
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = identify_language(docs).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == held(r.doc_id) for r in got)
    out = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.95 * len(out)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_cases(spark, tables):
    model = learn(tables[0])
    data = rows()
    got = identify(spark.createDataFrame(data, SCHEMA), model).collect()
    assert len(got) == len(data)
    for r in got:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in model
    assert [r.lang_pred for r in identify(spark.createDataFrame(data, SCHEMA), {}).collect()] == ["und"] * len(data)
    assert identify(spark.createDataFrame([], SCHEMA), model).collect() == []


def test_learning_leaves_out_held_rows_and_nulls(spark):
    data = [(i, f"text {i} " * 30, "xx" if held(i) else "yy" if i % 2 else None) for i in range(40)]
    assert set(learn(spark.createDataFrame(data, "doc_id long, text string, lang string"))) == {"yy"}
    assert learn(spark.createDataFrame([], SCHEMA)) == {}


def test_prediction_reads_the_text_only(spark, tables):
    docs, _ = tables
    model = learn(docs)
    some = docs.limit(20)
    plain = {r.doc_id: (r.lang_pred, r.score) for r in identify(some, model).collect()}
    changed = identify(some.selectExpr("doc_id + 0 as doc_id", "text", "'zz' as lang", "'s' as source"), model)
    assert {r.doc_id: (r.lang_pred, r.score) for r in changed.collect()} == plain


def test_quality_held_out(spark, tables):
    docs, labels = tables
    model = learn_quality(docs, labels)
    got = {r.doc_id: r for r in score_quality(docs, model).collect()}
    assert len(got) == docs.count() and all(r.held_out == held(r.doc_id) for r in got.values())
    pairs = [(got[r.doc_id].score, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    good, bad = [s for s, q in pairs if q == 1], [s for s, q in pairs if q == 0]
    if bad:
        auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
        assert auc > 0.9
    assert all(r.predicted == (r.score >= 0.7) for r in got.values())


def test_quality_cases(spark):
    data = rows()
    docs = spark.createDataFrame(data, SCHEMA)
    model = Model(0.3, *(lambda g: (g.normal(0, 0.1, 100_000), g.normal(0, 0.1, (100_000, 3))))(np.random.default_rng(1)))
    got = score_quality(docs, model).collect()
    assert len(got) == len(data) and all(0 <= r.score <= 1 for r in got)
    assert score_quality(spark.createDataFrame([], SCHEMA), model).collect() == []
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    only_good = learn_quality(docs, labels)
    assert {round(r.score, 6) for r in score_quality(docs, only_good).collect()} == {0.99}
    assert learn_quality(docs, labels.where("false")).w0 == 0.0


def test_sum_of_squares_identity():
    texts = pa.array([r[1] or "" for r in rows(10)])
    offsets, feature, value = text_features(texts)
    rng = np.random.default_rng(3)
    n = int(feature.max()) + 1
    model = Model(0.1, rng.normal(size=n), rng.normal(size=(n, 2)))
    got = model.margins(offsets, feature, value)
    for i in (0, 4, 9, 16, 20):
        f, x = feature[offsets[i] : offsets[i + 1]], value[offsets[i] : offsets[i + 1]].astype(float)
        assert len(set(f.tolist())) == len(f)
        slow = 0.1 + sum(model.w[a] * v for a, v in zip(f, x))
        slow += sum(model.v[f[a]] @ model.v[f[b]] * x[a] * x[b] for a in range(len(f)) for b in range(a))
        assert math.isclose(slow, got[i], rel_tol=1e-4, abs_tol=1e-4)


def test_fit_learns_a_pair():
    """Two features that only together make a difference: weights alone cannot tell, factors can."""
    rng = random.Random(1)
    rows_, labels = [], []
    for _ in range(400):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows_.append([10 if a else 11, 20 if b else 21])
        labels.append(float(a == b))
    offsets = np.arange(0, 801, 2)
    model = fit(offsets, np.array(rows_).ravel(), np.ones(800, np.float32), np.array(labels), passes=300)
    margins = model.margins(offsets, np.array(rows_).ravel(), np.ones(800, np.float32))
    assert np.mean((margins > 0) == (np.array(labels) > 0)) > 0.95


def test_repeated_ids_count_once(spark, tables):
    """An id that fills the table takes one place of the sample, with one text."""
    free = [i for i in range(400) if not held(i)][:12]
    data = [(i, f"row {i} has words of its own {i * i} " * 40, "xx") for i in free]
    again = [(free[0], data[0][1] + f" again {k}", "xx") for k in range(300)]
    schema = "doc_id long, text string, lang string"
    alone = learn(spark.createDataFrame(data, schema), samples=4, contexts=2)
    copies = spark.createDataFrame(data + again + data + [(None, "no id " * 50, "xx")], schema).repartition(7)
    assert learn(copies, samples=4, contexts=2) == alone

    docs, labels = tables
    some = docs.where("doc_id % 3 = 0").select("doc_id", "text")
    model = learn_quality(some, labels, sample=60)
    one = labels.join(some, "doc_id").orderBy("doc_id").select(labels.columns).limit(1)
    copies = some.unionByName(some.join(one.select("doc_id"), "doc_id"))
    for _ in range(3):
        copies = copies.unionByName(copies)
    same = learn_quality(copies, labels.unionByName(one).unionByName(one), sample=60)
    assert model.w0 == same.w0 and np.array_equal(model.w, same.w) and np.array_equal(model.v, same.v)
