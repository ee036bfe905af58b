"""Near copies against plain Jaccard similarity of whole texts."""

import random

import numpy as np
from cases import SCHEMA, rows, words
from pyspark.sql import functions as F
from test_simhash import components

import corpus_pipeline


def sets(text):
    w = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def linked(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def near(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted(r.doc_id for r in corpus_pipeline.near(spark, docs, "").collect())


def pairs(seed, n, length, edits):
    """Texts and edited copies of them, without any other likeness."""
    rng, out = random.Random(seed), []
    for i in range(n):
        w = [f"w{i}x{rng.randrange(9999)}" for _ in range(length)]
        other = list(w)
        for at in rng.sample(range(length), rng.choice(edits)):
            other[at] = f"e{i}x{at}"
        out += [" ".join(w), " ".join(other)]
    return out


def test_recall_and_false_links(spark):
    """Similarities from 0.6 to 0.95: what is kept is what plain Jaccard similarity says."""
    texts = pairs(1, 60, 200, (2, 4, 5, 6, 7, 8)) + pairs(2, 40, 30, (1, 2)) + pairs(3, 40, 14, (1,))
    family = [f"f{k}" for k in range(150)]
    for k in range(20):  # a chain of small edits
        family = list(family)
        family[7 * k] = f"g{k}"
        texts.append(" ".join(family))
    tops = components([sets(t) for t in texts], linked)
    assert 0 < len(texts) - len(set(tops)) and near(spark, texts) == sorted(set(tops))


def test_short_texts(spark):
    """A word more: 7 of 8 shingles are common."""
    texts = []
    for i in range(60):
        w = [f"s{i}x{k}" for k in range(9 + i % 16)]
        texts += [" ".join(w), " ".join([*w, f"s{i}more"]), " ".join(w[:4])]
    tops = components([sets(t) for t in texts], linked)
    assert near(spark, texts) == sorted(set(tops)) and len(set(tops)) <= 120 + 3


def test_edges(spark):
    def near_of(data):
        return corpus_pipeline.near(spark, spark.createDataFrame(data, SCHEMA), "")

    assert near_of([]).collect() == []
    data = rows()
    got = near_of(data)
    assert "_row" not in got.columns and {"kept", "spans"} <= set(got.columns)
    tops = components([frozenset(sets(r[1])) for r in data], linked)
    best = {}
    for i, t in enumerate(tops):
        best[t] = min(best.get(t, (True, 0, 0)), (data[i][0] is None, data[i][0] or 0, i)) if t in best else (
            data[i][0] is None, data[i][0] or 0, i)
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(str(data[i][0]) for _, _, i in best.values())


def test_fingerprints_propose(spark, monkeypatch):
    """Without any band in common, near copies are found by their fingerprints, and only those that really are."""
    from sitrec.llm import near_copies, set_dedup
    from sitrec.llm.simhash import near_classes

    texts = pairs(5, 30, 400, (1,)) + pairs(6, 10, 40, (12,))
    monkeypatch.setattr(set_dedup, "band_keys", lambda regs, rows: np.random.default_rng().integers(0, 1 << 63, (len(regs), 1), np.uint64))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = near_classes(docs).where("doc_id = component_id").count()
    assert found < 80 and near(spark, texts) == sorted(set(components_of(docs, texts)))
    monkeypatch.setattr(near_copies, "row_classes", lambda plain: plain.select("_row", F.lit(7).alias("alike")))
    tops = components([sets(t) for t in texts], linked)
    assert set(near(spark, texts)) >= set(tops)


def components_of(docs, texts):
    """The smallest id of each class that both fingerprints and sets link."""
    from sitrec.llm.simhash import near_classes

    return [r.component_id if linked(sets(texts[r.component_id]), sets(texts[r.doc_id])) else r.doc_id for r in near_classes(docs).collect()]


def test_centres_of_one_class_are_compared_as_pairs_of_centres(spark, monkeypatch):
    """A large group of near copies: the join by centre has a row a pair of centres, not one for each node and centre."""
    from sitrec.llm import set_dedup

    seen = []

    def joined(rows, facts, keys, how="inner", real=set_dedup.spread_join):
        if how == "left" and keys in (["u"], ["v"], ["near"]):
            seen.append(rows.count())
        return real(rows, facts, keys, how)

    monkeypatch.setattr(set_dedup, "spread_join", joined)
    rng, base = random.Random(5), [f"w{k}" for k in range(120)]
    texts = []
    for i in range(400):
        own = list(base)
        for at in rng.sample(range(120), 2):
            own[at] = f"e{i}x{at}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = set_dedup.near_sets(docs, shingle=3).collect()
    assert seen and max(seen) < len(texts)
    assert {r.component_id for r in found} == {0}
