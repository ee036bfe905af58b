"""Each stage against a plain computation on the rows it was given."""

import re
from collections import Counter, defaultdict

import pytest
from test_mixing import drawn
from test_near_copies import sets as shingles
from test_simhash import components

import corpus_pipeline
from sitrec.llm.language import Classifier, learn


@pytest.fixture(scope="module")
def steps(spark, sf_dir, tmp_path_factory):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return sorted(df.collect(), key=lambda r: (r.doc_id, r.text))


def test_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "mixing", "packing"]
    for df in steps[1:5]:
        assert df.dtypes == steps[0].dtypes


def test_language(steps):
    classifier = Classifier(learn(steps[0]))
    want = [r for r in rows(steps[0]) if r.text and re.search(r"[^\W\d_]", r.text) and not classifier.predict(r.text)[2]]
    assert rows(steps[1]) == want and len(want) > 0.95 * steps[0].count()


def test_exact(steps):
    last = {}
    for r in rows(steps[1]):
        last[re.sub("[A-Z]", lambda m: m[0].lower(), r.text)] = r
    assert rows(steps[2]) == sorted(last.values(), key=lambda r: (r.doc_id, r.text)) and steps[2].count() < steps[1].count()


def test_near(steps):
    """What stays is the first of each group that plain Jaccard similarity of five-word shingles links."""
    given = rows(steps[2])
    sets = [shingles(r.text) for r in given]
    tops = components(sets, lambda a, b: a == b or 5 * len(a & b) >= 4 * len(a | b))
    assert rows(steps[3]) == [given[i] for i in sorted(set(tops))]
    assert steps[3].count() < len(given)


def test_mixing(steps):
    given = rows(steps[3])
    volume = Counter()
    for r in given:
        volume[r.source] += len(r.text)
    every = sum(volume.values())
    want = Counter()
    for r in given:
        want[r.doc_id] += drawn(r.doc_id, 1.0 * (1.0 * every / len(volume)) / volume[r.source])
    assert Counter(r.doc_id for r in steps[4].collect()) == +want


def test_packing(steps):
    packed = steps[5].collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r.doc_id for r in steps[4].collect())
    bins = defaultdict(list)
    for r in packed:
        bins[r.sequence_id].append((r.offset, r.length))
    for content in bins.values():
        end = 0
        for offset, length in sorted(content):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(bins) <= 1.05 * sum(r.length for r in packed) / 4096 + 1


def test_run(spark, sf_dir, steps):
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted(r[:5] for r in map(tuple, got.collect())) == sorted(r[:5] for r in map(tuple, steps[5].collect()))
