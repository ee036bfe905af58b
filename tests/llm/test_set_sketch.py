"""SetSketch registers, and near-duplicates by sets against plain Jaccard similarity of whole texts."""

import random

import numpy as np
import pyarrow as pa
import pytest
from cases import SCHEMA, rows, words
from test_simhash import components

from sitrec.llm import joins
from sitrec.llm.queries import QUERIES
from sitrec.llm.set_dedup import Rule, _entries, near_sets, sketches
from sitrec.llm.set_sketch import bits, can_be, digests, joint_similarity, most_differing, registers, shingle_sets


def plain(text, n=3):
    w = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    return frozenset(" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def expected(pairs, percent=85, n=3):
    """(doc_id, set size, smallest id reachable, kept) of (doc_id, text) rows."""
    sets = [plain(t, n) for _, t in pairs]

    def linked(a, b):
        return bool(a) and 100 * len(a & b) >= percent * len(a | b)

    tops = components(sets, linked)
    out = []
    for i, ((d, _), s) in enumerate(zip(pairs, sets)):
        ids = [pairs[k][0] for k in range(len(pairs)) if tops[k] == tops[i] and pairs[k][0] is not None] if s else [d]
        top = min(ids, default=None)
        out.append((d, len(s), top, d == top))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def family(seed, n, length, edits, tag="f"):
    """Chains of edited copies: each differs from the one before in ``edits`` words."""
    rng = random.Random(seed)
    w = [f"{tag}{k}" for k in range(length)]
    out = []
    for i in range(n):
        w = list(w)
        for at in rng.sample(range(length), edits):
            w[at] = f"{tag}{i}e{at}"
        out.append(" ".join(w))
    return out


def test_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = expected([(r.doc_id, r.text) for r in table.collect()])
    assert got(QUERIES["op12_minhash_sets"](spark, sf_dir)) == want
    assert any(not r[3] for r in want)


def test_awkward_rows(spark):
    data = rows()
    assert got(near_sets(spark.createDataFrame(data, SCHEMA))) == expected([r[:2] for r in data])
    assert near_sets(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("together", [512, 3])
def test_links_around_the_limit(spark, monkeypatch, together):
    """Similarities from 0.7 to 0.99, short texts, groups of copies; small parts for frequent keys give the same."""
    monkeypatch.setattr(joins, "LEAST", together)
    texts = family(1, 30, 100, 1) + family(2, 30, 100, 2, "g") + family(3, 30, 60, 3, "h") + family(4, 20, 14, 1, "s")
    for k in range(1, 9):
        w = [f"t{k}x{j}" for j in range(k)]
        texts += [" ".join(w), " ".join([*w, "more"]), " ".join(w).upper(), " ".join(w[:-1])]
    texts += [texts[0]] * 40 + [None, "", " \n "] * 5
    random.Random(0).shuffle(texts)
    want = expected(list(enumerate(texts)))
    assert got(near_sets(frame(spark, texts))) == want
    assert len({r[2] for r in want}) < len(want) - 60


def test_common_opening(spark):
    """Thousands of unlike texts with one opening: candidates stay near the number of texts."""
    rng = random.Random(5)
    opening = "these ten words stand at the beginning of every text"
    texts = [f"{opening} " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(11)) for _ in range(5000)]
    rule = Rule(5, 80, 6, 42)
    held = frame(spark, texts).selectExpr("doc_id", "doc_id as _row", "text")
    nodes = sketches(held, rule).withColumnRenamed("doc_id", "id")
    counts = _entries(nodes, rule).groupBy("key").count().where("count > 1").selectExpr("sum(count * (count - 1) / 2)").first()[0]
    assert (counts or 0) < 12 * len(texts)
    assert all(r.kept for r in near_sets(frame(spark, texts[:2000] + [texts[0] + " x"]), 5, 80, 6, 42).collect() if r.doc_id < 2000)


def sets_of(texts, n=3):
    return shingle_sets(pa.array(texts, pa.string()), n)


def test_shingles():
    texts = [t or "" for _, t, *_ in rows()] + ["a b", "a b ", " a  b", "a", "a b c", "b c a b c", "x y z x y z x y"]
    for n in (1, 3, 5):
        values, first = sets_of(texts, n)
        assert np.diff(first).tolist() == [len(plain(t, n)) for t in texts]
        found = {}
        for t, a, b in zip(texts, first[:-1], first[1:]):
            assert found.setdefault(plain(t, n), values[a:b].tobytes()) == values[a:b].tobytes()
        assert len(set(found.values())) == len(found)
        low, high = digests(values, first)
        assert len({(*k,) for k in zip(low.tolist(), high.tolist())}) == len(found)


def test_registers_merge():
    """Registers of a union are the larger ones of both sets; an empty set has zeros."""
    rng = np.random.default_rng(1)
    a, b = (np.unique(rng.integers(0, 1 << 63, n, np.uint64)) for n in (300, 500))
    union = np.unique(np.concatenate([a, b]))
    ends = np.cumsum([0, len(a), 0, len(b), len(union)])
    ra, none, rb, both = registers(np.concatenate([a, b, union]), ends, 256)
    assert (np.maximum(ra, rb) == both).all() and not none.any()


@pytest.mark.parametrize("share,sizes", [(0.0, (400, 500)), (0.5, (900, 700)), (0.85, (900, 1000)), (1.0, (600, 600))])
def test_estimate(share, sizes):
    """The likeliest similarity is near the true one, the true one is never dropped, and few bits differ."""
    rng = np.random.default_rng(7)
    regs, truth = [], []
    for _ in range(60):
        common = int(round(share * sum(sizes) / (1 + share)))
        common = min(common, *sizes)
        pool = rng.integers(0, 1 << 63, sum(sizes) - common, np.uint64)
        a, b = np.unique(pool[: sizes[0]]), np.unique(pool[sizes[0] - common :])
        regs.append(registers(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 192))
        truth.append(len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    first, second = np.array([r[0] for r in regs]), np.array([r[1] for r in regs])
    n = [np.full(60, float(s)) for s in sizes]
    estimate = joint_similarity((first > second).sum(axis=1), (first < second).sum(axis=1), 192, n[0] / sum(n))
    assert abs(estimate.mean() - np.mean(truth)) < 0.02 and np.abs(estimate - truth).max() < 0.15
    assert can_be(first, second, *n, min(truth)).all()
    if share < 0.6:
        assert not can_be(first, second, *n, 0.9).any()
    words = bits(first) ^ bits(second)
    differ = np.array([sum(int(x).bit_count() for x in row) for row in words])
    assert (differ <= most_differing(min(truth), 192)).all()


def test_edited_family(spark):
    """Copies of one text with a few to many edits each: some are linked in chains, many with nothing."""
    rng, base, texts = random.Random(9), [f"b{k}" for k in range(150)], []
    for i in range(150):
        w = list(base)
        for at in rng.sample(range(150), rng.randrange(0, 16)):
            w[at] = f"x{i}y{at}"
        texts.append(" ".join(w))
    want = expected(list(enumerate(texts)))
    assert got(near_sets(frame(spark, texts))) == want
    assert 20 < sum(r[3] for r in want) < 140


@pytest.mark.parametrize("percent", [80, 85])
def test_prefix(spark, percent):
    """Linked sets share one of the first members of both in order of rarity, and the first are as many as stated."""
    rule = Rule(3, percent, 6, 42)
    longest = 400
    sizes = spark.range(1, longest + 1).select("id", rule.prefix("id").alias("n")).collect()
    prefix = {r.id: r.n for r in sizes}
    assert all(prefix[s] == s - -(-percent * s // 100) + 1 for s in range(1, longest + 1))
    rng, met = random.Random(percent), 0
    for _ in range(3000):
        rarity = {k: (rng.randrange(4), k) for k in range(longest)}
        a = set(rng.sample(range(longest), rng.randrange(1, 120)))
        b = set(rng.sample(sorted(a), max(1, len(a) - rng.randrange(len(a) // 8 + 2))))
        b |= set(rng.sample(range(longest), rng.randrange(len(a) // 8 + 2)))
        if 100 * len(a & b) >= percent * len(a | b):
            first = [set(sorted(x, key=rarity.get)[: prefix[len(x)]]) for x in (a, b)]
            assert first[0] & first[1]
            met += 1
    assert met > 300


def test_sketches_go_before_classes(spark, monkeypatch):
    """Registers are on disk once, in the nodes, while classes are sought."""
    import os

    from sitrec.llm import set_dedup
    from sitrec.storage import shared_folder

    def tables():
        return {n for n in os.listdir(shared_folder(spark).removeprefix("file:")) if n.startswith("sketches-")}

    before, seen, real = tables(), [], set_dedup._classes
    monkeypatch.setattr(set_dedup, "_classes", lambda *a: seen.append(tables() - before) or real(*a))
    words = " ".join(f"w{i}" for i in range(200))
    docs = spark.createDataFrame([(1, words), (2, words + " end"), (3, "other words here"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in set_dedup.near_sets(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4} and seen == [set()]
