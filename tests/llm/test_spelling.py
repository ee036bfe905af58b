"""Spelling variants against brute force over all deletions of the words."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import SCHEMA, rows

from sitrec.llm import spelling
from sitrec.llm.count_trie import CountTrie, one_edit
from sitrec.llm.queries import QUERIES
from sitrec.llm.spelling import spelling_forms

RUN = re.compile("[A-Za-zÀ-ÿ]+")
NAMES = ["word", "form", "root", "n", "n_near", "form_n"]


def counted(pairs, length=6, count=5, every=199):
    n = Counter()
    for doc_id, text in pairs:
        for run in RUN.findall(text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if every and h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= length and c >= count}


def expected(pairs, ratio=5, **how):
    n = counted(pairs, **how)
    shorter = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            shorter[w[:i] + w[i + 1 :], i].add(w)  # replaced at i
            shorter[w[:i] + w[i + 1 :], None].add(w)
    near = {w: set() for w in n}
    for w in n:
        for i in range(len(w)):
            near[w] |= shorter[w[:i] + w[i + 1 :], i] - {w}
            if w[:i] + w[i + 1 :] in n:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select(*NAMES).collect()), key=str)


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = expected([(r.doc_id, r.text) for r in table.collect()])
    assert got(QUERIES["op13_spelling_variants"](spark, sf_dir)) == want
    assert sum(r[1] is not None for r in want) and sum(r[4] for r in want)


def test_awkward_rows(spark):
    data = rows()
    texts = [(r[0], r[1]) for r in data]
    for how in ({}, {"every": 2}, {"every": 0}):
        ours = {"least_length": how.get("length", 6)} | how
        assert got(spelling_forms(spark.createDataFrame(data, SCHEMA), **ours)) == expected(texts, **how)
    short = spelling_forms(spark.createDataFrame(data, SCHEMA), least_length=1, least_count=1, ratio=2, every=3)
    assert got(short) == expected(texts, length=1, count=1, ratio=2, every=3)
    assert got(spelling_forms(spark.createDataFrame([], SCHEMA))) == []
    with pytest.raises(ValueError):
        spelling_forms(spark.createDataFrame([], SCHEMA), ratio=1)


def random_words(seed, n, letters="anÀ", longest=9):
    rng = np.random.default_rng(seed)
    return sorted({"".join(rng.choice(list(letters), rng.integers(6, longest))) for _ in range(n)})


@pytest.mark.parametrize("words_at_once,asking,front", [(1 << 13, 1 << 15, 1 << 16), (7, 11, 5)])
def test_dense_words(spark, monkeypatch, words_at_once, asking, front):
    """Few letters, so that places of the trie are full: divided places and small fronts give the same pairs."""
    monkeypatch.setattr(spelling, "WORDS", words_at_once)
    monkeypatch.setattr(spelling, "ASKING", asking)
    monkeypatch.setattr("sitrec.llm.count_trie.FRONT", front)
    words = random_words(1, 300)
    texts = [" ".join(w for k, w in enumerate(words) for _ in range(1 + k % 9 * 4)), "ANNA ANNANNA annaÀna", None, ""]
    ours = spelling_forms(frame(spark, texts), least_count=1, ratio=3, every=7)
    assert got(ours) == expected(list(enumerate(texts)), count=1, ratio=3, every=7)


def test_ties_and_chains(spark):
    """Equal counts: the first form; forms of forms; long words."""
    counts = {"colour": 5, "colours": 40, "colourz": 40, "coloursa": 250, "zzzzzzz": 5, "y" * 300: 30, "y" * 299: 5, "y" * 150 + "x" + "y" * 149: 6}
    texts = [" ".join([w] * c) for w, c in counts.items()]
    ours = got(spelling_forms(frame(spark, texts), every=0))
    assert ours == expected(list(enumerate(texts)), every=0)
    facts = {r[0]: r[1:] for r in ours}
    assert facts["colour"][:2] == ("colours", "coloursa") and facts["zzzzzzz"] == (None, "zzzzzzz", 5, 0, None)
    assert facts["y" * 299][0] == "y" * 300 and facts["y" * 150 + "x" + "y" * 149][3] == 2


def test_trie():
    """All pairs within the budget, found by paths alone, hold all pairs of one edit."""
    words = [w.encode("latin-1") for w in random_words(2, 200)]
    order = list(range(13))
    ones = np.ones(len(words), int)
    trie = CountTrie(words, order)
    found = {(a, b) for x, y in trie.one_edit_away(words, ones, ones) for a, b in zip(x.tolist(), y.tolist())}
    assert found == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one_edit(a, b)} and found
    none = {(a, b) for x, y in trie.one_edit_away(words, 0 * ones, 0 * ones) for a, b in zip(x.tolist(), y.tolist())}
    assert none < found and list(CountTrie([], order).one_edit_away(words, ones, ones)) == []
