import random
from collections import Counter

import numpy as np
import pytest
from cases import SCHEMA, rows

import sitrec.llm.suffix_dedup as sd
from sitrec.llm.suffix_dedup import Contexts, Hasher, anchors, repeated_windows, suffix_dedup


def expected(texts, length):
    """Removed spans of each text, by counting every window."""
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        flags = np.concatenate([[0], (np.cumsum(gone)[: len(t)] > 0).astype(int), [0]])
        edges = np.flatnonzero(np.diff(flags))
        out.append(list(zip(edges[::2].tolist(), edges[1::2].tolist())))
    return out


def near_copies(seed, n=60):
    """Texts that share passages of all lengths around the limit, in changing surroundings."""
    rng = random.Random(seed)
    letters = "abcdé"
    passages = ["".join(rng.choice(letters) for _ in range(rng.randrange(20, 90))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.6 else "".join(rng.choice(letters) for _ in range(30)) for _ in range(4)]
        text = "".join(parts)
        cut = rng.randrange(len(text))
        texts.append(text[cut:] if rng.random() < 0.5 else text)
    texts += ["ab" * 60, "ab" * 70 + "c", "a" * 100, "a" * 39, "a" * 40, "x" + "a" * 40]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("many", [20_000, 1])  # sorted, and counted as for crowded anchors
def test_against_brute_force(spark, seed, many):
    texts = near_copies(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in suffix_dedup(docs, length=40, gram=9, many=many).collect()}
    raw = [t.encode() for t in texts]
    for i, spans in enumerate(expected(raw, 40)):
        assert [(s.begin, s.end) for s in got[i].spans] == spans
        kept = b"".join(raw[i][a:b] for a, b in zip([0] + [e for _, e in spans], [b for b, _ in spans] + [len(raw[i])]))
        assert bytes(got[i].kept) == kept
        assert got[i].n_bytes == len(raw[i]) and got[i].n_removed == len(raw[i]) - len(kept)


def test_awkward_rows(spark):
    data = rows()
    got = suffix_dedup(spark.createDataFrame(data, SCHEMA)).collect()
    spans = expected([(r[1] or "").encode() for r in data], 400)
    want = sorted(((d, len((t or "").encode()), s) for (d, t, *_), s in zip(data, spans)), key=str)
    assert sorted(((r.doc_id, r.n_bytes, [(s.begin, s.end) for s in r.spans]) for r in got), key=str) == want
    assert suffix_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_blocks_of_a_long_text_join(monkeypatch):
    rng = np.random.default_rng(5)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    ends = np.array([1200, 1200, 1230, 5000])
    whole = anchors(data, ends, Hasher(0, 10_000), 40, 9)
    monkeypatch.setattr(sd, "STARTS", 64)
    for a, b in zip(whole, anchors(data, ends, Hasher(0, 10_000), 40, 9)):
        assert np.array_equal(a, b)
    text, anchor, first, last, _ = whole
    covered = sum(int(b - a + 1) for a, b in zip(first, last))
    assert covered == sum(max(0, n - 39) for n in np.diff(np.concatenate([[0], ends])))
    assert np.all(last <= anchor) and np.all(anchor + 9 <= first + 40)  # the anchor lies in every window of its segment


def test_order_is_that_of_suffixes():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    at = rng.integers(0, 380, 60)
    group = np.sort(rng.integers(0, 3, 60))
    reach = np.minimum(400 - at, 50)
    order = Contexts(data, at, reach, 1, Hasher(1, 401)).order(group)
    raw = data.tobytes()
    assert order.tolist() == sorted(range(60), key=lambda i: (group[i], raw[at[i] : at[i] + reach[i]], i))
    back = Contexts(data, at, np.minimum(at, 50), -1, Hasher(1, 401)).order(group)
    assert back.tolist() == sorted(range(60), key=lambda i: (group[i], raw[max(0, at[i] - 50) : at[i]][::-1], i))


def test_collisions_are_found():
    """With a hasher that finds all strings equal, verification draws another."""

    class Blind(Hasher):
        def __init__(self, seed, most):
            super().__init__(seed, most)
            self.blind = seed == 1

        def of(self, sums, begin, end):
            h = super().of(sums, begin, end)
            return h * np.uint64(0) if self.blind else h

    data = np.frombuffer(b"abcdefgh" + b"abcdzfgh" + b"abcdefgh", np.uint8)
    anchor, left, right, group = np.array([0, 8, 16]), np.zeros(3, int), np.full(3, 8), np.zeros(3, int)
    saved, sd.Hasher = sd.Hasher, Blind
    try:
        least, most = repeated_windows(data, anchor, left, right, group, 8)
    finally:
        sd.Hasher = saved
    assert least.tolist() == [0, -1, 0] and most.tolist() == [0, -1, 0]
