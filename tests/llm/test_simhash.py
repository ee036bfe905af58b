import random

import pytest
from cases import SCHEMA, rows, words
from xxhash import xxh64_intdigest

import sitrec.llm.simhash as simhash
from sitrec.llm.components import connected_components
from sitrec.llm.simhash import fingerprint, near_classes, near_dedup, segments


def slow_fingerprint(text, shingle=4, seeds=1):
    w = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    shingles = [" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    out = []
    for k in range(seeds):
        hashes = [xxh64_intdigest(s.encode(), 42 + k) for s in shingles]
        out.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    return out, len(shingles)


def components(prints, linked):
    top = list(range(len(prints)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if linked(prints[i], prints[j]):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return [find(i) for i in range(len(prints))]


def differing(a, b):
    return sum((x ^ y).bit_count() for x, y in zip(a, b))


def edited(seed, n=50):
    """Texts in families of small edits, so that fingerprints lie close to each other in chains."""
    rng = random.Random(seed)
    out = []
    for _ in range(n // 10):
        w = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(60, 200))]
        for _ in range(10):
            w = list(w)
            w[rng.randrange(len(w))] = f"e{rng.randrange(9)}"
            out.append(" ".join(w))
    return out


def smallest(tops, ids):
    best = {}
    for t, i in zip(tops, ids):
        if i is not None:
            best[t] = min(best.get(t, i), i)
    return [best.get(t) for t in tops]


def test_against_brute_force(spark):
    data = rows() + [(1000 + i, t, "en", "a", 1, True, "k", 1, 0.5, 7, "s", "h") for i, t in enumerate(edited(1, 100))]
    prints = [slow_fingerprint(r[1])[0] for r in data]
    tops = components(prints, lambda a, b: differing(a, b) <= 4)
    assert len(set(tops)) < len({p[0] for p in prints})  # some differ and are linked
    want = sorted(((r[0], f"{p[0]:016x}", c) for r, p, c in zip(data, prints, smallest(tops, [r[0] for r in data]))), key=str)
    got = near_classes(spark.createDataFrame(data, SCHEMA)).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == want
    assert sum(r.kept for r in got) == len(set(tops))


def test_wide_fingerprints(spark):
    texts = edited(2, 80) + ["", "a b", "c d", "one two three four five six"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    prints = [slow_fingerprint(t, 5, 2) for t in texts]
    segs = segments(7)

    def linked(a, b):
        (p, n), (q, m) = a, b
        if p == q:
            return True
        near = any(((p[0] ^ q[0]) >> s & (1 << w) - 1).bit_count() <= 1 for s, w in segs)
        return min(n, m) >= 8 and near and differing(p, q) <= 22

    tops = components(prints, linked)
    how = {"distance": 22, "shingle": 5, "words": 2, "index_distance": 7, "least_shingles": 8}
    got = {r.doc_id: r.component_id for r in near_classes(docs, **how).collect()}
    assert [got[i] for i in range(len(texts))] == tops
    kept = near_dedup(docs, **how)
    assert kept.columns == ["doc_id", "text"] and sorted(r.doc_id for r in kept.collect()) == sorted(set(tops))


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_classes(empty).collect() == [] and near_dedup(empty).collect() == []
    kept = near_dedup(spark.createDataFrame(rows(), SCHEMA))
    assert "_row" not in kept.columns and {"kept", "spans"} <= set(kept.columns)
    one = near_classes(spark.createDataFrame([(None, None), (None, "")], "doc_id long, text string")).collect()
    assert [(r.component_id, r.fingerprint) for r in one] == [(None, "0" * 16)] * 2 and sum(r.kept for r in one) == 1


@pytest.mark.parametrize("block", [5, 40, 1 << 20])
def test_blocks_of_a_long_text(monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    for text in [r[1] for r in rows(10)][:-3] + ["  a b  c\n", "x " * 30, "abcdefghij " * 3]:
        assert fingerprint((text or "").encode(), 4) == slow_fingerprint(text)


def test_segments_cover_all_bits():
    for distance in range(12):
        parts = segments(distance)
        assert sum(w for _, w in parts) == 64 and 2 * len(parts) > distance


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = sorted({n for e in edges for n in e if e[0] != e[1]})
    tops = components(nodes, lambda a, b: (a, b) in edges or (b, a) in edges)
    assert got == {n: nodes[t] for n, t in zip(nodes, tops)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_stars_need_no_round_and_wide_ones_give_the_same(spark, monkeypatch):
    """Edges that are stars already are not written again; both forms of a round find the components."""
    from sitrec.llm import components as module

    rounds = []
    monkeypatch.setattr(module, "written", lambda df, name, real=module.written: rounds.append(name) or real(df, name))
    stars = spark.createDataFrame([(1, 5), (6, 1), (1, 7), (3, 2)], "u long, v long")
    got = {r.node: r.root for r in module.connected_components(stars).collect()}
    assert got == {1: 1, 5: 1, 6: 1, 7: 1, 2: 2, 3: 2} and not rounds

    rng = random.Random(7)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(260)] + [(9, 9), (4, 200), (200, 4)]
    edges += [(i, i + 1) for i in range(400, 440)]
    table = spark.createDataFrame(edges, "u long, v long")
    narrow = sorted((r.node, r.root) for r in module.connected_components(table).collect())
    monkeypatch.setattr(module, "share", lambda total: 1)  # a node with two neighbours is divided
    assert narrow == sorted((r.node, r.root) for r in module.connected_components(table).collect())
    top = {n: n for e in edges for n in e}
    for _ in range(60):
        for a, b in edges:
            top[a] = top[b] = min(top[a], top[b])
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert dict(narrow) == {n: top[n] for n in linked} and len(narrow) == len(linked)


def test_rounds_of_small_tables_are_gathered(spark, monkeypatch):
    """Edges of a small table are not dealt over all shuffle partitions, whether a centre is divided or not."""
    import sitrec.llm.components as module

    files = []

    def counted(df, name):
        table = written(df, name)
        files.append(len(table.inputFiles()))
        return table

    written = module.written
    monkeypatch.setattr(module, "written", counted)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)]
    settings = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        table = written(spark.createDataFrame(edges, "u long, v long"), "edges")
        for limit in (module.share(0), 8):  # a centre has 59 neighbours
            monkeypatch.setattr(module, "share", lambda total, limit=limit: limit)
            got = {r.node: r.root for r in module.connected_components(table).collect()}
            assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert files and max(files) <= module.TASKS
