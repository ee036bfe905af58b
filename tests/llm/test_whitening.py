"""Whitening against whole numbers and a dense eigenvalue solver."""

import numpy as np
import pytest

from sitrec.llm.queries import QUERIES
from sitrec.llm.spectral import polar_factor, spectrum
from sitrec.llm.whitening import by_component, whiten

SCHEMA = "vec_id long, embedding array<float>, n string, component string, whitened int, x binary"


def expected(rows, components=4):
    """(id, x) of usable rows, n, S, falling eigenvalues and eigenvectors of the distinct ones."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(np.float32(c)) for c in v)]
    xs = [(i, tuple(int(np.floor(256 * float(np.float32(c)))) for c in v)) for i, v in usable]
    fit = sorted({x for _, x in xs})
    lengths = {len(x): sum(len(y) == len(x) for y in fit) for x in fit}
    dims = max(lengths, key=lambda k: (lengths[k], k))
    fit, xs = [x for x in fit if len(x) == dims], [r for r in xs if len(r[1]) == dims]
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    z = np.array(fit, float) - np.array(total) / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    return xs, n, total, values[::-1][:components], vectors[:, ::-1][:, :components], float(np.trace(z.T @ z / n))


def check(got, rows):
    xs, n, total, values, vectors, trace = expected(rows)
    assert len(got) == len(xs) * len(values)
    exact = sorted((str(i), sum((n * a - s) ** 2 for a, s in zip(x, total))) for i, x in xs for _ in values)
    assert sorted((str(r.vec_id), r.deviation) for r in got) == exact
    want = {}
    for i, x in xs:
        want.setdefault(i, []).append((np.array(x) - np.array(total) / n) @ vectors / np.sqrt(values))
    signs = {}
    for r in got:
        assert r.n == n and r.identity_error <= 1e-4
        assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-9)
        target = [w[r.component - 1] for w in want[r.vec_id]]
        near = [s for s in (1, -1) if min(abs(s * r.whitened - t) for t in target) < 1e-6]
        assert near
        if len(near) == 1 and len(target) == 1:
            assert signs.setdefault(r.component, near[0]) == near[0]  # one sign for all rows


def random_rows(seed, n, dims):
    rng = np.random.default_rng(seed)
    mix = rng.standard_normal((dims, dims)) * np.linspace(1, 0.1, dims)
    return [(i, [float(c) for c in rng.standard_normal(dims) @ mix + 0.3]) for i in range(n)]


def test_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    check(QUERIES["op11_embedding_whitening"](spark, sf_dir).collect(), [(r.vec_id, r.embedding) for r in table.collect()])


def test_awkward_rows(spark):
    rows = random_rows(1, 60, 6)
    rows += [(60, None), (61, []), (62, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (63, [float("nan")] * 6), (64, [float("inf")] * 6)]
    rows += [rows[0], rows[0], (None, rows[1][1]), (3, rows[2][1]), (65, [1.0, 2.0]), (66, [-0.0] * 6), (67, [-1e-9] * 6), (68, [300.0, -700.0, 0.0, 0.0, 0.0, 0.0])]
    data = [(i, v, "n", "c", 7, b"x") for i, v in rows]
    got = by_component(whiten(spark.createDataFrame(data, SCHEMA))).collect()
    check(got, rows)
    assert {r.vec_id for r in got} >= {None, 66, 67} and not {r.vec_id for r in got} & {60, 61, 62, 63, 64, 65}


def test_copies_have_no_weight(spark):
    rows = random_rows(2, 30, 5)
    once = by_component(whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))).collect()
    hot = rows + [(0, rows[0][1])] * 400
    many = by_component(whiten(spark.createDataFrame(hot, "vec_id long, embedding array<double>"))).distinct().collect()
    assert [(r.vec_id, r.n, r.deviation) for r in sorted(once)] == [(r.vec_id, r.n, r.deviation) for r in sorted(many)]


@pytest.mark.parametrize("data", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, data):
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    assert by_component(whiten(frame)).collect() == []


def test_rank(spark):
    """Two distinct vectors have one direction."""
    frame = spark.createDataFrame([(1, [1.0, 2.0, 0.0]), (2, [3.0, 2.0, 0.0])], "vec_id long, embedding array<float>")
    got = by_component(whiten(frame)).collect()
    assert [r.component for r in got] == [1, 1] and sorted(r.whitened for r in got) == [pytest.approx(-1), pytest.approx(1)]
    assert got[0].explained == pytest.approx(1) and {r.deviation for r in got} == {512**2}


def test_large_numbers(spark):
    """Whole numbers beyond 64 bits: exact in the operator, null as a long; larger entries are held at 2^46."""
    data = [(1, [1e9, 0.0]), (2, [-1e9, 5.0]), (3, [3e38, 1.0])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    xs = [[256 * 10**9, 0], [-256 * 10**9, 1280], [1 << 46, 256]]
    total = [sum(c) for c in zip(*xs)]
    want = {i + 1: sum((3 * a - s) ** 2 for a, s in zip(x, total)) for i, x in enumerate(xs)}
    out = whiten(frame)
    assert {r.vec_id: int(r.deviation) for r in out.collect()} == want
    assert {r.deviation for r in by_component(out).collect()} == {None}


@pytest.mark.parametrize("seed,n", [(0, 1), (1, 2), (2, 9), (3, 40), (4, 64)])
def test_spectrum(seed, n):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((n, n)))
    a = (q * rng.uniform(0.01, 100, n)) @ q.T
    values, vectors = spectrum(a)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], rtol=1e-11)
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-12 and np.abs(a @ vectors - vectors * values).max() < 1e-11 * 100
    some, few = spectrum(a, 3)
    assert np.allclose(some, values[:3]) and np.allclose(np.abs(few.T @ vectors[:, :3]), np.eye(min(3, n)), atol=1e-9)


def test_spectrum_ties():
    """Equal eigenvalues, zeros and a diagonal matrix."""
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.standard_normal((8, 8)))
    for wanted in ([5, 5, 5, 2, 2, 1, 0, 0], [3] * 8, [0] * 8, [9, 8, 7, 6, 5, 4, 3, 2]):
        for a in ((q * np.array(wanted, float)) @ q.T, np.diag(np.array(wanted, float))):
            values, vectors = spectrum(a)
            assert np.allclose(values, sorted(wanted, reverse=True), atol=1e-11)
            assert np.abs(a @ vectors - vectors * values).max() < 1e-11 and np.allclose(vectors.T @ vectors, np.eye(8), atol=1e-12)


def test_polar_factor():
    rng = np.random.default_rng(6)
    q, _ = np.linalg.qr(rng.standard_normal((12, 12)))
    values = rng.uniform(-1, 1, 12)
    assert np.allclose(polar_factor((q * values) @ q.T), (q * np.sign(values)) @ q.T, atol=1e-12)
