"""Least squares for many keys against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitrec.models.normal import alternate, first_factors, fold_in, half_step, normal_sums, solved

SCHEMA = "row_id long, useridI int, itemidI int, rating double"


def data(seed=1, users=12, items=9, n=150):
    rng = np.random.default_rng(seed)
    rows = [(int(u), int(i), float(r)) for u, i, r in zip(rng.integers(0, users, n), rng.integers(0, items, n), rng.normal(0, 1, n).round(2))]
    rows += [(3, int(i), 0.5) for i in rng.integers(0, items, n)]  # one user with half of all rows
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], SCHEMA)


def table(spark, factors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in factors.items()], "id int, features array<double>")


def slow(rows, factors, at, reg, implicit=False, alpha=1.0):
    """Factors of one side; ``at`` is the place of the key in a rating."""
    rank = len(next(iter(factors.values())))
    everything = sum(np.outer(f, f) for f in factors.values())
    out = {}
    for key in {r[at] for r in rows if r[1 - at] in factors}:
        a, b, n = (everything.copy() if implicit else np.zeros((rank, rank))), np.zeros(rank), 0
        for r in rows:
            if r[at] != key or r[1 - at] not in factors or r[2] is None:
                continue
            f, c = factors[r[1 - at]], alpha * abs(r[2])
            a += (c if implicit else 1.0) * np.outer(f, f)
            b += ((1 + c) * (r[2] > 0) if implicit else r[2]) * f
            n += r[2] > 0 if implicit else 1
        out[key] = np.linalg.solve(a + reg * n * np.eye(rank), b)
    return out


def same(got, want):
    found = {r.id: r.features for r in got.collect()}
    assert found.keys() == want.keys()
    for key, value in want.items():
        assert found[key] == pytest.approx(value, abs=1e-9)


@pytest.mark.parametrize("implicit", [False, True])
@pytest.mark.parametrize("rank", [1, 3])
def test_half_steps(spark, implicit, rank):
    rows, rng = data(), np.random.default_rng(2)
    items = {i: rng.normal(0, 1, rank) for i in range(8)}  # item 8 has no factors
    got = half_step(frame(spark, rows), table(spark, items), "useridI", "itemidI", rank, 0.1, F.col("row_id"), implicit, 0.7)
    same(got, slow(rows, items, 0, 0.1, implicit, 0.7))
    users = {u: rng.normal(0, 1, rank) for u in range(12)}
    got = half_step(frame(spark, rows), table(spark, users), "itemidI", "useridI", rank, 0.1, F.col("row_id"), implicit, 0.7)
    same(got, slow(rows, users, 1, 0.1, implicit, 0.7))


def test_sums_are_partial(spark):
    """A user's sums are formed before the shuffle, so that half of all rows are no burden for one task."""
    rng = np.random.default_rng(3)
    items = table(spark, {i: rng.normal(0, 1, 2) for i in range(9)})
    sums = normal_sums(frame(spark, data()), items, "useridI", "itemidI", 2, F.col("row_id"))
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.index("functions=[count") < plan.index("hashpartitioning(useridI") < plan.index("partial_count")


def test_missing_and_singular(spark):
    """Nulls are left out; without regularisation the shortest solution stands for equations that have many."""
    rows = [(1, 1, 2.0), (1, 2, None), (None, 1, 1.0), (2, 5, 1.0), (3, None, 1.0)]
    items = table(spark, {1: np.array([1.0, 1.0]), 2: np.array([0.0, 1.0])})
    sums = normal_sums(frame(spark, rows), items, "useridI", "itemidI", 2, F.col("row_id"))
    assert [(r.id, r.features) for r in solved(sums, "useridI", 2, 0.0).collect()] == [(1, pytest.approx([1.0, 1.0]))]
    none = frame(spark, []).select("row_id", "useridI", "itemidI", "rating")
    assert fold_in(none, items, 2, 0.1, F.col("row_id")).collect() == []


@pytest.mark.parametrize("implicit", [False, True])
def test_alternation(spark, implicit):
    """Three alternations equal the same ones by numpy, from the same start."""
    rows = data(4)
    df = frame(spark, rows)
    users, items = alternate(df, 2, 0.1, 3, F.col("row_id"), implicit, 0.5, seed=7)
    slow_items = {r.id: np.array(r.features) for r in first_factors(df.select("itemidI").distinct(), "itemidI", 2, 7).collect()}
    for _ in range(3):
        slow_users = slow(rows, slow_items, 0, 0.1, implicit, 0.5)
        slow_items = slow(rows, slow_users, 1, 0.1, implicit, 0.5)
    same(users, slow_users)
    same(items, slow_items)
