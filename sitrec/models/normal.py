"""Least squares for many users (or items) at once: one half of an alternation, and users who rate now.

A user's regularised normal equations are sums over the user's ratings.  Every task sums up what it has, so a
user's ratings need not be in one place, however many there are; what moves is one matrix for each user and
task.  The small systems are solved where the sums meet.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrec.models.als import ITEM_I, USER_I
from sitrec.operators.joins import lookup_join
from sitrec.storage import written


def _pairs(rank: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(rank) for j in range(i, rank)]


def _columns(factors: DataFrame, rank: int) -> list[Column]:
    return [F.col("features")[f].cast("double").alias(f"f{f}") for f in range(rank)]


def gram(factors: DataFrame, rank: int) -> np.ndarray:
    """Sum of the outer products of all factors."""
    sums = factors.select(*_columns(factors, rank)).agg(*(F.sum(F.col(f"f{i}") * F.col(f"f{j}")).alias(f"g{i}_{j}") for i, j in _pairs(rank)))
    out = np.zeros((rank, rank))
    for (i, j), value in zip(_pairs(rank), sums.first()):
        out[i, j] = out[j, i] = value or 0.0
    return out


def normal_sums(
    ratings: DataFrame,
    factors: DataFrame,
    key: str,
    other: str,
    rank: int,
    spread: Column,
    implicit: bool = False,
    alpha: float = 1.0,
) -> DataFrame:
    """``key, n, g0_0, g0_1, .., b0, ..``: upper triangle and right side of every key's normal equations.

    ``factors`` (``id, features``) belong to ``other``.  Ratings that are null, or whose ``other`` has no factors, are
    left out; equal pairs count each.  For implicit feedback a rating r is a preference of 1 (0 unless r > 0) with
    the confidence 1 + alpha |r|; the sums hold what exceeds confidence 1, and ``n`` counts preferences.
    ``spread`` tells rows of one ``other`` apart, should its factors have to be joined by shuffle.
    """
    lookup = factors.select(F.col("id").alias(other), *_columns(factors, rank))
    rows = lookup_join(ratings.where(F.col("rating").isNotNull() & F.col(key).isNotNull()), lookup, other, spread, how="inner")
    value = F.col("rating").cast("double")
    more, liked = F.abs(value) * alpha, value > 0
    weight = more if implicit else F.lit(1.0)
    target = F.when(liked, more + 1.0).otherwise(0.0) if implicit else value
    rows = rows.select(key, weight.alias("_w"), target.alias("_t"), (liked if implicit else F.lit(True)).alias("_counts"), *(f"f{f}" for f in range(rank)))
    return rows.groupBy(key).agg(
        F.count_if("_counts").alias("n"),
        *(F.sum(F.col("_w") * F.col(f"f{i}") * F.col(f"f{j}")).alias(f"g{i}_{j}") for i, j in _pairs(rank)),
        *(F.sum(F.col("_t") * F.col(f"f{f}")).alias(f"b{f}") for f in range(rank)),
    )


def solved(sums: DataFrame, key: str, rank: int, reg: float, base: np.ndarray | None = None) -> DataFrame:
    """``id, features``: the solution of every key's equations, with ``reg`` times ``n`` on the diagonal and ``base`` added.

    A system without a unique solution gets the one of least length.
    """
    pairs, names = _pairs(rank), [*(f"g{i}_{j}" for i, j in _pairs(rank)), *(f"b{f}" for f in range(rank))]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(2 + c).to_numpy(zero_copy_only=False) for c in range(len(names))]
            a, b = np.empty((batch.num_rows, rank, rank)), np.stack(columns[len(pairs) :], axis=1)
            for (i, j), values in zip(pairs, columns):
                a[:, i, j] = a[:, j, i] = values
            a += (reg * batch.column(1).to_numpy().astype(float))[:, None, None] * np.eye(rank)
            if base is not None:
                a += base
            try:
                x = np.linalg.solve(a, b[:, :, None])[:, :, 0]
            except np.linalg.LinAlgError:
                x = (np.linalg.pinv(a, hermitian=True) @ b[:, :, None])[:, :, 0]
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * rank
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel()))], names=["id", "features"]
            )

    kind = sums.schema[key].dataType.simpleString()
    return sums.select(key, "n", *names).mapInArrow(solve, f"id {kind}, features array<double>")


def half_step(
    ratings: DataFrame,
    factors: DataFrame,
    key: str,
    other: str,
    rank: int,
    reg: float,
    spread: Column,
    implicit: bool = False,
    alpha: float = 1.0,
) -> DataFrame:
    """``id, features`` of every ``key`` with a usable rating, best for the given ``factors`` of ``other``.

    The regularisation is weighted by the number of ratings, as in Spark's ALS.
    """
    sums = normal_sums(ratings, factors, key, other, rank, spread, implicit, alpha)
    return solved(sums, key, rank, reg, gram(factors, rank) if implicit else None)


def fold_in(
    ratings: DataFrame, item_factors: DataFrame, rank: int, reg: float, spread: Column, key: str = USER_I, other: str = ITEM_I, **how
) -> DataFrame:
    """Factors of users who rate now, all in one aggregate, against the item factors of a model that stays as it is."""
    return half_step(ratings, item_factors, key, other, rank, reg, spread, **how)


def first_factors(ids: DataFrame, key: str, rank: int, seed: int) -> DataFrame:
    """``id, features`` from hashes, the same on every attempt."""
    cells = [(F.pmod(F.xxhash64(F.lit(seed), F.lit(f), key), F.lit(1 << 20)) + 0.5) / float(1 << 20) for f in range(rank)]
    return ids.select(F.col(key).alias("id"), F.array(*(c / rank**0.5 for c in cells)).alias("features"))


def alternate(
    ratings: DataFrame,
    rank: int,
    reg: float,
    iterations: int,
    spread: Column,
    implicit: bool = False,
    alpha: float = 1.0,
    seed: int = 0,
    keys: Sequence[str] = (USER_I, ITEM_I),
) -> tuple[DataFrame, DataFrame]:
    """User and item factors after ``iterations`` alternations of both half-steps, users first.

    Nobody's ratings have to fit into one block.  Factors are written after every half-step, so a lost executor
    costs one at most.
    """
    user, item = keys
    items = written(first_factors(ratings.select(item).distinct().where(F.col(item).isNotNull()), item, rank, seed), "items")
    users = items.limit(0)
    for _ in range(iterations):
        users = written(half_step(ratings, items, user, item, rank, reg, spread, implicit, alpha), "users")
        items = written(half_step(ratings, users, item, user, rank, reg, spread, implicit, alpha), "items")
    return users, items
