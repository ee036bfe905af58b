"""Scalar expressions shared by operators and reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rounded(value: Column, places: int = 6) -> Column:
    """Round for comparison; adding 0.0 turns a negative zero into zero."""
    return F.round(value, places) + F.lit(0.0)


def total(parts: Sequence[Column]) -> Column:
    return reduce(add, parts)


def plus(parts: Sequence[str]) -> str:
    """Sum of SQL expressions; wide arithmetic is built as text, one parse instead of many calls."""
    return " + ".join(parts) if parts else "0D"


def known(name: str) -> str:
    """A number, zero where it is missing, as a SQL expression."""
    return f"coalesce({name}, 0D)"


def clamp(value: Column, low, high) -> Column:
    return F.greatest(F.least(value, F.lit(high)), F.lit(low))


def sigmoid(value: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-value))


def dot(left: Column, right: Column) -> Column:
    """Inner product of two array columns."""
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)


def rescale(value: Column, low: Column, high: Column) -> Column:
    """Map [low, high] to [-1, 1]; NULL where the range is empty."""
    return F.try_divide(value - low, high - low) * 2 - 1


def single(df: DataFrame, value: Column) -> Column:
    """One aggregate of a whole table, as a scalar subquery (one row, no join)."""
    return df.agg(value).scalar()


def math_scalars(value: Column) -> dict[str, Column]:
    """The arithmetic used by reports, as named expressions of one column."""
    return {
        "rounded": F.round(value),
        "root": F.sqrt(F.abs(value)),
        "squared": F.pow(value, F.lit(2.0)),
        "magnitude": F.abs(value),
        "logistic": sigmoid(value),
        "sign": F.signum(value),
        "clamped": clamp(value, -1.0, 1.0),
    }
