"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrec.storage import written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def quoted(name: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns an operator is about to add; case does not matter."""
    taken = {n.lower() for n in names}
    return df.select(*(quoted(c) for c in df.columns if c.lower() not in taken))


def text_or_empty(text: str) -> Column:
    return F.coalesce(quoted(text).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is; texts of ASCII only take the faster function."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept back from every fit: crc32 of its id, as text, leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def repeatable(df: DataFrame) -> DataFrame:
    """``df`` in a form that gives its rows in the same order each time it is read.

    A scan does.  After a shuffle the order of rows may change with the columns that are asked for, so such
    a frame is written once.
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    return written(df, "rows") if "Exchange" in plan else df


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with a number ``_row`` for every row, written once.

    Numbers computed anew in each scan are not the same ones: how files are divided into partitions depends on
    the cores registered at that moment.  What joins rows by number reads them from this table.
    """
    return written(df.select("*", F.monotonically_increasing_id().alias("_row")), "rows")
