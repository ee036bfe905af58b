"""Indexes and contextual features.

Index and dictionary tables stay DataFrames: users and items grow with the data, so their labels are
never brought to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrec.operators.joins import BROADCAST_BYTES, hot_of_counts, lookup_join
from sitrec.operators.ordering import numbered
from sitrec.sources.ratings import CONTEXTS, ITEM, USER

ENCODED = (USER, ITEM, *CONTEXTS)


def index_table(df: DataFrame, column: str, order: str = "frequencyDesc") -> DataFrame:
    """``<column>, idx``: 0-based index of each value, most frequent first or alphabetical.

    Equal frequencies are ordered by label.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    if order == "frequencyDesc":
        keys = (F.col("n").desc(), F.col(column).asc())
    elif order == "alphabetAsc":
        keys = (F.col(column).asc(),)
    else:
        raise ValueError(f"unknown order {order!r}")
    return numbered(counts, *keys).select(column, "idx", "n")


def string_index(df: DataFrame, column: str, output: str, index: DataFrame, spread: Column) -> DataFrame:
    """Add the index of a column's value as a double; NULL for a value not in the index."""
    lookup = index.select(column, F.col("idx").cast("double").alias(output))
    return lookup_join(df, lookup, column, spread, hot=lambda: hot_of_counts(index, column, "n"))


def index_to_string(df: DataFrame, column: str, output: str, index: DataFrame, label: str, spread: Column) -> DataFrame:
    """The label behind an index column."""
    counted = index.select(F.col("idx").cast("double").alias(column), F.col(label).alias(output), "n")
    return lookup_join(df, counted.drop("n"), column, spread, hot=lambda: hot_of_counts(counted, column, "n"))


def feature_dictionary(df: DataFrame, columns: Sequence[str] = ENCODED) -> DataFrame:
    """``block, val, n, idx, name``: one feature per distinct value, blocks in column order, values sorted.

    ``name`` is the column of the block.  One scan counts the values of all columns; positions come from a
    distributed sort.
    """
    entries = F.array(
        *(F.struct(F.lit(b).alias("block"), F.col(c).cast("string").alias("val")) for b, c in enumerate(columns))
    )
    values = df.select(F.explode(entries).alias("e")).select("e.*").filter(F.col("val").isNotNull())
    counts = values.groupBy("block", "val").agg(F.count(F.lit(1)).alias("n"))
    names = F.array(*(F.lit(c) for c in columns))
    return numbered(counts, F.col("block").asc(), F.col("val").asc()).withColumn("name", F.get(names, F.col("block")))


def block_bytes(dictionary: DataFrame, row_bytes: int = 64) -> dict[int, int]:
    """Approximate size of every block: one row per encoded column reaches the driver."""
    size = F.sum(F.octet_length("val") + row_bytes).cast("bigint")
    return {r[0]: r[1] for r in dictionary.groupBy("block").agg(size).collect()}


def block_join(
    df: DataFrame,
    dictionary: DataFrame,
    columns: Sequence[str],
    spread: Column,
    take: Callable[[int], list[str]],
    sizes: dict[int, int],
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join every encoded column to its block of a dictionary-shaped table.

    ``take(block)`` gives the columns to bring along, ``sizes`` the bytes of every block.  The counts
    in the table tell which values are hot, so salting needs no further pass over the facts.
    """
    for b, c in enumerate(columns):
        block = dictionary.filter(f"block = {b}")
        lookup = block.selectExpr(f"val as `{c}`", *take(b))
        df = lookup_join(
            df,
            lookup,
            c,
            spread,
            hot=lambda: hot_of_counts(block, "val", "n").withColumnRenamed("val", c),
            size=sizes.get(b, 0),
            broadcast_bytes=broadcast_bytes,
        )
    return df


def encode(
    df: DataFrame,
    dictionary: DataFrame,
    spread: Column,
    columns: Sequence[str] = ENCODED,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``idx`` and ``val``: the active features of every row, ascending.

    A value that is not in the dictionary gives no feature, and ``unknown`` counts those.
    """
    kept = list(df.columns)
    slots = [f"_slot{b}" for b in range(len(columns))]
    sizes = block_bytes(dictionary)
    joined = block_join(df, dictionary, columns, spread, lambda b: [f"idx as {slots[b]}"], sizes, broadcast_bytes)
    coded = joined.select(*kept, F.array_compact(F.array(*slots)).alias("idx"))
    return coded.select(
        *kept,
        "idx",
        F.transform("idx", lambda _: F.lit(1.0)).alias("val"),
        (F.lit(len(slots)) - F.size("idx")).alias("unknown"),
    )


def one_hot_vectors(df: DataFrame, indexed: Sequence[str], output: str = "features") -> DataFrame:
    """Index columns to one sparse vector, a slot per category (none dropped)."""
    hot = [f"_hot_{c}" for c in indexed]
    encoder = OneHotEncoder(inputCols=list(indexed), outputCols=hot, dropLast=False)
    coded = encoder.fit(df).transform(df)
    return VectorAssembler(inputCols=hot, outputCol=output).transform(coded).drop(*hot)


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Numeric and vector columns to one vector."""
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)
