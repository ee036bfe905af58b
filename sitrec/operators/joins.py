"""Joins of facts to a lookup table with one row per key.

A lookup that is small by a check of its size is broadcast.  A larger one is joined by shuffle, and
the keys that hold a large share of the facts are salted: their facts are spread over many tasks and
their lookup rows copied to each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrec.functions.scalar import single

BROADCAST_BYTES = 64 * 1024 * 1024


def table_bytes(df: DataFrame) -> int:
    """Approximate size of a table: 16 bytes a column, and what its texts, bytes and collections hold.

    Arrays of numbers count by elements; maps, structs and other arrays by the length of their JSON.
    """
    parts = [F.lit(16 * len(df.columns))]
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            parts.append(F.coalesce(F.octet_length(name), F.lit(0)))
        elif kind in NUMBER_ARRAYS:
            parts.append(F.coalesce(F.size(name), F.lit(0)) * 16)
        elif kind.startswith(("array", "map", "struct")):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0)))
    return int(df.agg(F.sum(sum(parts[1:], parts[0]).cast("bigint"))).first()[0] or 0)


NUMBER_ARRAYS = {f"array<{t}>" for t in ("tinyint", "smallint", "int", "bigint", "float", "double")}


def task_share(df: DataFrame) -> int:
    """Into how many tasks a shuffle divides the rows."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """Keys with more rows than a task's fair share, and their ``_salts``."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return hot_of_counts(counts, key, "_n", tasks)


def hot_of_counts(counts: DataFrame, key: str, n: str, tasks: int | None = None) -> DataFrame:
    """The same from counts that are already there.

    A key is divided into as many parts as it holds fair shares, so there are fewer hot keys than tasks, and
    fewer than two parts for each task.
    """
    share = F.col(n) * (tasks or task_share(counts)) / single(counts, F.sum(n))
    return counts.filter(share > 1).select(key, F.ceil(share).cast("int").alias("_salts"))


def salted(df: DataFrame, key: str, hot: DataFrame, spread: Column) -> DataFrame:
    """Add ``_salt``: 0 for ordinary keys, by ``spread`` one of its salts for a hot key, any for a missing one."""
    flagged = df.join(F.broadcast(hot), key, "left")
    salts = F.when(F.col(key).isNull(), F.lit(max(64, task_share(df)))).otherwise(F.coalesce("_salts", F.lit(1)))
    return flagged.withColumn("_salt", F.pmod(F.hash(spread), salts)).drop("_salts")


def replicated(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """One copy of every row for each ``_salt`` its key can have."""
    flagged = df.join(F.broadcast(hot), key, "left")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    return flagged.withColumn("_salt", F.explode(copies)).drop("_salts")


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    spread: Column,
    how: str = "left",
    hot: Callable[[], DataFrame] | None = None,
    size: int | None = None,
    broadcast_bytes: int | None = None,
    task_bytes: int = 0,
) -> DataFrame:
    """Join facts to a lookup on ``key`` (``inner`` or ``left``).

    ``spread`` tells rows of a hot key apart; ``hot`` (asked only when needed) and ``size`` save a
    pass when known.  There are fewer hot keys than shuffle partitions, so the broadcast flags and the
    copies are bounded by rule.  A shuffled lookup of at most ``task_bytes`` a task is held there as a hash table,
    so that the facts need no sort; a larger one is merged with the sorted facts.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    size = table_bytes(lookup) if size is None else size
    if size <= (BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes):
        return facts.join(F.broadcast(lookup), key, how)
    flags = hot_keys(facts, key) if hot is None else hot()
    left = salted(facts, key, flags, spread)
    right = replicated(lookup, key, flags)
    if size <= task_bytes * task_share(facts):
        right = right.hint("shuffle_hash")
    return left.join(right, [key, "_salt"], how).drop("_salt")
