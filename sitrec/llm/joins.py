"""Joining rows with the facts of their groups when some groups are very large."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrec.storage import written

HOT = 1024  # a group with more than this fraction of the rows is large; there are fewer such groups
SHARES, LEAST = 4096, 512  # a key keeps a part of this fraction of the rows, or so many rows, together


def with_group(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``groups`` (one row per key, ``size`` rows each).

    Groups with more than a ``HOT``-th of the ``total`` rows are broadcast, so their rows stay where they are;
    rows of the others are shuffled, none of whose keys fills more than that fraction of the data.
    """
    large = F.col(size) * HOT > total
    hot = groups.where(large)
    if hot.isEmpty():
        return rows.join(groups.hint("merge"), keys)
    names = hot.select(*keys)
    cold = rows.join(F.broadcast(names), keys, "left_anti").join(groups.where(~large).hint("merge"), keys)
    return rows.join(F.broadcast(hot), keys).unionByName(cold)


def share(total: int) -> int:
    """Rows of a key that stay together, of ``total`` rows."""
    return max(LEAST, total // SHARES)


def frequent(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame | None, int]:
    """Keys of ``rows`` with more rows (``_n``) than stay together, if there are any, and how many do.

    There are at most ``SHARES`` such keys.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    total, most = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
    limit = share(total)
    return (counts.where(F.col("_n") > limit) if most > limit else None), limit


def spread(
    rows: DataFrame,
    facts: DataFrame,
    hot: tuple[DataFrame | None, int],
    keys: Sequence[str],
    how: str = "inner",
    by: Sequence[str] | None = None,
) -> DataFrame:
    """Join of ``rows`` with ``facts`` in which no task gets all rows of a frequent key.

    The ``hot`` keys are divided into parts of as many rows as stay together, and their facts are copied to every
    part; only the keys and their numbers of parts are broadcast.  A hash of the columns ``by`` (all by default) deals
    rows out.  Rows with a missing key match nothing and are dealt out evenly.
    """
    keys = list(keys)
    frequent_keys, limit = hot
    if frequent_keys is None:
        return rows.join(facts.hint("merge"), keys, how)
    names = frequent_keys.select(*keys, F.ceil(F.col("_n") / limit).cast("int").alias("_parts"))
    missing = F.greatest(*(F.col(k).isNull() for k in keys), F.lit(False))
    parts = F.when(missing, F.lit(SHARES)).otherwise(F.coalesce("_parts", F.lit(1)))
    part = F.pmod(F.xxhash64(*(by or rows.columns)), parts).cast("int").alias("_part")
    dealt = rows.join(F.broadcast(names), keys, "left").select(*rows.columns, part)
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)).alias("_part")
    copied = facts.join(F.broadcast(names), keys, "left").select(*facts.columns, copies)
    return dealt.join(copied.hint("merge"), [*keys, "_part"], how).drop("_part")


def spread_join(rows: DataFrame, facts: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``spread`` by the keys that are frequent in ``rows``, which is read twice: it should be a written table."""
    return spread(rows, facts, frequent(rows, keys), keys, how)


def maybe_among(rows: DataFrame, column: Column, known: DataFrame, bits: int) -> DataFrame:
    """``rows`` with ``_maybe``: false only where ``column`` is not in the one column of ``known``.

    A bit each of ``bits`` (8 MB at most by ``filter_bits``) is broadcast.
    """

    def slot(value: Column) -> Column:
        return F.xxhash64(value).bitwiseAND(bits - 1)

    def bit(value: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), slot(value).bitwiseAND(63).cast("int"))

    own = F.col(known.columns[0])
    words = known.select(F.shiftright(slot(own), 6).alias("_word"), bit(own).alias("_one"))
    words = words.groupBy("_word").agg(F.bit_or("_one").alias("_mask"))
    looked = rows.withColumn("_at", F.shiftright(slot(column), 6)).join(F.broadcast(words), F.col("_at") == F.col("_word"), "left")
    hit = F.coalesce(F.col("_mask").bitwiseAND(bit(column)) != 0, F.lit(False))
    return looked.withColumn("_maybe", hit).drop("_at", "_word", "_mask")
