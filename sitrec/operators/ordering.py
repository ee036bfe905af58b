"""Positions, running totals and top-k without sending a table through one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitrec.storage import written

CUT_BEFORE = 1000  # ranks up to which Spark filters before the shuffle


def totals_before(df: DataFrame, order: Sequence[Column], totals: Mapping[str, Column]) -> DataFrame:
    """Add, per row, the sums of ``totals`` over all rows that sort strictly before it.

    The rows are range-partitioned by ``order`` and summed inside their partition; the partition
    sums (one row per partition) are added up and joined back.  The placed rows are written once, so
    that both uses see the same partitions.  ``order`` must be total and without frequent
    ties: callers aggregate to distinct keys first.
    """
    names = list(totals)
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranged = (
        df.select("*", *(e.alias(f"_{n}") for n, e in totals.items()))
        .repartitionByRange(*order)
        .withColumn("_part", F.spark_partition_id())
    )
    placed = written(
        ranged.select("*", *(F.coalesce(F.sum(f"_{n}").over(inside), F.lit(0)).alias(n) for n in names)), "ordered"
    )
    sums = placed.groupBy("_part").agg(*(F.sum(f"_{n}") for n in names)).collect()
    if len(sums) <= 1:
        return placed.select(*df.columns, *names)
    offsets, running = [], [0] * len(names)
    for part, *own in sorted(sums):
        offsets.append((part, *running))
        running = [r + o for r, o in zip(running, own)]
    ahead = df.sparkSession.createDataFrame(
        offsets, "_part int, " + ", ".join(f"_{n}_ahead {placed.schema[n].dataType.simpleString()}" for n in names)
    )
    return placed.join(F.broadcast(ahead), "_part").select(
        *df.columns, *((F.col(n) + F.col(f"_{n}_ahead")).alias(n) for n in names)
    )


def numbered(df: DataFrame, *order: Column, name: str = "idx") -> DataFrame:
    """0-based position of every row in the given total order."""
    return totals_before(df, order, {name: F.lit(1).cast("bigint")})


def top_k(df: DataFrame, k: int, *order: Column, rank: str | None = "rank") -> DataFrame:
    """First k rows by a total order, with their 1-based position."""
    first = df.orderBy(*order).limit(k)
    if rank is None:
        return first
    return first.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def top_k_per(df: DataFrame, keys: Sequence[str], k: int, *order: Column, rank: str = "rank") -> DataFrame:
    """First k rows of every group.

    Up to ``CUT_BEFORE`` rows a group, Spark applies the rank filter in each map task before the shuffle, so
    a group that holds most rows still sends at most k rows per task.  For a larger k every group is
    first cut within parts of it, as many as there are shuffle partitions.
    """
    if k > CUT_BEFORE:
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parted = df.withColumn("_part", F.pmod(F.xxhash64(*df.columns), F.lit(tasks)))
        within = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))
        df = parted.withColumn("_place", within).filter(F.col("_place") <= k).drop("_part", "_place")
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, position).filter(F.col(rank) <= k)


def sample_one(df: DataFrame, key: str, seed: int) -> DataFrame:
    """One key value at random, repeatable for a seed: the smallest seeded hash."""
    values = df.select(key).distinct()
    spot = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    return values.orderBy(spot, key).limit(1)
