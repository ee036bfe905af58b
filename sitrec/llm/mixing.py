"""Mixing sources to target weights by Poisson replication; DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrec.llm.columns import quoted, text_or_empty, without
from sitrec.storage import written

ADDED = ("copy", "n_copies", "shuffle_key")
OWN = ("_source", "_cdf", "_parts", "_place", "_block")
PART = 32.0  # a larger mean is split, as exp(-mean) would vanish; sums of Poisson numbers are Poisson numbers
HEX = 13  # hex digits of a hash that make an exact double
BLOCK = 1 << 14  # copies of a row that one task makes at a time


def _number(*parts: Column) -> Column:
    """52 bits of md5 as a long; the same in every engine and on every attempt of a task."""
    text = F.concat_ws(":", *(p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HEX), 16, 10).cast("long")


def _cumulative(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... until the rest is far below the resolution of the uniform number."""
    first = F.exp(-mean)
    last = F.ceil(mean + F.sqrt(mean) * 12 + 20).cast("int")
    start = F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("all"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * mean / k
        return F.struct(p.alias("p"), (s["c"] + p).alias("c"), F.concat(s["all"], F.array(s["c"] + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["all"])


def rates(
    docs: DataFrame, weights: Mapping[str | None, float] | None, default: float, epochs: float, source: str, text: str
) -> DataFrame:
    """One row per source: rows, volume in code points and the mean repetition ``rate``."""
    volume = docs.groupBy(quoted(source).alias("_source")).agg(
        F.count("*").alias("rows"), F.sum(F.char_length(text_or_empty(text))).alias("volume")
    )
    weight = F.lit(float(default))
    for name, value in (weights or {}).items():
        weight = F.when(F.col("_source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    volume = written(volume.withColumn("weight", weight), "volumes")
    sums = volume.agg(F.sum("volume").alias("v"), F.sum("weight").alias("w")).first()
    share = F.col("weight") * (epochs * (sums["v"] or 0) / (sums["w"] or 1.0))
    return volume.withColumn("rate", F.when(F.col("volume") > 0, share / F.col("volume")).otherwise(1.0))


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    default: float = 1.0,
    epochs: float = 1.0,
    seed: int = 42,
    source: str = "source",
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Rows of ``docs`` repeated so that sources meet their target weights, in a global random order.

    The mean repetition rate of a source is its share of the weights, times ``epochs`` times the
    volume of all texts, over its own volume (code points).  A document's count inverts the Poisson
    distribution of that mean at a uniform number hashed from seed and id; each copy is a row with
    ``copy`` (from 0), ``n_copies`` and ``shuffle_key``, by which the whole result is sorted.  Counts
    and order depend on nothing else, so a repeated task gives the same rows.

    Sources not named in ``weights`` have the weight ``default``; a null source is a source.  A
    source without text has the rate 1, one of weight 0 vanishes; negative weights are refused.
    Rows that repeat an id get the same count and key each.  A null id counts as an empty one.
    Columns of ``docs`` that have the name of an added column are replaced.  An empty table stays empty.

    Sources with more than a 1024th of the rows are at most 1024 and are broadcast with their rates,
    so that a large source is not gathered anywhere; only rows of smaller ones, if any, are joined.
    """
    if default < 0 or epochs < 0 or any(v < 0 or not math.isfinite(v) for v in (weights or {}).values()):
        raise ValueError("weights and epochs must be finite and not negative")
    clean = without(docs, (*ADDED, *OWN))
    columns = [quoted(c) for c in clean.columns]
    per_source = rates(clean, weights, default, epochs, source, text)
    parts = F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)).cast("int")
    table = per_source.select(
        "_source", parts.alias("_parts"), _cumulative(F.col("rate") / parts).alias("_cdf"), "rows"
    )
    facts = per_source.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.max(parts).alias("parts")).first()
    least = facts["rows"] / 1024
    large, small = table.where(F.col("rows") >= least).drop("rows"), table.where(F.col("rows") < least).drop("rows")
    same = quoted(source).eqNullSafe(F.col("_source"))
    rated = clean.join(F.broadcast(large), same, "inner")
    if not small.isEmpty():
        rest = clean.join(F.broadcast(large.select("_source")), same, "left_anti")
        rated = rated.unionByName(rest.join(small.hint("merge"), same, "inner"))

    key = F.coalesce(quoted(doc_id).cast("string"), F.lit(""))

    def drawn(part: Column) -> Column:
        u = _number(F.lit(seed), key, part) / F.lit(float(16**HEX))
        return F.size(F.filter("_cdf", lambda c: c <= u))

    count = F.aggregate(F.sequence(F.lit(0), F.col("_parts") - 1), F.lit(0), lambda n, part: n + drawn(part))
    counted = rated.select(*columns, count.alias("n_copies"), "_parts").where("n_copies > 0")

    def copies(rows: DataFrame, first: Column, last: Column) -> DataFrame:
        return rows.select(*columns, F.explode(F.sequence(first, last)).alias("copy"), "n_copies")

    many = int(BLOCK / PART)
    last = F.col("n_copies") - 1
    if (facts["parts"] or 0) <= many:
        out = copies(counted, F.lit(0), last)
    else:
        blocks = counted.where(F.col("_parts") > many).withColumn("_block", F.explode(F.sequence(F.lit(0), last, F.lit(BLOCK))))
        # a fixed number of partitions, as blocks are few bytes before they are copied and would be put together again
        tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.sparkSession.sparkContext.defaultParallelism)
        blocks = blocks.repartition(tasks, key, "_block")
        out = copies(counted.where(F.col("_parts") <= many), F.lit(0), last).unionByName(
            copies(blocks, F.col("_block"), F.least(last, F.col("_block") + (BLOCK - 1)))
        )
    out = out.withColumn("shuffle_key", _number(F.lit(seed), F.lit("order"), key, F.col("copy")))
    return out.orderBy("shuffle_key", "copy")
