"""Transforms and statistics of numeric vectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import DCT, PCA, MinMaxScaler, PCAModel, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitrec.operators.joins import lookup_join
from sitrec.operators.ordering import totals_before
from sitrec.storage import written


def as_vector(df: DataFrame, array: str, output: str = "features") -> DataFrame:
    return df.withColumn(output, array_to_vector(F.col(array).cast("array<double>")))


def vector_long(df: DataFrame, key: str, vector: str, value: str, position: str = "dim") -> DataFrame:
    """One row per slot of a (short, dense) vector."""
    return df.select(key, F.posexplode(vector_to_array(vector)).alias(position, value))


def min_max_scale(df: DataFrame, vector: str = "features", output: str = "scaled") -> DataFrame:
    """Every slot to [0, 1]; a constant slot gives 0.5."""
    return MinMaxScaler(inputCol=vector, outputCol=output).fit(df).transform(df)


def cosine_transform(df: DataFrame, vector: str = "features", output: str = "dct", inverse: bool = False) -> DataFrame:
    """Orthonormal DCT-II, or its inverse."""
    return DCT(inverse=inverse, inputCol=vector, outputCol=output).transform(df)


def slice_vector(
    df: DataFrame,
    vector: str = "features",
    output: str = "sliced",
    indices: Sequence[int] = (),
    names: Sequence[str] = (),
) -> DataFrame:
    """Chosen slots of a vector, by position and by attribute name."""
    return VectorSlicer(inputCol=vector, outputCol=output, indices=list(indices), names=list(names)).transform(df)


def fit_pca(df: DataFrame, k: int, vector: str = "features", output: str = "pca") -> PCAModel:
    return PCA(k=k, inputCol=vector, outputCol=output).fit(df)


def _merged(left: tuple, right: tuple) -> tuple:
    """Count, means and centred products of two sets of rows together."""
    (n, m, c), (k, mean, products) = left, right
    off = mean - m
    return n + k, m + off * (k / (n + k)), c + products + np.outer(off, off) * (n * k / (n + k))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(0)
        lengths = np.diff(column.offsets.to_numpy())
        if column.null_count or column.flatten().null_count or (lengths != lengths[0]).any():
            raise ValueError("the arrays must have one length and no NULL")
        block = column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        if whole is not None and len(whole[1]) != block.shape[1]:
            raise ValueError("the arrays must have one length and no NULL")
        mean = block.mean(axis=0)
        centred = block - mean
        part = batch.num_rows, mean, centred.T @ centred
        whole = part if whole is None else _merged(whole, part)
    if whole is not None:
        n, means, products = whole
        i, j = np.triu_indices(len(means))
        yield pa.RecordBatch.from_pydict(
            {
                "d": pa.array(np.full(len(i), len(means)), pa.int32()),
                "i": pa.array(i, pa.int32()),
                "j": pa.array(j, pa.int32()),
                "n": pa.array(np.full(len(i), n), pa.int64()),
                "mi": pa.array(means[i]),
                "mj": pa.array(means[j]),
                "c": pa.array(products[i, j]),
            }
        )


def covariance(df: DataFrame, array: str) -> DataFrame:
    """``i, j, covariance`` (i <= j) of arrays of one length; NULL or ragged arrays are errors.

    Every task reduces its rows to counts, means and centred products.  The products about the common means
    are theirs and the spread of the tasks' means, so nothing large is subtracted from anything large.
    """
    partial = df.select(F.col(array).cast("array<double>")).mapInArrow(
        _moments, "d int, i int, j int, n bigint, mi double, mj double, c double"
    )
    partial = written(partial, "moments")  # a row per task and pair of slots
    if partial.select("d").distinct().count() > 1:
        raise ValueError("the arrays must have one length and no NULL")
    share = F.col("n") / F.sum("n").over(Window.partitionBy("i", "j"))
    means = partial.withColumn("share", share).groupBy("i", "j").agg(
        F.sum(F.col("mi") * F.col("share")).alias("ci"), F.sum(F.col("mj") * F.col("share")).alias("cj")
    )
    spread = F.col("n") * (F.col("mi") - F.col("ci")) * (F.col("mj") - F.col("cj"))
    about = partial.join(means, ["i", "j"]).groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum(F.col("c") + spread).alias("c"))
    return about.select("i", "j", F.try_divide("c", F.col("n") - 1).alias("covariance"))


def pearson_matrix(df: DataFrame, vector: str = "features") -> np.ndarray:
    """Correlation matrix of the slots of a short vector (its size is the number of slots)."""
    return Correlation.corr(df, vector, "pearson").first()[0].toArray()


def average_ranks(df: DataFrame, column: str, output: str) -> DataFrame:
    """``column, output``: the mean 1-based rank of every distinct value.

    Ties are counted, not listed, so a value that fills the table costs one row.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    before = totals_before(counts, [F.col(column).asc()], {"_before": F.col("_n")})
    return before.select(column, (F.col("_before") + (F.col("_n") + 1) / 2).alias(output), F.col("_n").alias("n"))


def spearman_matrix(df: DataFrame, key: str, array: str) -> DataFrame:
    """``i, j, correlation`` (i <= j): rank correlations of the slots of arrays of one length.

    All slots are ranked at once, as ranges of (slot, value): every slot has as many values as there are rows, so the
    ranks of a slot begin where those of the slots before it end.  Ties share their mean rank and are counted, not
    listed.  The ranks of a row, found by its ``key``, become an array again, of which ``covariance`` is taken.  A
    slot of one value has no correlation: NULL.  NULL, ragged arrays and repeated keys are errors.
    """
    slots = F.transform(F.col(array).cast("array<double>"), lambda x, i: F.struct(i.alias("dim"), x.alias("x")))
    long = df.select(key, F.explode(slots).alias("slot"))
    size = F.coalesce(F.size(array), F.lit(-1))
    missing = F.col(array).isNull() | F.coalesce(F.exists(array, lambda x: x.isNull()), F.lit(True))
    rows, least, most, bad = df.agg(
        F.count(F.lit(1)), F.min(size), F.max(size), F.coalesce(F.sum(missing.cast("int")), F.lit(0))
    ).first()
    if bad or least != most:
        raise ValueError("the arrays must have one length and no NULL")
    if df.select(key).distinct().count() != rows:
        raise ValueError("the keys must be distinct and not NULL")
    counts = long.groupBy("slot").agg(F.count(F.lit(1)).alias("n"))
    before = totals_before(counts, [F.col("slot").asc()], {"before": F.col("n")})
    rank = (F.col("before") - F.col("slot.dim") * F.lit(rows) + (F.col("n") + 1) / 2).alias("rank")
    ranked = lookup_join(long, before.select("slot", rank), "slot", F.col(key), "inner")
    of_row = F.transform(F.array_sort(F.array_agg(F.struct("slot.dim", "rank"))), lambda x: x["rank"])
    found = written(covariance(ranked.groupBy(key).agg(of_row.alias("ranks")), "ranks"), "covariance")
    own = found.where("i = j")
    spread = [own.select(F.col(c), F.col("covariance").alias(f"v{c}")) for c in ("i", "j")]  # a row per slot
    both = found.join(F.broadcast(spread[0]), "i").join(F.broadcast(spread[1]), "j")
    return both.select("i", "j", F.try_divide("covariance", F.sqrt(F.col("vi")) * F.sqrt(F.col("vj"))).alias("correlation"))
