"""Sparse feature rows as libSVM text and Parquet.

A feature row is ``label double, idx array<bigint>, val array<double>`` with ascending 0-based
``idx``.  Unlike a vector column it can be exploded, joined and compared inside Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def libsvm_line(label: str = "label", idx: str = "idx", val: str = "val") -> Column:
    """One feature row as libSVM text (1-based indices)."""
    pairs = F.zip_with(idx, val, lambda i, x: F.concat_ws(":", (i + 1).cast("string"), x.cast("string")))
    return F.concat_ws(" ", F.col(label).cast("string"), F.array_join(pairs, " "))


def save_libsvm(rows: DataFrame, path: str) -> None:
    """Write feature rows as libSVM text, replacing what is there."""
    rows.select(libsvm_line().alias("value")).write.mode("overwrite").text(path)


def load_libsvm(spark: SparkSession, path: str) -> DataFrame:
    """Read libSVM text as feature rows, without a vector column in between."""
    parts = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path).filter(F.trim("value") != "").select(parts.alias("p"))
    pairs = F.slice("p", F.lit(2), F.size("p"))
    return lines.select(
        F.col("p")[0].cast("double").alias("label"),
        F.transform(pairs, lambda s: F.substring_index(s, ":", 1).cast("bigint") - 1).alias("idx"),
        F.transform(pairs, lambda s: F.substring_index(s, ":", -1).cast("double")).alias("val"),
    )


def load_libsvm_vectors(spark: SparkSession, path: str, num_features: int) -> DataFrame:
    """Read libSVM text as ``label, features`` for the ML estimators.

    The size is given, as finding it would cost another pass over the files.
    """
    return spark.read.format("libsvm").option("numFeatures", num_features).load(path)


def vector_parts(df: DataFrame, features: str = "features") -> DataFrame:
    """Replace a vector column by ``idx`` and ``val``, leaving zeros out."""
    kept = [c for c in df.columns if c != features]
    opened = df.select(*kept, F.unwrap_udt(features).alias("_f"))
    positions = F.coalesce(
        F.col("_f.indices").cast("array<bigint>"),
        F.transform(F.col("_f.values"), lambda _, i: i.cast("bigint")),
    )
    pairs = F.filter(F.arrays_zip(positions.alias("i"), F.col("_f.values").alias("x")), lambda p: p["x"] != 0.0)
    return opened.select(*kept, pairs.alias("_p")).select(
        *kept, F.col("_p.i").alias("idx"), F.col("_p.x").alias("val")
    )


def long_features(rows: DataFrame, *keep: str, empty: bool = False) -> DataFrame:
    """One row per active feature: ``keep..., idx, val``.

    With ``empty`` a row without features stays as one row with NULL for both.
    """
    explode = F.explode_outer if empty else F.explode
    pairs = F.arrays_zip("idx", "val")
    return rows.select(*keep, explode(pairs).alias("_p")).select(
        *keep, F.col("_p.idx").alias("idx"), F.col("_p.val").alias("val")
    )


def save_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
