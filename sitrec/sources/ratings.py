"""Rating tables in text form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The column names and the missing-context marker of the rating files.
USER, ITEM, RATING = "userid", "itemid", "rating"
CONTEXTS = ("Time", "Location", "Companion")
UNKNOWN_CONTEXT = "NA"

PLAIN_SCHEMA = "userid int, itemid int, rating double"
TIMED_SCHEMA = "userid int, itemid int, rating float, timestamp bigint"


def load_ratings(spark: SparkSession, path: str, contexts: Sequence[str] = CONTEXTS) -> DataFrame:
    """Headered CSV, reduced to ids, rating and contexts.

    Names come from the header, so the order of columns and further columns do not matter; unused
    columns are never parsed.  A rating that is no number becomes NULL.
    """
    raw = spark.read.option("header", True).csv(path)
    return raw.select(
        F.col(USER).cast("string"),
        F.col(ITEM).cast("string"),
        F.col(RATING).try_cast("double").alias(RATING),
        *contexts,
    )


def load_weighted_events(spark: SparkSession, path: str, contexts: Sequence[str] = CONTEXTS) -> DataFrame:
    """Headered CSV of weighted events, not yet rolled up to ratings."""
    raw = spark.read.option("header", True).csv(path)
    numbers = [F.col(c).try_cast("double").alias(c) for c in ("Weight", "Value")]
    return raw.select(USER, ITEM, *contexts, *numbers)


def load_plain_ratings(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """CSV by position: user, item, rating, anything after that is ignored.

    Without ``header`` a header line is read as data and gives a row of NULLs.
    """
    return spark.read.option("header", header).option("enforceSchema", True).schema(PLAIN_SCHEMA).csv(path)


def load_timed_ratings(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """CSV by position with a fourth column in epoch seconds."""
    return spark.read.option("header", header).option("enforceSchema", True).schema(TIMED_SCHEMA).csv(path)


def save_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", header).csv(path)


def parse_delimited(df: DataFrame, line: str | Column, on_bad: str = "fail") -> DataFrame:
    """``user,item,rating,timestamp`` lines to typed columns.

    A line without exactly four fields stops the job (``fail``) or is left out (``drop``).
    """
    if on_bad not in ("fail", "drop"):
        raise ValueError("on_bad must be 'fail' or 'drop'")
    fields = F.split(line if isinstance(line, Column) else F.col(line), ",")
    whole = F.size("fields") == 4
    split = df.select(fields.alias("fields"))
    if on_bad == "drop":
        split = split.filter(whole)
    else:
        split = split.select(
            F.when(whole, F.col("fields"))
            .otherwise(F.raise_error(F.concat(F.lit("not four fields: "), F.concat_ws(",", "fields"))))
            .alias("fields")
        )
    names = ("userid", "itemid", "rating", "timestamp")
    types = ("int", "int", "float", "bigint")
    return split.select(*(F.col("fields")[i].try_cast(t).alias(n) for i, (n, t) in enumerate(zip(names, types))))


def parse_quoted(df: DataFrame, line: str, schema: str) -> DataFrame:
    """CSV text in a column, commas inside double quotes kept."""
    record = F.from_csv(F.col(line), schema, {"quote": '"', "escape": '"'})
    return df.select("*", record.alias("_record")).select(*df.columns, "_record.*")
