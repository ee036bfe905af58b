"""Filters, splits, unions, pivots and aggregates over rating tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrec.functions.scalar import rescale
from sitrec.sources.ratings import CONTEXTS, UNKNOWN_CONTEXT
from sitrec.storage import written


USER_KEY = "user_key"

# ---- filters -----------------------------------------------------------------------------------


def context_matches(context: Mapping[str, str]) -> Column:
    if not context:
        return F.lit(True)
    return reduce(and_, (F.col(dim) == F.lit(value) for dim, value in context.items()))


def context_filter(df: DataFrame, context: Mapping[str, str]) -> DataFrame:
    """Rows whose context equals the given values; dimensions not named are free."""
    return df.filter(context_matches(context))


def in_contexts(df: DataFrame, wanted: DataFrame, contexts: Sequence[str] = CONTEXTS) -> DataFrame:
    """Rows whose context is one of those in a table of requests."""
    return df.join(wanted.select(*contexts).distinct(), list(contexts), "left_semi").select(*df.columns)


def known_context(df: DataFrame, contexts: Sequence[str] = CONTEXTS) -> DataFrame:
    return df.filter(reduce(and_, (F.col(c) != UNKNOWN_CONTEXT for c in contexts)))


def positive(df: DataFrame, rating: str = "rating", required: bool = False) -> DataFrame:
    """Ratings above zero; with ``required`` an empty result is an error."""
    kept = df.filter(F.col(rating) > 0)
    if required and kept.isEmpty():
        raise ValueError("no ratings provided")
    return kept


def unseen_items(ratings: DataFrame, user, user_col: str = "userid", item_col: str = "itemid") -> DataFrame:
    """Distinct items of the table that the user has not rated.

    A NULL item never matches and is dropped from the candidates; unlike ``NOT IN`` a NULL among
    the user's items does not empty the result.
    """
    # counted rather than distinct: the optimizer would join the raw rows and make them distinct later
    items = ratings.filter(F.col(item_col).isNotNull()).groupBy(item_col).agg(F.count(F.lit(1)).alias("_n"))
    rated = user_rows(ratings, user, user_col).select(item_col).distinct()
    return items.filter("_n > 0").select(item_col).join(rated, item_col, "left_anti")


def user_rows(ratings: DataFrame, user, user_col: str = "userid") -> DataFrame:
    """Rows of one user.

    Where the table has the user in the type of its files as well (``user_key``), the filter on that column
    reaches the scan.
    """
    rows = ratings.filter(F.col(user_col) == F.lit(user))
    if USER_KEY not in ratings.columns:
        return rows
    return rows.filter(F.col(USER_KEY) == F.try_to_number(F.lit(str(user)), F.lit("9" * 19)).cast("bigint"))


def unseen_items_sql(ratings: DataFrame, user: str) -> DataFrame:
    """The same as a SQL statement over the table, for a ``userid, itemid`` table."""
    return ratings.sparkSession.sql(
        """select distinct itemid from {ratings}
        left anti join (select itemid from {ratings} where userid = :user) using (itemid)
        where itemid is not null""",
        args={"user": user},
        ratings=ratings,
    )


# ---- splits ------------------------------------------------------------------------------------

# Shares of the three-way split in tenths.
TRAIN_BELOW, VALIDATION_BELOW, BUCKETS = 6, 8, 10


def three_way(bucket: Column) -> Column:
    return (
        F.when(bucket < TRAIN_BELOW, "train").when(bucket < VALIDATION_BELOW, "validation").otherwise("test")
    )


def modulo_split(df: DataFrame, by: str) -> DataFrame:
    """60/20/20 by the last digit of a number."""
    return df.withColumn("split", three_way(F.pmod(F.col(by), F.lit(BUCKETS))))


def arithmetic_bucket(*keys: Column, seed: int = 0, buckets: int = BUCKETS) -> Column:
    """Repeatable bucket of integer keys; a row keeps its bucket when a task is run again."""
    mixed = F.lit(seed)
    for factor, key in zip((7, 13, 17, 19), keys):
        mixed = mixed + F.lit(factor) * key.cast("bigint")
    return F.pmod(mixed, F.lit(buckets))


def seeded_number(seed: int, *keys: str) -> Column:
    """32 bits of md5 of seed and keys, as a long."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def hash_split(df: DataFrame, weights: Mapping[str, float], *keys: str, seed: int = 0) -> DataFrame:
    """Random split by weights, decided by a seeded hash of the row's keys as text.

    The hash is md5, so that any engine can repeat the split.
    """
    size = float(sum(weights.values()))
    if size <= 0 or min(weights.values()) < 0:
        raise ValueError("weights must not be negative and not all zero")
    fine = 1_000_000
    spot = F.pmod(seeded_number(seed, *keys), F.lit(fine))
    names = list(weights)
    part, upto = F, 0.0
    for name in names[:-1]:
        upto += weights[name] / size
        part = part.when(spot < F.lit(round(upto * fine)), F.lit(name))
    return df.withColumn("split", part.otherwise(F.lit(names[-1])) if len(names) > 1 else F.lit(names[0]))


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def with_personal(training: DataFrame, personal: DataFrame) -> DataFrame:
    """Add one user's own ratings to the training rows (duplicates stay)."""
    return training.unionByName(personal.select(*training.columns))


# ---- projections -------------------------------------------------------------------------------


def rescale_ratings(df: DataFrame, rating: str = "rating") -> DataFrame:
    """Ratings to [-1, 1] by the table's own range; NULL when all ratings are equal."""
    span = df.agg(F.struct(F.min(rating).alias("lo"), F.max(rating).alias("hi"))).scalar()
    return df.withColumn(rating, rescale(F.col(rating), span["lo"], span["hi"]))


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """A row number for tables without a key, written with the rows so that it never changes."""
    return written(df.withColumn(name, F.monotonically_increasing_id()), "numbered")


def split_items(df: DataFrame, contexts: Sequence[str] = CONTEXTS, item: str = "itemid") -> DataFrame:
    """Item splitting: the item together with its context becomes the item."""
    return df.withColumn(item, F.concat_ws("\t", item, *contexts))


def pivot_values(df: DataFrame, values: Mapping[str, Sequence[str]], keep: Sequence[str]) -> DataFrame:
    """0/1 columns ``<column>_<value>`` for columns with few values, in one projection.

    No grouping by row and no join are needed, since every row has one value per column.
    """
    flags = [
        F.when(F.col(c) == F.lit(v), 1.0).otherwise(0.0).alias(f"{c}_{v}") for c, vs in values.items() for v in vs
    ]
    return df.select(*keep, *flags)


def pivot_long(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The same in long form, ``keep..., feature``: one row per cell that is 1, for values that are not known."""
    named = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}_"), F.col(c).cast("string"))) for c in columns]
    return df.select(*keep, F.explode(F.array_compact(F.array(*named))).alias("feature"))


# ---- aggregates --------------------------------------------------------------------------------


def roll_up(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Weighted events to ratings: sum of weight times value per key."""
    return events.groupBy(*keys).agg(F.sum(F.col("Weight") * F.col("Value")).cast("double").alias("rating"))


def rating_range(df: DataFrame, rating: str = "rating") -> DataFrame:
    return df.agg(F.min(rating).alias("min_rating"), F.max(rating).alias("max_rating"))


def dataset_stats(df: DataFrame, user: str = "userid", item: str = "itemid", exact: bool = True) -> DataFrame:
    """Numbers of ratings, users and items; sketches instead of exact distinct counts on request."""
    distinct = F.count_distinct if exact else F.approx_count_distinct
    return df.agg(
        F.count(F.lit(1)).alias("ratings"), distinct(F.col(user)).alias("users"), distinct(F.col(item)).alias("items")
    )
