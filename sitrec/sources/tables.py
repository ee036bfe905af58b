"""Rating views over the event and order tables.

``events`` becomes contextual ratings (and weighted events), ``lineitem`` with ``orders`` becomes a
large plain rating table.  Everything is a projection of the scan, so column pruning reaches Parquet, and so
do filters on columns that keep their type; ``user_key`` is the user as the files have it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitrec.sources.ratings import UNKNOWN_CONTEXT

# Rating thresholds and event weights of the derived views.
RATING_STEPS = (15, 35, 70, 140)
EVENT_WEIGHTS = {"view": 1, "click": 2, "signup": 3, "purchase": 5, "error": 0}
COMPANIONS = {"view": "Alone", "signup": "Alone", "click": "Family", "purchase": "Partner"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choose(column: str, values: dict, otherwise) -> str:
    branches = " ".join(f"when {key!r} then {value!r}" for key, value in values.items())
    return f"case {column} {branches} else {otherwise!r} end"


def epoch_seconds(ts: str) -> str:
    """Whole seconds since 1970 of a zone-less timestamp, whatever the session zone is."""
    return (
        f"cast(datediff(to_date({ts}), date'1970-01-01') as bigint) * 86400 "
        f"+ hour({ts}) * 3600 + minute({ts}) * 60 + second({ts})"
    )


def contextual_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings 1-5 with Time, Location and Companion, one row per event."""
    steps = " + ".join(f"if(value >= {s}, 1D, 0D)" for s in RATING_STEPS)
    unknown = f"when event_type = 'error' then '{UNKNOWN_CONTEXT}'"
    return table(spark, sf_dir, "events").selectExpr(
        "event_id as row_id",
        "cast(user_id as string) as userid",
        "user_id as user_key",
        "get_json_object(props, '$.k') as itemid",
        f"1D + {steps} as rating",
        f"case {unknown} when weekday(ts) >= 5 then 'Weekend' else 'Weekday' end as Time",
        f"case {unknown} when hour(ts) < 12 then 'Home' else 'Cinema' end as Location",
        f"{_choose('event_type', COMPANIONS, UNKNOWN_CONTEXT)} as Companion",
        f"{epoch_seconds('ts')} as ts_s",
        "value",
        "event_type",
    )


def finer_items(ratings: DataFrame) -> DataFrame:
    """The same ratings over five times as many items."""
    item = F.concat_ws("-", "itemid", F.pmod("row_id", F.lit(5)).cast("string"))
    return ratings.withColumn("itemid", item)


def weighted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    weight = f"{_choose('event_type', EVENT_WEIGHTS, 0)} as Weight"
    return contextual_ratings(spark, sf_dir).selectExpr(
        "userid", "itemid", "Time", "Location", "Companion", weight, "value as Value"
    )


def plain_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as ratings: customer, part, quantity in five steps."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("userid"),
        F.col("l_partkey").alias("itemid"),
        (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("double").alias("rating"),
    )
