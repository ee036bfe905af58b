"""Scans, sinks, filters, joins, aggregates, ranking, splits, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitrec.checks.base import CONTEXT, CONTEXT_VALUES, USER_ID, fine, query, ratings, row, scaled, spot_split
from sitrec.functions.scalar import math_scalars, rounded
from sitrec.operators import relational as ops
from sitrec.operators.encoding import ENCODED, encode, feature_dictionary, index_table, string_index
from sitrec.operators.ordering import sample_one
from sitrec.sources import features, tables
from sitrec.sources import ratings as text
from sitrec.storage import new_path

RATING_COLUMNS = ("userid", "itemid", "rating", "Time", "Location", "Companion")


@query("scan_ratings", 'select userid, itemid, rating, "Time", "Location", "Companion" from rat', "rat")
def scan_ratings(spark, sf_dir):
    path = new_path(spark, "ratings-csv")
    text.save_csv(tables.contextual_ratings(spark, sf_dir), path)
    return text.load_ratings(spark, path)


@query("scan_plain_ratings", "select userid::int as userid, itemid::int as itemid, rating from plain", "plain")
def scan_plain_ratings(spark, sf_dir):
    path = new_path(spark, "plain-csv")
    text.save_csv(tables.plain_ratings(spark, sf_dir), path, header=False)
    return text.load_plain_ratings(spark, path)


@query(
    "scan_weighted_events",
    """select userid, itemid, "Time", "Location", "Companion", "Weight"::double as "Weight", "Value" from wev""",
    "wev",
)
def scan_weighted_events(spark, sf_dir):
    path = new_path(spark, "events-csv")
    text.save_csv(tables.weighted_events(spark, sf_dir), path)
    return text.load_weighted_events(spark, path)


@query(
    "parse_delimited",
    """select userid::int as userid, itemid::int as itemid, rating::float as rating, ts_s as "timestamp"
    from rat where event_type <> 'error'""",
    "rat",
)
def parse_delimited(spark, sf_dir):
    df = tables.contextual_ratings(spark, sf_dir)
    last = F.when(F.col("event_type") != "error", F.col("ts_s").cast("string"))
    lines = df.select(F.concat_ws(",", "userid", "itemid", F.col("rating").cast("string"), last).alias("line"))
    return text.parse_delimited(lines, "line", on_bad="drop")


@query(
    "from_csv_quoted",
    """select p_partkey as id, p_name || ', ' || p_type as name, p_brand as brand from part""",
)
def from_csv_quoted(spark, sf_dir):
    line = F.concat(F.col("p_partkey"), F.lit(',"'), "p_name", F.lit(", "), "p_type", F.lit('",'), "p_brand")
    lines = tables.table(spark, sf_dir, "part").select(line.alias("line"))
    return text.parse_quoted(lines, "line", "id bigint, name string, brand string").drop("line")


def _feature_rows(spark, sf_dir):
    dictionary = feature_dictionary(ratings(spark, sf_dir))
    rows = encode(scaled(spark, sf_dir).select("row_id", "rating", *ENCODED), dictionary, row())
    return rows.select("row_id", F.col("rating").alias("label"), "idx", "val"), dictionary


_SLOTS = "string_agg(idx::varchar, ' ' order by idx)"


@query("libsvm_roundtrip", f"select rating as label, {_SLOTS} as slots from feat group by row_id, rating", "feat")
def libsvm_roundtrip(spark, sf_dir):
    path = new_path(spark, "libsvm")
    rows, dictionary = _feature_rows(spark, sf_dir)
    features.save_libsvm(rows, path)
    back = features.vector_parts(features.load_libsvm_vectors(spark, path, dictionary.count()))
    return back.select("label", F.array_join("idx", " ").alias("slots"))


@query("libsvm_rows", f"select rating as label, {_SLOTS} as slots from feat group by row_id, rating", "feat")
def libsvm_rows(spark, sf_dir):
    path = new_path(spark, "libsvm")
    features.save_libsvm(_feature_rows(spark, sf_dir)[0], path)
    return features.load_libsvm(spark, path).select("label", F.array_join("idx", " ").alias("slots"))


@query(
    "libsvm_text",
    """select row_id, rating::varchar || ' ' || string_agg((idx + 1)::varchar || ':1.0', ' ' order by idx) as line
    from feat group by row_id, rating""",
    "feat",
)
def libsvm_text(spark, sf_dir):
    return _feature_rows(spark, sf_dir)[0].select("row_id", features.libsvm_line().alias("line"))


@query("parquet_roundtrip", f"select row_id, rating as label, {_SLOTS} as slots from feat group by row_id, rating", "feat")
def parquet_roundtrip(spark, sf_dir):
    path = new_path(spark, "features")
    features.save_table(_feature_rows(spark, sf_dir)[0], path)
    return features.load_table(spark, path).select("row_id", "label", F.array_join("idx", " ").alias("slots"))


# ---- projections -------------------------------------------------------------------------------


@query(
    "cast_columns",
    """select row_id, userid::int as "user", itemid::int as item, rating::int as stars, rating as label from rat""",
    "rat",
)
def cast_columns(spark, sf_dir):
    df = ratings(spark, sf_dir).drop("Time", "Location", "Companion")
    return df.withColumnsRenamed({"userid": "user", "itemid": "item", "rating": "label"}).select(
        "row_id",
        F.col("user").try_cast("int").alias("user"),
        F.col("item").try_cast("int").alias("item"),
        F.col("label").cast("int").alias("stars"),
        "label",
    )


@query("rescale_ratings", "select row_id, rating from resc", "resc")
def rescale_ratings(spark, sf_dir):
    return scaled(spark, sf_dir).select("row_id", "rating")


@query(
    "math_scalars",
    """select row_id, round(round(x), 6) + 0.0 as rounded, round(sqrt(abs(x)), 6) + 0.0 as root,
    round(pow(x, 2), 6) + 0.0 as squared, round(abs(x), 6) + 0.0 as magnitude,
    round(1 / (1 + exp(-x)), 6) + 0.0 as logistic, sign(x)::double as sign,
    round(greatest(least(x, 1.0), -1.0), 6) + 0.0 as clamped from (select row_id, value / 50 - 3 as x from rat)""",
    "rat",
)
def math(spark, sf_dir):
    x = F.col("value") / 50 - 3
    columns = [rounded(c).alias(n) for n, c in math_scalars(x).items()]
    return tables.contextual_ratings(spark, sf_dir).select("row_id", *columns)


@query(
    "item_splitting",
    """, split_items as (select row_id, userid, rating,
      itemid || chr(9) || "Time" || chr(9) || "Location" || chr(9) || "Companion" as itemid from rat),
    numbers as (select itemid, row_number() over (order by itemid) - 1 as idx
      from (select distinct itemid from split_items))
    select row_id, userid, itemid, idx::double as "itemidI", rating from split_items join numbers using (itemid)""",
    "rat",
)
def item_splitting(spark, sf_dir):
    df = ops.split_items(ratings(spark, sf_dir))
    index = index_table(df, "itemid", "alphabetAsc")
    return string_index(df, "itemid", "itemidI", index, row()).select(
        "row_id", "userid", "itemid", "itemidI", "rating"
    )


_FLAGS = ", ".join(
    f"""("{c}" = '{v}')::int::double as "{c}_{v}" """
    for c, vs in {
        "Time": ("NA", "Weekday", "Weekend"),
        "Location": ("Cinema", "Home", "NA"),
        "Companion": ("Alone", "Family", "NA", "Partner"),
    }.items()
    for v in vs
)


@query("pivot_context", f"select row_id, {_FLAGS} from rat", "rat")
def pivot_context(spark, sf_dir):
    df = ratings(spark, sf_dir)
    return ops.pivot_values(df, CONTEXT_VALUES, ["row_id"])


# ---- filters -----------------------------------------------------------------------------------


@query("context_filter", "select row_id, userid, itemid, rating from inctx", "inctx")
def context_filter(spark, sf_dir):
    return ops.context_filter(fine(spark, sf_dir), CONTEXT).select("row_id", "userid", "itemid", "rating")


@query(
    "in_contexts",
    """select row_id, userid, itemid, rating from rat where ("Time", "Location", "Companion") in
    (select ("Time", "Location", "Companion") from rat where userid = '8' and rating >= 4)""",
    "rat",
)
def in_contexts(spark, sf_dir):
    """All ratings given in a context that the example user liked something in."""
    df = ratings(spark, sf_dir)
    wanted = df.filter((F.col("userid") == USER_ID) & (F.col("rating") >= 4))
    return ops.in_contexts(df, wanted).select("row_id", "userid", "itemid", "rating")


@query(
    "known_context",
    """select row_id, userid, itemid, rating from rat
    where "Time" <> 'NA' and "Location" <> 'NA' and "Companion" <> 'NA'""",
    "rat",
)
def known_context(spark, sf_dir):
    return ops.known_context(ratings(spark, sf_dir)).select("row_id", "userid", "itemid", "rating")


@query("positive_ratings", "select row_id, rating from resc where rating > 0", "resc")
def positive_ratings(spark, sf_dir):
    return ops.positive(scaled(spark, sf_dir)).select("row_id", "rating")


@query(
    "unseen_items",
    "select distinct itemid from rat5 where itemid not in (select itemid from rat5 where userid = '8')",
    "rat5",
)
def unseen_items(spark, sf_dir):
    return ops.unseen_items(fine(spark, sf_dir), USER_ID)


@query(
    "unseen_items_ctx",
    "select distinct itemid from inctx where itemid not in (select itemid from inctx where userid = '8')",
    "inctx",
)
def unseen_items_ctx(spark, sf_dir):
    return ops.unseen_items(ops.context_filter(fine(spark, sf_dir), CONTEXT), USER_ID)


@query(
    "unseen_items_sql",
    "select distinct itemid from rat5 where itemid not in (select itemid from rat5 where userid = '8')",
    "rat5",
)
def unseen_items_sql(spark, sf_dir):
    return ops.unseen_items_sql(fine(spark, sf_dir), USER_ID)


# ---- aggregates --------------------------------------------------------------------------------


@query(
    "weighted_ratings",
    """select userid, itemid, "Time", "Location", "Companion", round(sum("Weight" * "Value"), 6) + 0.0 as rating
    from wev group by all""",
    "wev",
)
def weighted_ratings(spark, sf_dir):
    df = ops.roll_up(tables.weighted_events(spark, sf_dir), ("userid", "itemid", "Time", "Location", "Companion"))
    return df.withColumn("rating", rounded(F.col("rating")))


@query("rating_range", "select min(rating) as min_rating, max(rating) as max_rating from plain", "plain")
def rating_range(spark, sf_dir):
    return ops.rating_range(tables.plain_ratings(spark, sf_dir))


@query(
    "dataset_stats",
    "select count(*) as ratings, count(distinct userid) as users, count(distinct itemid) as items from plain",
    "plain",
)
def dataset_stats(spark, sf_dir):
    return ops.dataset_stats(tables.plain_ratings(spark, sf_dir))


@query("distinct_values", "select distinct itemid from rat5", "rat5")
def distinct_values(spark, sf_dir):
    return fine(spark, sf_dir).select("itemid").distinct()


# ---- splits and unions -------------------------------------------------------------------------


@query("mod_split", "select row_id, ts_s, split from split", "split")
def mod_split(spark, sf_dir):
    return ops.modulo_split(tables.contextual_ratings(spark, sf_dir), "ts_s").select("row_id", "ts_s", "split")


@query("split_sizes", "select split, count(*) as n from split group by split", "split")
def split_sizes(spark, sf_dir):
    return ops.split_sizes(ops.modulo_split(tables.contextual_ratings(spark, sf_dir), "ts_s"))


@query(
    "hash_split",
    f"""select userid, itemid, rating, {spot_split("'3:' || userid || ':' || itemid", train=600000, validation=800000)}
      as split from plain""",
    "plain",
)
def hash_split(spark, sf_dir):
    """Random 60/20/20 by user and item."""
    shares = {"train": 0.6, "validation": 0.2, "test": 0.2}
    return ops.hash_split(tables.plain_ratings(spark, sf_dir), shares, "userid", "itemid", seed=3)


@query(
    "arithmetic_split",
    """, b as (select *, (userid * 7 + itemid * 13) % 10 as bucket from plain)
    select userid, itemid, rating, bucket,
      case when bucket < 6 then 'train' when bucket < 8 then 'validation' else 'test' end as split from b""",
    "plain",
)
def arithmetic_split(spark, sf_dir):
    df = tables.plain_ratings(spark, sf_dir)
    bucket = ops.arithmetic_bucket(F.col("userid"), F.col("itemid"))
    return df.withColumn("bucket", bucket).withColumn("split", ops.three_way(F.col("bucket")))


@query(
    "random_buckets",
    f"""select {spot_split("'7:' || row_id", train=600000, validation=800000)} as split, count(*) as n from rat group by 1""",
    "rat",
)
def random_buckets(spark, sf_dir):
    shares = {"train": 0.6, "validation": 0.2, "test": 0.2}
    return ops.split_sizes(ops.hash_split(ratings(spark, sf_dir), shares, "row_id", seed=7))


@query("random_split", f"""select {spot_split("'11:' || row_id", train=800000)} as split, count(*) as n from rat group by 1""", "rat")
def random_split(spark, sf_dir):
    split = ops.hash_split(ratings(spark, sf_dir), {"train": 0.8, "test": 0.2}, "row_id", seed=11)
    return ops.split_sizes(split)


@query("sample_user", "select userid from (select distinct userid from rat) order by md5('0:' || userid), userid limit 1", "rat")
def sample_user(spark, sf_dir):
    return sample_one(ratings(spark, sf_dir), "userid", seed=0)


@query(
    "union_training",
    """select userid, itemid, rating from split where split = 'train'
    union all select userid, itemid, rating from split where split = 'train' and userid = '8'""",
    "split",
)
def union_training(spark, sf_dir):
    df = ops.rescale_ratings(tables.contextual_ratings(spark, sf_dir))
    train = ops.modulo_split(df, "ts_s").filter(F.col("split") == "train").select("userid", "itemid", "rating")
    return ops.with_personal(train, train.filter(F.col("userid") == USER_ID))
