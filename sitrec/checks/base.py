"""Registry of named queries, the views they read and the same views in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitrec.models.fm import FMModel, factor_columns
from sitrec.operators.encoding import feature_dictionary, index_table
from sitrec.operators.relational import rescale_ratings
from sitrec.plans.recommend import Factors
from sitrec.sources import tables
from sitrec.sources.ratings import ITEM, USER

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}

# The example request and the fixed model parameters of the checks.
USER_ID = "8"
CONTEXT = {"Time": "Weekend", "Location": "Home", "Companion": "Family"}
W0, K, ALS_K = 0.05, 8, 4
CONTEXT_VALUES = {
    "Time": ("NA", "Weekday", "Weekend"),
    "Location": ("Cinema", "Home", "NA"),
    "Companion": ("Alone", "Family", "NA", "Partner"),
}


def query(name: str, sql: str | None = None, uses: str = ""):
    """Register a query; ``uses`` names the SQL views its twin reads."""

    def keep(run: Query) -> Query:
        ENTRIES[name] = Entry(run, None if sql is None else with_views(sql, uses.split()))
        return run

    return keep


# ---- Spark side --------------------------------------------------------------------------------


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.contextual_ratings(spark, sf_dir).select(
        "row_id", "userid", "user_key", "itemid", "rating", "Time", "Location", "Companion"
    )


def scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rescale_ratings(ratings(spark, sf_dir))


def fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.finer_items(ratings(spark, sf_dir))


def row() -> Column:
    return F.col("row_id")


def fixed_model(dictionary: DataFrame, scale: float = 250.0, k: int = K, task: str = "regression") -> FMModel:
    """A model whose parameters follow from the feature index."""
    i = F.col("idx")

    def cell(f: int, by: float) -> Column:
        return (F.pmod(i * 37 + f * 11, F.lit(101)) - 50) / F.lit(by)

    factors = dictionary.select(
        "idx", cell(0, 500.0).alias("w"), *(cell(f, scale).alias(v) for f, v in enumerate(factor_columns(k)))
    )
    return FMModel(factors, W0, dictionary.count(), k, -1.0, 1.0, task)


def dictionary_and_model(spark: SparkSession, sf_dir: str, **kind) -> tuple[DataFrame, FMModel]:
    dictionary = feature_dictionary(ratings(spark, sf_dir))
    return dictionary, fixed_model(dictionary, **kind)


def fixed_factors(df: DataFrame) -> Factors:
    """Factor tables that follow from the frequency index of users and items."""
    users, items = index_table(df, USER), index_table(df, ITEM)

    def table(index: DataFrame, a: int, b: int, m: int, off: int) -> DataFrame:
        cells = [(F.pmod(F.col("idx") * a + f * b, F.lit(m)) - off) / F.lit(20.0) for f in range(ALS_K)]
        return index.select(F.col("idx").alias("id"), F.array(*cells).alias("features"))

    return Factors(users, items, table(users, 17, 5, 23, 11), table(items, 29, 7, 19, 9), ALS_K)


# ---- SQL side ----------------------------------------------------------------------------------

VIEWS: dict[str, tuple[str, str]] = {
    "rat": (
        "",
        """select event_id as row_id, cast(user_id as varchar) as userid,
        json_extract_string(props, '$.k') as itemid,
        1.0::double + (value >= 15)::int + (value >= 35)::int + (value >= 70)::int + (value >= 140)::int as rating,
        case when event_type = 'error' then 'NA' when isodow(ts) >= 6 then 'Weekend' else 'Weekday' end as "Time",
        case when event_type = 'error' then 'NA' when hour(ts) < 12 then 'Home' else 'Cinema' end as "Location",
        case event_type when 'view' then 'Alone' when 'signup' then 'Alone' when 'click' then 'Family'
          when 'purchase' then 'Partner' else 'NA' end as "Companion",
        epoch_us(ts) // 1000000 as ts_s, value, event_type from events""",
    ),
    "rat5": ("rat", """select * replace (itemid || '-' || (row_id % 5)::varchar as itemid) from rat"""),
    "wev": (
        "rat",
        """select userid, itemid, "Time", "Location", "Companion",
        case event_type when 'view' then 1 when 'click' then 2 when 'signup' then 3 when 'purchase' then 5 else 0 end
          as "Weight", value as "Value" from rat""",
    ),
    "plain": (
        "",
        """select o_custkey as userid, l_partkey as itemid, floor((l_quantity - 1) / 10) + 1.0::double as rating
        from lineitem join orders on l_orderkey = o_orderkey""",
    ),
    "resc": (
        "rat",
        """select * replace ((rating - (select min(rating) from rat))
          / ((select max(rating) from rat) - (select min(rating) from rat)) * 2 - 1 as rating) from rat""",
    ),
    "resc5": ("resc", """select * replace (itemid || '-' || (row_id % 5)::varchar as itemid) from resc"""),
    "vals": (
        "rat",
        """select 0 as block, userid as val from rat union all select 1, itemid from rat
        union all select 2, "Time" from rat union all select 3, "Location" from rat
        union all select 4, "Companion" from rat""",
    ),
    "dic": (
        "vals",
        """select block, val, count(*) as n, row_number() over (order by block, val) - 1 as idx
        from vals group by block, val""",
    ),
    "feat": (
        "resc dic",
        """select row_id, rating, idx from resc join dic on (block = 0 and val = userid)
        union all select row_id, rating, idx from resc join dic on (block = 1 and val = itemid)
        union all select row_id, rating, idx from resc join dic on (block = 2 and val = "Time")
        union all select row_id, rating, idx from resc join dic on (block = 3 and val = "Location")
        union all select row_id, rating, idx from resc join dic on (block = 4 and val = "Companion")""",
    ),
    "fw": ("dic", "select idx, ((idx * 37) % 101 - 50) / 500.0::double as w from dic"),
    "fv": (
        "dic",
        """select idx, f, ((idx * 37 + f * 11) % 101 - 50) / 250.0::double as v
        from dic, (select unnest(range(8)) as f)""",
    ),
    "sums": ("feat fv", "select row_id, f, sum(v) as s, sum(v * v) as q from feat join fv using (idx) group by row_id, f"),
    "scored": (
        "sums feat fw",
        """select row_id, rating, 0.05::double + lin + pair as raw,
          least(1.0, greatest(-1.0, 0.05::double + lin + pair)) as prediction, lin, pair
        from (select row_id, sum(s * s - q) / 2 as pair from sums group by row_id)
        join (select row_id, any_value(rating) as rating, sum(w) as lin from feat join fw using (idx) group by row_id)
          using (row_id)""",
    ),
    "req": (
        "dic",
        """select i.idx as item, i.val as itemid, i.idx as idx from dic i where i.block = 1
        union all select i.idx, i.val, r.idx from dic i, dic r where i.block = 1
          and ((r.block = 0 and r.val = '8') or (r.block = 2 and r.val = 'Weekend')
            or (r.block = 3 and r.val = 'Home') or (r.block = 4 and r.val = 'Family'))""",
    ),
    "reqscore": (
        "req fw fv",
        """select itemid, least(1.0, greatest(-1.0, 0.05::double + lin + pair)) as rating
        from (select item, itemid, sum(w) as lin from req join fw using (idx) group by item, itemid)
        join (select item, sum(s * s - q) / 2 as pair from (
            select item, f, sum(v) as s, sum(v * v) as q from req join fv using (idx) group by item, f)
          group by item) using (item)""",
    ),
    "uidx": ("rat5", "select userid, count(*) as n, row_number() over (order by count(*) desc, userid) - 1 as idx from rat5 group by userid"),
    "iidx": ("rat5", "select itemid, count(*) as n, row_number() over (order by count(*) desc, itemid) - 1 as idx from rat5 group by itemid"),
    "ufac": (
        "uidx",
        """select userid, f, ((idx * 17 + f * 5) % 23 - 11) / 20.0::double as u
        from uidx, (select unnest(range(4)) as f)""",
    ),
    "ifac": (
        "iidx",
        """select itemid, f, ((idx * 29 + f * 7) % 19 - 9) / 20.0::double as i
        from iidx, (select unnest(range(4)) as f)""",
    ),
    "pairs": (
        "rat5 ufac ifac",
        """select userid, itemid, sum(u * i) as prediction
        from (select distinct userid, itemid from rat5) join ufac using (userid) join ifac using (itemid, f)
        group by userid, itemid""",
    ),
    "inctx": (
        "rat5",
        """select * from rat5 where "Time" = 'Weekend' and "Location" = 'Home' and "Companion" = 'Family'""",
    ),
    "split": (
        "resc",
        """select *, case when ts_s % 10 < 6 then 'train' when ts_s % 10 < 8 then 'validation' else 'test' end as split
        from resc""",
    ),
    "tok": (
        "",
        r"""select doc_id, unnest(string_split_regex(regexp_replace(lower(text), '\s+$', ''), '\s')) as term
        from documents""",
    ),
    "emb": (
        "",
        """select vec_id, unnest(embedding)::double as x, generate_subscripts(embedding, 1) - 1 as dim from embeddings""",
    ),
    "ctxidx": (
        "rat",
        """select 'Time' as d, "Time" as val, row_number() over (order by count(*) desc, "Time") - 1 as idx
          from rat group by "Time"
        union all select 'Location', "Location", row_number() over (order by count(*) desc, "Location") - 1
          from rat group by "Location"
        union all select 'Companion', "Companion", row_number() over (order by count(*) desc, "Companion") - 1
          from rat group by "Companion" """,
    ),
    "ctxrow": (
        "rat ctxidx",
        """select row_id, rating, t.idx::double as t, l.idx::double as l, c.idx::double as c from rat
        join ctxidx t on t.d = 'Time' and t.val = "Time" join ctxidx l on l.d = 'Location' and l.val = "Location"
        join ctxidx c on c.d = 'Companion' and c.val = "Companion" """,
    ),
}


def spot_split(key: str, last: str = "test", **upto: int) -> str:
    """The seeded split in SQL: name of the part whose limit, in millionths, the hash of ``key`` stays below."""
    spot = f"('0x' || substr(md5({key}), 1, 8))::bigint % 1000000"
    parts = " ".join(f"when {spot} < {limit} then '{name}'" for name, limit in upto.items())
    return f"case {parts} else '{last}' end"


def with_views(sql: str, uses: list[str]) -> str:
    """Put the named views, and those they read, in front of a statement."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for needed in VIEWS[name][0].split():
                add(needed)
            ordered.append(name)

    for name in uses:
        add(name)
    if not ordered:
        return sql
    return "with " + ",\n".join(f"{n} as ({VIEWS[n][1]})" for n in ordered) + "\n" + sql
