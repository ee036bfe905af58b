"""Least squares against fixed factors: users who rate now, and both half-steps of an alternation.

Two factors, so that SQL can solve the equations by Cramer's rule.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sitrec.checks.base import fine, fixed_factors, query, row
from sitrec.checks.flows import six
from sitrec.models.als import ITEM_I, USER_I
from sitrec.models.normal import fold_in, gram, normal_sums, solved
from sitrec.operators.encoding import string_index
from sitrec.plans import batch
from sitrec.plans.recommend import Factors
from sitrec.storage import written

# Regularisation and confidence of the checks.
REG, ALPHA = 0.1, 0.5

_ITEMS = """it as (select itemid, max(i) filter (where f = 0) as a, max(i) filter (where f = 1) as b from ifac group by itemid)"""
_USERS = """us as (select userid, max(u) filter (where f = 0) as a, max(u) filter (where f = 1) as b from ufac group by userid)"""


def _cramer(key, first, second):
    return f"""select {key}, n, round((ra * bb - rb * ab) / (aa * bb - ab * ab), 6) + 0.0 as {first},
      round((aa * rb - ab * ra) / (aa * bb - ab * ab), 6) + 0.0 as {second} from m"""


def _explicit(key, side):
    return f"""s as (select {key}, count(*) as n, sum(a * a) as aa, sum(a * b) as ab, sum(b * b) as bb, sum(a * rating) as ra,
      sum(b * rating) as rb from rat5 join {side} group by {key}),
    m as (select {key}, n, aa + {REG} * n as aa, ab, bb + {REG} * n as bb, ra, rb from s)"""


def _two(factors: Factors) -> Factors:
    def cut(table):
        return table.select("id", F.slice("features", 1, 2).alias("features"))

    return Factors(factors.users, factors.items, cut(factors.user_factors), cut(factors.item_factors), 2)


def _coded(spark, sf_dir):
    """Ratings with the numbers of users and items, and two fixed factors of each."""
    df = fine(spark, sf_dir)
    factors = _two(fixed_factors(df))
    coded = string_index(df, "userid", USER_I, factors.users, row())
    coded = string_index(coded, "itemid", ITEM_I, factors.items, row())
    return written(coded, "coded"), factors


def _step(coded, factors, key, other, table, index, name, columns, base=None, **how):
    sums = written(normal_sums(coded, table, key, other, 2, row(), **how), "sums")
    found = solved(sums, key, 2, REG, base)
    found = found.join(sums.select(F.col(key).alias("id"), "n"), "id").join(index.select(name, F.col("idx").alias("id")), "id")
    return six(found.select(name, "n", *(F.col("features")[k].alias(c) for k, c in enumerate(columns))), *columns)


@query(
    "fold_in_users",
    f", {_ITEMS}, {_explicit('userid', 'it using (itemid)')} {_cramer('userid', 'u0', 'u1')}",
    "rat5 ifac",
)
def fold_in_users(spark, sf_dir):
    """Factors of all users from their ratings, against item factors that stay as they are."""
    coded, factors = _coded(spark, sf_dir)
    return _step(coded, factors, USER_I, ITEM_I, factors.item_factors, factors.users, "userid", ("u0", "u1"))


@query(
    "als_explicit_step",
    f", {_USERS}, {_explicit('itemid', 'us using (userid)')} {_cramer('itemid', 'i0', 'i1')}",
    "rat5 ufac",
)
def als_explicit_step(spark, sf_dir):
    """The other half: factors of all items against fixed user factors."""
    coded, factors = _coded(spark, sf_dir)
    return _step(coded, factors, ITEM_I, USER_I, factors.user_factors, factors.items, "itemid", ("i0", "i1"))


@query(
    "als_implicit_step",
    f""", {_ITEMS}, y as (select sum(a * a) as yaa, sum(a * b) as yab, sum(b * b) as ybb from it),
    r as (select userid, itemid, rating, {ALPHA} * abs(rating) as c, case when rating > 0 then 1 + {ALPHA} * abs(rating) else 0 end as t
      from rat5),
    s as (select userid, count(*) filter (where rating > 0) as n, sum(c * a * a) as aa, sum(c * a * b) as ab, sum(c * b * b) as bb,
      sum(t * a) as ra, sum(t * b) as rb from r join it using (itemid) group by userid),
    m as (select userid, n, aa + yaa + {REG} * n as aa, ab + yab as ab, bb + ybb + {REG} * n as bb, ra, rb from s, y)
    {_cramer('userid', 'u0', 'u1')}""",
    "rat5 ifac",
)
def als_implicit_step(spark, sf_dir):
    """A half-step for implicit feedback: ratings are confidences, items nobody rated count too."""
    coded, factors = _coded(spark, sf_dir)
    base = gram(factors.item_factors, 2)
    how = {"implicit": True, "alpha": ALPHA, "base": base}
    return _step(coded, factors, USER_I, ITEM_I, factors.item_factors, factors.users, "userid", ("u0", "u1"), **how)


@query(
    "fold_in_lists",
    f""", {_ITEMS}, {_explicit('userid', 'it using (itemid)')},
    u as (select userid, (ra * bb - rb * ab) / (aa * bb - ab * ab) as u0, (aa * rb - ab * ra) / (aa * bb - ab * ab) as u1 from m),
    sc as (select userid, itemid, round(u0 * a + u1 * b, 6) + 0.0 as rating from u, it where round(u0 * a + u1 * b, 9) > 0),
    best as (select userid, itemid, rating from sc where not exists (select 1 from rat5 r where r.userid = sc.userid and r.itemid = sc.itemid))
    select userid, rating, rank from (select userid, rating,
      row_number() over (partition by userid order by rating desc)::int as rank from best) where rank <= 5""",
    "rat5 ifac",
)
def fold_in_lists(spark, sf_dir):
    """The five best scores among unrated items for users who rate now, without a refit.

    Items with equal factors have equal scores, so the list is compared by its scores.
    """
    coded, factors = _coded(spark, sf_dir)
    users = written(fold_in(coded, factors.item_factors, 2, REG, row()), "folded")
    now = Factors(factors.users, factors.items, users, factors.item_factors, 2)
    asked = coded.select("userid").distinct().select(F.col("userid").cast("bigint").alias("request_id"), "userid")
    best = batch.recommend_filtered(asked, coded, now, 5, "split", minimum=5e-10)
    return six(best.join(asked, "request_id").select("userid", "rating", "rank"), "rating")
