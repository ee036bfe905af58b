"""Recommendation flows for the example request, and ranked lists for all users and items."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitrec.checks.base import (
    CONTEXT,
    USER_ID,
    dictionary_and_model,
    fine,
    fixed_factors,
    query,
    ratings,
    row,
    scaled,
)
from sitrec.checks.learned import _pair_scores as pair_scores
from sitrec.checks.machine import STAGED_GRID
from sitrec.functions.scalar import rounded
from sitrec.models import als
from sitrec.operators.ordering import top_k, top_k_per
from sitrec.operators.relational import split_items
from sitrec.plans import batch, recommend, stages
from sitrec.storage import new_path, written


def six(df, *columns):
    return df.withColumns({c: rounded(F.col(c)) for c in columns})


# ---- contextual modelling ----------------------------------------------------------------------


@query("score_candidates", "select itemid, round(rating, 6) + 0.0 as rating from reqscore", "reqscore")
def score_candidates(spark, sf_dir):
    dictionary, model = dictionary_and_model(spark, sf_dir)
    return six(recommend.score_items(dictionary, model, USER_ID, CONTEXT), "rating")


@query("fm_recommend", "select itemid, round(rating, 6) + 0.0 as rating from reqscore where rating > 0", "reqscore")
def fm_recommend(spark, sf_dir):
    dictionary, model = dictionary_and_model(spark, sf_dir)
    return six(recommend.recommend_by_model(dictionary, model, USER_ID, CONTEXT), "rating")


@query(
    "fm_recommend_unseen",
    """select itemid, round(rating, 6) + 0.0 as rating from reqscore
    where rating > 0 and itemid not in (select itemid from rat where userid = '8')""",
    "reqscore rat",
)
def fm_recommend_unseen(spark, sf_dir):
    dictionary, model = dictionary_and_model(spark, sf_dir)
    found = recommend.recommend_by_model(dictionary, model, USER_ID, CONTEXT, exclude_rated=ratings(spark, sf_dir))
    return six(found, "rating")


@query(
    "context_topk",
    """, c as (select distinct itemid from rat
      where "Time" = 'Weekend' and "Location" = 'Home' and "Companion" = 'Family'
        and itemid not in (select itemid from rat
          where "Time" = 'Weekend' and "Location" = 'Home' and "Companion" = 'Family' and userid = '8')),
    s as (select itemid, round(rating, 6) + 0.0 as rating from reqscore join c using (itemid) where rating > 0)
    select * from (select itemid, rating, row_number() over (order by rating desc, itemid)::int as rank from s)
    where rank <= 10""",
    "reqscore rat",
)
def context_topk(spark, sf_dir):
    """Pre-filtered candidates scored by the factorization machine: the ten best, numbered."""
    dictionary, model = dictionary_and_model(spark, sf_dir)
    fresh = recommend.prefilter_candidates(ratings(spark, sf_dir), USER_ID, CONTEXT)
    scored = recommend.score_items(dictionary, model, USER_ID, CONTEXT, items=fresh)
    good = six(scored, "rating").filter(F.col("rating") > 0)
    return top_k(good, 10, F.col("rating").desc(), F.col("itemid").asc())


@query(
    "fm_recommend_batch",
    """, u as (select idx, val as userid from dic where block = 0), i as (select idx, val as itemid from dic where block = 1),
    c as (select idx from dic where (block = 2 and val = 'Weekend') or (block = 3 and val = 'Home')
      or (block = 4 and val = 'Family')),
    p as (select u.userid, i.itemid, unnest([u.idx, i.idx] || (select list(idx) from c)) as idx from u, i),
    l as (select userid, itemid, sum(w) as lin from p join fw using (idx) group by all),
    q as (select userid, itemid, f, sum(v) as s, sum(v * v) as q from p join fv using (idx) group by all),
    sc as (select userid, itemid, round(least(1.0, greatest(-1.0, 0.05 + lin + pair)), 6) + 0.0 as rating
      from l join (select userid, itemid, sum(s * s - q) / 2 as pair from q group by all) using (userid, itemid))
    select userid, itemid, rating, rank from (select *,
      row_number() over (partition by userid order by rating desc, itemid)::int as rank from sc where rating > 0)
    where rank <= 5""",
    "dic fw fv",
)
def fm_recommend_batch(spark, sf_dir):
    """The example context for every user."""
    dictionary, model = dictionary_and_model(spark, sf_dir)
    users = ratings(spark, sf_dir).select("userid").distinct()
    asked = users.select(F.col("userid").cast("bigint").alias("request_id"), "userid", *(F.lit(v).alias(c) for c, v in CONTEXT.items()))
    best = batch.recommend_batch(asked, dictionary, model, k=5)
    return six(best.withColumn("userid", F.col("request_id").cast("string")).drop("request_id"), "rating")


# ---- filtering ---------------------------------------------------------------------------------

_USER_SCORE = """, us as (select itemid, sum(u * i) as rating from ifac
  join (select f, u from ufac where userid = '8') using (f) group by itemid)"""


@query(
    "prefilter_recommend",
    f"""{_USER_SCORE} select itemid, round(rating, 6) + 0.0 as rating from us where round(rating, 9) > 0
    and itemid in (select itemid from inctx) and itemid not in (select itemid from inctx where userid = '8')""",
    "ufac ifac inctx",
)
def prefilter_recommend(spark, sf_dir):
    df = fine(spark, sf_dir)
    return six(_nonzero(recommend.recommend_prefiltered(df, fixed_factors(df), USER_ID, CONTEXT)), "rating")


def _nonzero(df):
    """The fixed factors give exact zeros up to rounding; both engines must agree on them."""
    return df.filter(F.round("rating", 9) > 0)


@query(
    "postfilter_candidates",
    """select distinct itemid from inctx where itemid not in (select itemid from rat5 where userid = '8')""",
    "rat5 inctx",
)
def postfilter_candidates(spark, sf_dir):
    return recommend.postfilter_candidates(fine(spark, sf_dir), USER_ID, CONTEXT)


@query(
    "postfilter_recommend",
    f"""{_USER_SCORE} select itemid, round(rating, 6) + 0.0 as rating from us where round(rating, 9) > 0
    and itemid in (select itemid from inctx) and itemid not in (select itemid from rat5 where userid = '8')""",
    "ufac ifac inctx rat5",
)
def postfilter_recommend(spark, sf_dir):
    df = fine(spark, sf_dir)
    return six(_nonzero(recommend.recommend_postfiltered(df, fixed_factors(df), USER_ID, CONTEXT)), "rating")


@query(
    "postfilter_weighted",
    f"""{_USER_SCORE}, sh as (select itemid,
      avg(("Time" = 'Weekend' and "Location" = 'Home' and "Companion" = 'Family')::int) as share
      from rat5 group by itemid)
    select itemid, round(rating * share, 6) + 0.0 as rating from us join sh using (itemid)
    where round(rating * share, 9) > 0 and itemid not in (select itemid from rat5 where userid = '8')""",
    "ufac ifac rat5",
)
def postfilter_weighted(spark, sf_dir):
    df = fine(spark, sf_dir)
    found = recommend.recommend_postfiltered(df, fixed_factors(df), USER_ID, CONTEXT, weigh=True)
    return six(_nonzero(found), "rating")


# ---- many requests -----------------------------------------------------------------------------

ASKED = (("Weekend", "Home", "Family"), ("Weekday", "Cinema", "Alone"), ("NA", "NA", "NA"))
_ASKED = ", ".join(str(c) for c in ASKED)
_ALL_SCORES = f""", c("Time", "Location", "Companion") as (values {_ASKED}),
  sc as (select userid, itemid, round(sum(u * i), 6) + 0.0 as rating from ufac join ifac using (f)
    group by userid, itemid having round(sum(u * i), 9) > 0),
  offered as (select distinct itemid, "Time", "Location", "Companion" from rat5 join c using ("Time", "Location", "Companion"))"""


def _batch_sql(rated):
    return f"""{_ALL_SCORES} select * from (select userid, "Time", "Location", "Companion", itemid, rating,
      row_number() over (partition by userid, "Time", "Location", "Companion" order by rating desc, itemid)::int as rank
      from sc join offered o using (itemid) where not exists (select 1 from rat5 r where r.userid = sc.userid
        and r.itemid = o.itemid {rated})) where rank <= 5"""


def _batch(spark, sf_dir, flow):
    """The best five of every user in three contexts."""
    df = fine(spark, sf_dir)
    names = ("Time", "Location", "Companion")
    wanted = F.array(*(F.struct(F.lit(i).alias("i"), *(F.lit(v).alias(n) for n, v in zip(names, c))) for i, c in enumerate(ASKED)))
    users = df.select("userid").distinct().select("userid", F.explode(wanted).alias("c"))
    asked = users.select((F.col("userid").cast("bigint") * 3 + F.col("c.i")).alias("request_id"), "userid", *(F.col(f"c.{n}").alias(n) for n in names))
    best = batch.recommend_filtered(asked, df, fixed_factors(df), 5, flow, minimum=5e-10)
    return six(best.join(asked, "request_id").select("userid", *names, "itemid", "rating", "rank"), "rating")


@query(
    "prefilter_batch",
    _batch_sql("""and r."Time" = o."Time" and r."Location" = o."Location" and r."Companion" = o."Companion" """),
    "ufac ifac rat5",
)
def prefilter_batch(spark, sf_dir):
    return _batch(spark, sf_dir, "pre")


@query("postfilter_batch", _batch_sql(""), "ufac ifac rat5")
def postfilter_batch(spark, sf_dir):
    return _batch(spark, sf_dir, "post")


@query(
    "itemsplit_batch",
    """, sp as (select userid,
      itemid || chr(9) || "Time" || chr(9) || "Location" || chr(9) || "Companion" as itemid from rat),
    ui as (select userid, row_number() over (order by count(*) desc, userid) - 1 as idx from sp group by userid),
    ii as (select itemid, row_number() over (order by count(*) desc, itemid) - 1 as idx from sp group by itemid),
    u as (select userid, f, ((idx * 17 + f * 5) % 23 - 11) / 20.0::double as u from ui, (select unnest(range(4)) as f)),
    i as (select itemid, f, ((idx * 29 + f * 7) % 19 - 9) / 20.0::double as i from ii, (select unnest(range(4)) as f)),
    s as (select userid, itemid, round(sum(u * i), 6) + 0.0 as rating from u join i using (f) group by userid, itemid
      having round(sum(u * i), 9) > 0)
    select * from (select userid, itemid, rating,
      row_number() over (partition by userid order by rating desc, itemid)::int as rank
      from s where not exists (select 1 from sp where sp.userid = s.userid and sp.itemid = s.itemid)) where rank <= 5""",
    "rat",
)
def itemsplit_batch(spark, sf_dir):
    """The best five items-in-context of every user."""
    split = split_items(ratings(spark, sf_dir))
    asked = split.select("userid").distinct().select(F.col("userid").cast("bigint").alias("request_id"), "userid")
    best = batch.recommend_filtered(asked, split, fixed_factors(split), 5, "split", minimum=5e-10, chunk=16, block=64)
    return six(best.join(asked, "request_id").select("userid", "itemid", "rating", "rank"), "rating")


# ---- item splitting and ranked lists -----------------------------------------------------------


@query(
    "topk_named",
    """, sp as (select userid,
      itemid || chr(9) || "Time" || chr(9) || "Location" || chr(9) || "Companion" as itemid from rat),
    ui as (select userid, row_number() over (order by count(*) desc, userid) - 1 as idx from sp group by userid),
    ii as (select itemid, row_number() over (order by count(*) desc, itemid) - 1 as idx from sp group by itemid),
    u as (select f, ((idx * 17 + f * 5) % 23 - 11) / 20.0::double as u from ui, (select unnest(range(4)) as f)
      where userid = '8'),
    i as (select itemid, f, ((idx * 29 + f * 7) % 19 - 9) / 20.0::double as i from ii, (select unnest(range(4)) as f)),
    s as (select itemid, round(sum(u * i), 6) + 0.0 as rating from i join u using (f)
      where itemid not in (select itemid from sp where userid = '8') group by itemid)
    select * from (select itemid, rating, row_number() over (order by rating desc, itemid)::int as rank from s)
    where rank <= 5""",
    "rat",
)
def topk_named(spark, sf_dir):
    split = split_items(ratings(spark, sf_dir))
    factors = fixed_factors(split)
    fresh = recommend.unseen_items(split, USER_ID)
    scored = six(factors.score(fresh, USER_ID), "rating")
    return top_k(scored, 5, F.col("rating").desc(), F.col("itemid").asc())


def _ranked(key, other):
    return f""", r as (select userid, itemid, round(prediction, 6) + 0.0 as prediction from pairs)
    select * from (select userid, itemid, prediction,
      row_number() over (partition by {key} order by prediction desc, {other})::int as rank from r) where rank <= 5"""


@query("topk_per_user", _ranked("userid", "itemid"), "pairs")
def topk_per_user(spark, sf_dir):
    scored = six(pair_scores(spark, sf_dir), "prediction")
    return top_k_per(scored, ["userid"], 5, F.col("prediction").desc(), F.col("itemid").asc())


@query("topk_per_item", _ranked("itemid", "userid"), "pairs")
def topk_per_item(spark, sf_dir):
    scored = six(pair_scores(spark, sf_dir), "prediction")
    return top_k_per(scored, ["itemid"], 5, F.col("prediction").desc(), F.col("userid").asc())


@query("itemsplit_recommend")
def itemsplit_recommend(spark, sf_dir):
    df = scaled(spark, sf_dir)
    coded, users, items = recommend.indexed_ratings(split_items(df), row())
    model = als.fit(coded.select(als.USER_I, als.ITEM_I, "rating"), rank=5, reg=0.1, iterations=5)
    return recommend.recommend_split_items(df, recommend.als_factors(model, users, items), USER_ID)


@query("als_prefilter")
def als_prefilter(spark, sf_dir):
    """Pre-filtering with a fitted model, the whole flow."""
    df = scaled(spark, sf_dir)
    coded, users, items = recommend.indexed_ratings(df, row())
    coded = written(coded, "indexed")
    model = als.fit(coded.select(als.USER_I, als.ITEM_I, "rating"), rank=4, iterations=5, nonnegative=True)
    return recommend.recommend_prefiltered(coded, recommend.als_factors(model, users, items), USER_ID, CONTEXT)


@query("als_postfilter")
def als_postfilter(spark, sf_dir):
    df = scaled(spark, sf_dir)
    coded, users, items = recommend.indexed_ratings(df, row())
    coded = written(coded, "indexed")
    model = als.fit(coded.select(als.USER_I, als.ITEM_I, "rating"), rank=4, iterations=5, nonnegative=True)
    return recommend.recommend_postfiltered(coded, recommend.als_factors(model, users, items), USER_ID, CONTEXT)


@query("staged_run")
def staged_run(spark, sf_dir):
    """Prepare, design, train with the stored parameters and predict, with tables between the steps."""
    path = new_path(spark, "run")
    stages.prepare(ratings(spark, sf_dir), path)
    stages.design(spark, path, STAGED_GRID)
    stages.train(spark, path)
    return stages.predict(spark, path, USER_ID, CONTEXT)
