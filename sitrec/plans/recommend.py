"""Items for a user in a context: modelling, pre-filtering, post-filtering, item splitting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrec.functions.scalar import known, plus
from sitrec.models import als
from sitrec.models.fm import FMModel, pair_term
from sitrec.operators.encoding import index_table, string_index
from sitrec.operators.ordering import top_k
from sitrec.operators.relational import context_filter, context_matches, split_items, unseen_items, user_rows
from sitrec.sources.ratings import CONTEXTS, ITEM, USER


# ---- contextual modelling ----------------------------------------------------------------------


def request_vector(dictionary: DataFrame, model: FMModel, user: str, context: Mapping[str, str]) -> DataFrame:
    """One row ``base, v0.., known``: the part of the score that all items share, the factor sums of
    the request, and the number of its values that the dictionary knows.

    An unknown user or context value adds nothing; a context that is no column of the dictionary is an error.
    """
    blocks = {r["name"] for r in dictionary.select("name").distinct().collect()}
    if strange := set(context) - blocks | ({USER, ITEM} & set(context)):
        raise ValueError(f"no context columns of the dictionary: {sorted(strange)}")
    wanted = (F.col("name") == USER) & (F.col("val") == F.lit(user))
    for dim, value in context.items():
        wanted = wanted | ((F.col("name") == dim) & (F.col("val") == F.lit(value)))
    k = model.num_factors
    sums = dictionary.filter(wanted).join(model.factors, "idx").selectExpr(
        f"{known('sum(w)')} as lin",
        *(f"{known(f'sum({v})')} as s{f}" for f, v in enumerate(model.v)),
        f"{known('sum(' + plus([f'{v} * {v}' for v in model.v]) + ')')} as q",
        "count(1) as known",
    )
    return sums.selectExpr(
        f"{model.intercept!r}D + lin + {pair_term(k)} as base", *(f"s{f} as v{f}" for f in range(k)), "known"
    )


def item_vectors(dictionary: DataFrame, model: FMModel) -> DataFrame:
    """``itemid, w, v0..``: weight and factors of every item."""
    items = dictionary.filter(F.col("name") == ITEM).select("val", "idx")
    return items.join(model.factors, "idx").select(F.col("val").alias(ITEM), "w", *model.v)


def score_items(
    dictionary: DataFrame,
    model: FMModel,
    user: str,
    context: Mapping[str, str],
    items: DataFrame | None = None,
) -> DataFrame:
    """``itemid, rating`` of every item (or of the given ones) for one request.

    An item adds one feature to the request, so its score is the shared part, its weight and one
    inner product: linear in the items, no pairs in long form.
    """
    request = request_vector(dictionary, model, user, context)
    whole = request.select(F.struct("base", *model.v)).scalar()
    vectors = item_vectors(dictionary, model)
    if items is not None:
        vectors = vectors.join(items.select(ITEM), ITEM, "left_semi")
    raw = F.expr(f"_r.base + w + {plus([f'{v} * _r.{v}' for v in model.v])}")
    return vectors.withColumn("_r", whole).select(ITEM, model.link(raw).alias("rating"))


def recommend_by_model(
    dictionary: DataFrame,
    model: FMModel,
    user: str,
    context: Mapping[str, str],
    exclude_rated: DataFrame | None = None,
) -> DataFrame:
    """Contextual modelling: items with a positive score, best first.

    Rated items stay unless the ratings are given in ``exclude_rated``.
    """
    scored = score_items(dictionary, model, user, context)
    if exclude_rated is not None:
        rated = user_rows(exclude_rated, user).select(ITEM).distinct()
        scored = scored.join(rated, ITEM, "left_anti")
    return scored.filter(F.col("rating") > 0).orderBy(F.col("rating").desc(), ITEM)


# ---- filtering around a factor model -----------------------------------------------------------


@dataclass(frozen=True)
class Factors:
    """Indexed users and items with their factor tables ``id, features``."""

    users: DataFrame
    items: DataFrame
    user_factors: DataFrame
    item_factors: DataFrame
    rank: int

    def user_id(self, user: str) -> Column:
        return self.users.filter(F.col(USER) == F.lit(user)).select("idx").scalar()

    def score(self, items: DataFrame, user: str) -> DataFrame:
        """``itemid, rating`` of one user for the given items; nothing for an unknown user."""
        indexed = items.join(self.items.select(ITEM, F.col("idx").alias(als.ITEM_I)), ITEM)
        scored = als.user_scores(indexed, self.user_id(user), self.user_factors, self.item_factors, self.rank)
        return scored.select(ITEM, F.col("prediction").alias("rating"))


def indexed_ratings(ratings: DataFrame, spread: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ratings with integer ids beside the names, and the two index tables."""
    users, items = index_table(ratings, USER), index_table(ratings, ITEM)
    coded = string_index(ratings, USER, als.USER_I, users, spread)
    coded = string_index(coded, ITEM, als.ITEM_I, items, spread)
    whole = {c: F.col(c).cast("int") for c in (als.USER_I, als.ITEM_I)}
    return coded.withColumns(whole), users, items


def als_factors(model: ALSModel, users: DataFrame, items: DataFrame) -> Factors:
    return Factors(users, items, model.userFactors, model.itemFactors, model.rank)


def prefilter_candidates(ratings: DataFrame, user: str, context: Mapping[str, str]) -> DataFrame:
    """Items rated in the context that the user has not rated in it."""
    return unseen_items(context_filter(ratings, context), user)


def postfilter_candidates(ratings: DataFrame, user: str, context: Mapping[str, str]) -> DataFrame:
    """Items the user has not rated at all, as far as they occur in the context."""
    found = context_filter(ratings, context).groupBy(ITEM).agg(F.count(F.lit(1)).alias("_n"))
    return unseen_items(ratings, user).join(found.filter("_n > 0").select(ITEM), ITEM, "left_semi")


def recommend_prefiltered(ratings: DataFrame, factors: Factors, user: str, context: Mapping[str, str]) -> DataFrame:
    scored = factors.score(prefilter_candidates(ratings, user, context), user)
    return scored.filter(F.col("rating") > 0).orderBy(F.col("rating").desc(), ITEM)


def recommend_postfiltered(
    ratings: DataFrame, factors: Factors, user: str, context: Mapping[str, str], weigh: bool = False
) -> DataFrame:
    """Post-filtering: keep the items that occur in the context.

    With ``weigh`` the list is adjusted instead: every score is multiplied by the share of the
    item's ratings that were given in the context.
    """
    if not weigh:
        scored = factors.score(postfilter_candidates(ratings, user, context), user)
    else:
        share = ratings.groupBy(ITEM).agg(F.avg(context_matches(context).cast("double")).alias("share"))
        scored = factors.score(unseen_items(ratings, user), user).join(share, ITEM)
        scored = scored.select(ITEM, (F.col("rating") * F.col("share")).alias("rating"))
    return scored.filter(F.col("rating") > 0).orderBy(F.col("rating").desc(), ITEM)


# ---- item splitting ----------------------------------------------------------------------------


def recommend_split_items(
    ratings: DataFrame, factors: Factors, user: str, k: int = 5, contexts: Sequence[str] = CONTEXTS
) -> DataFrame:
    """Best k items-in-context the user has not rated, numbered, with context in the name.

    ``factors`` are those of the split items.
    """
    fresh = unseen_items(split_items(ratings, contexts), user)
    return top_k(factors.score(fresh, user), k, F.col("rating").desc(), F.col(ITEM).asc())
