"""Best items for many requests at once.

Every request has to be compared with every item, but no pair becomes a row: requests travel in
chunks, items in blocks, a task multiplies one chunk with one block and keeps the k best per request.
Chunks are joined to blocks by block number, spread over copies of every block, as many as
the shuffle has tasks to fill.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitrec.models.fm import REGRESSION, FMModel, score_contextual
from sitrec.operators.encoding import ENCODED
from sitrec.operators.joins import task_share
from sitrec.operators.ordering import numbered, top_k_per
from sitrec.plans.recommend import Factors, item_vectors
from sitrec.sources.ratings import CONTEXTS, ITEM, USER
from sitrec.storage import written

CHUNK, BLOCK, STRIP = 1024, 16384, 64


def _packed(df: DataFrame, name: str, key: str, numbers: Sequence[str], into: int) -> DataFrame:
    """Rows in ``into`` groups by a hash of the key; the groups keep keys in order and numbers as arrays."""
    fields = ", ".join([f"{key} as _key", *(f"cast({c} as double) as c{j}" for j, c in enumerate(numbers))])
    packed = (
        df.withColumn(name, F.pmod(F.xxhash64(key), F.lit(into)).cast("int"))
        .groupBy(name)
        .agg(F.expr(f"sort_array(collect_list(struct({fields}))) as _rows"))
    )
    columns = [f"transform(_rows, r -> r.c{j}) as {name}_c{j}" for j in range(len(numbers))]
    return packed.selectExpr(name, f"transform(_rows, r -> r._key) as {name}_key", *columns)


def _matrix(batch: pa.RecordBatch, row: int, name: str, width: int) -> np.ndarray:
    return np.column_stack([batch.column(f"{name}_c{j}")[row].values.to_numpy() for j in range(width)])


def best_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, best first, equal ones in order of position."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        kept = np.flatnonzero(scores >= least)
    else:
        kept = np.arange(len(scores))
    return kept[np.argsort(-scores[kept], kind="stable")][:k]


def block_scorer(model: FMModel, k: int, minimum: float) -> Callable:
    """Task function: best items of a block for every request of a chunk."""
    width, low, high, clamped = model.num_factors + 1, model.low, model.high, model.task == REGRESSION

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                requests, items = _matrix(batch, row, "chunk", width), _matrix(batch, row, "block", width)
                request_keys, item_keys = batch.column("chunk_key")[row].values, batch.column("block_key")[row].values
                who, what, ratings = [], [], []
                for at in range(0, len(requests), STRIP):
                    strip = requests[at : at + STRIP]
                    raw = strip[:, :1] + items[:, 0] + strip[:, 1:] @ items[:, 1:].T
                    linked = np.clip(raw, low, high) if clamped else 1.0 / (1.0 + np.exp(-raw))
                    for j, scores in enumerate(linked):
                        best = best_of(scores, k)
                        best = best[scores[best] > minimum]
                        who.append(np.full(len(best), at + j))
                        what.append(best)
                        ratings.append(scores[best])
                yield pa.RecordBatch.from_arrays(
                    [
                        request_keys.take(pa.array(np.concatenate(who))),
                        item_keys.take(pa.array(np.concatenate(what))),
                        pa.array(np.concatenate(ratings)),
                    ],
                    names=["request_id", ITEM, "rating"],
                )

    return score


def recommend_batch(
    requests: DataFrame,
    dictionary: DataFrame,
    model: FMModel,
    k: int,
    columns: Sequence[str] = ENCODED,
    minimum: float = 0.0,
    chunk: int = CHUNK,
    block: int = BLOCK,
) -> DataFrame:
    """``request_id, itemid, rating, rank``: the k best items of every request, scores above ``minimum``.

    ``requests`` has ``request_id`` (unique, bigint) and the user and context columns.  Exact: each
    block gives its own k best, and the k best of those are the k best of all.
    """
    asked = [c for c in columns if c != ITEM]
    bare = requests.select("request_id", *asked, F.lit(None).cast("string").alias(ITEM))
    parts = score_contextual(bare, dictionary, model, F.col("request_id"), columns, parts=True)
    sums = [f"s{f}" for f in range(model.num_factors)]
    vectors = written(parts.select("request_id", "raw", *sums), "requests")
    items = written(item_vectors(dictionary, model), "items")
    chunks, blocks = (max(1, math.ceil(df.count() / size)) for df, size in ((vectors, chunk), (items, block)))
    # several chunks for each task, but no copy of a block without a chunk
    copies = min(chunks, max(1, math.ceil(4 * task_share(items) / blocks)))
    left = _packed(vectors, "chunk", "request_id", ["raw", *sums], chunks)
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    left = left.withColumn("copy", F.pmod(F.col("chunk"), F.lit(copies)))
    right = _packed(items, "block", ITEM, ["w", *model.v], blocks)
    right = right.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    found = left.join(right, ["block", "copy"]).mapInArrow(
        block_scorer(model, k, minimum), f"request_id bigint, {ITEM} string, rating double"
    )
    return top_k_per(found, ["request_id"], k, F.col("rating").desc(), F.col(ITEM).asc())


# ---- candidates that differ by request ---------------------------------------------------------

DIGITS = 12  # scores are rounded so far that equal ones tie, whatever order the sums were made in


def _numbers(lists: pa.ListArray, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _filtered_scorer(k: int, minimum: float, width: int) -> Callable:
    """Task function: best candidates of a block for every request of a chunk, without those it must not list.

    Candidates come in order of name; what a request must not list are places within the block.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                asked, offered = batch.column("_asked")[row].values, batch.column("_offered")[row].values
                at_place = offered.field("place").to_numpy()
                number = np.full(int(at_place.max()) + 2, -1)  # of the candidate at a place; the last one is none
                number[at_place] = np.arange(len(at_place))
                factors, vectors = (_numbers(side.field("features"), width) for side in (offered, asked))
                skips = asked.field("skip")
                ends = np.concatenate([[0], np.cumsum(pc.list_value_length(skips).to_numpy(zero_copy_only=False))])
                skipped = number[np.minimum(skips.flatten().to_numpy(zero_copy_only=False), len(number) - 1)]
                who, what, ratings = [], [], []
                for at in range(0, len(vectors), STRIP):
                    scores = np.round(vectors[at : at + STRIP] @ factors.T, DIGITS)
                    to = min(at + STRIP, len(vectors))
                    gone = skipped[ends[at] : ends[to]]
                    line = np.repeat(np.arange(to - at), np.diff(ends[at : to + 1]))
                    scores[line[gone >= 0], gone[gone >= 0]] = -np.inf
                    for j, own in enumerate(scores):
                        best = best_of(own, k)
                        best = best[own[best] > minimum]
                        who.append(np.full(len(best), at + j))
                        what.append(best)
                        ratings.append(own[best])
                yield pa.RecordBatch.from_arrays(
                    [
                        asked.field("request_id").take(pa.array(np.concatenate(who))),
                        offered.field(ITEM).take(pa.array(np.concatenate(what))),
                        pa.array(np.concatenate(ratings)),
                    ],
                    names=["request_id", ITEM, "rating"],
                )

    return score


def placed_items(factors: Factors, block: int) -> tuple[DataFrame, list[float]]:
    """``itemid, features, _block, place`` of items with factors, the longest vectors first, and the greatest length in each block."""
    known = factors.items.join(factors.item_factors, F.col("idx") == F.col("id"))
    known = known.select(ITEM, F.col("features").cast("array<double>").alias("features"))
    length = F.sqrt(F.aggregate("features", F.lit(0.0), lambda total, x: total + x * x))
    known = known.withColumn("length", length)
    placed = numbered(known, F.col("length").desc(), F.col(ITEM).asc(), name="_at")
    cut = (F.col("_at").cast("long"), F.lit(block))
    placed = placed.withColumn("_block", F.floor(cut[0] / cut[1]).cast("int")).withColumn("place", F.pmod(*cut).cast("int"))
    placed = written(placed.drop("_at"), "items")
    greatest = placed.groupBy("_block").agg(F.max("length").alias("most")).orderBy("_block").collect()
    return placed.drop("length"), [r.most for r in greatest]


def visits(requests: DataFrame, reach: Sequence[float], first: int, minimum: float) -> DataFrame:
    """``requests`` once for every block from ``first`` on that can still add to their lists, as ``_block``.

    An inner product is at most the product of both lengths, so a block whose longest vector cannot bring a request
    above ``minimum``, or up to its k-th score ``least`` so far (null: fewer than k), is left out.
    """
    most = F.array(*(F.lit(float(m)) for m in reach))
    slack = 10.0 ** (2 - DIGITS)
    blocks = F.filter(
        F.sequence(F.lit(first), F.lit(len(reach) - 1)),
        lambda b: F.col("length") * F.element_at(most, b + 1) + slack >= F.coalesce(F.col("least"), F.lit(float(minimum))),
    )
    return requests.withColumn("_block", F.explode(blocks))


def recommend_filtered(
    requests: DataFrame,
    ratings: DataFrame,
    factors: Factors,
    k: int,
    flow: str = "pre",
    contexts: Sequence[str] = CONTEXTS,
    minimum: float = 0.0,
    chunk: int = CHUNK,
    block: int = BLOCK,
) -> DataFrame:
    """``request_id, itemid, rating, rank``: the k best unrated candidates of every request.

    ``pre`` offers items rated in the request's context and leaves out those the user has rated in it; ``post``
    leaves out whatever the user has rated.  ``split`` offers all items (in their contexts, as ``ratings`` and
    ``factors`` have them) that the user has not rated.  ``requests`` has ``request_id`` (unique, bigint), the
    user and, but for ``split``, the context columns.  Users without factors get nothing.

    Items stand in blocks, the longest vectors first, requests in chunks; a task scores one chunk against one
    block, with the places in the block that each request must not list.  Blocks are copied so that chunks of one block
    fill several tasks.  All requests meet the first block; the others only those that their length can
    still bring into the list, which changes no list.  Pairs do not become rows.
    """
    if flow not in ("pre", "post", "split"):
        raise ValueError("flow must be 'pre', 'post' or 'split'")
    keys = [] if flow == "split" else list(contexts)
    asked = requests.select("request_id", USER, *keys)
    placed, reach = placed_items(factors, block)
    users = factors.users.join(factors.user_factors, F.col("idx") == F.col("id"))
    users = users.select(USER, F.col("features").cast("array<double>").alias("features"))
    length = F.sqrt(F.aggregate("features", F.lit(0.0), lambda total, x: total + x * x)).alias("length")
    rows = written(asked.join(users, USER).select("request_id", USER, *keys, "features", length), "requests")
    chunks = max(1, math.ceil(rows.count() / chunk))
    copies = min(chunks, max(1, math.ceil(4 * task_share(rows) / max(1, len(reach)))))

    facts = ratings.select(USER, ITEM, *keys)
    seen = facts.groupBy(ITEM, *keys).agg(F.count(F.lit(1)).alias("_n")).join(placed, ITEM)
    if keys:
        seen = seen.join(asked.select(*keys).distinct(), keys)
    offered = seen.groupBy("_block", *keys).agg(
        F.sort_array(F.collect_list(F.struct(ITEM, "place", "features"))).alias("_offered")
    )
    offered = written(offered, "offered").withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    same = [USER, *keys] if flow == "pre" else [USER]
    rated = facts.join(placed.select(ITEM, "_block", "place"), ITEM).groupBy(*same, "_block").agg(
        F.collect_set("place").alias("skip")
    )
    rated = written(rated, "rated")

    def scored(asking: DataFrame) -> DataFrame:
        none = F.array().cast("array<int>")
        numbered_rows = asking.join(rated, [*same, "_block"], "left").withColumn("_chunk", F.pmod(F.xxhash64("request_id"), F.lit(chunks)).cast("int"))
        request = F.struct("request_id", "features", F.coalesce("skip", none).alias("skip"))
        chunked = numbered_rows.groupBy("_chunk", "_block", *keys).agg(F.collect_list(request).alias("_asked"))
        chunked = chunked.withColumn("_copy", F.pmod(F.col("_chunk"), F.lit(copies)))
        met = chunked.join(offered, ["_block", "_copy", *keys]).select("_asked", "_offered")
        return met.mapInArrow(_filtered_scorer(k, minimum, factors.rank), f"request_id bigint, {ITEM} string, rating double")

    order = [F.col("rating").desc(), F.col(ITEM).asc()]
    if not reach:
        return top_k_per(scored(rows.withColumn("_block", F.lit(0))), ["request_id"], k, *order)
    first = scored(rows.withColumn("_block", F.lit(0)))
    if len(reach) > 1:
        first = written(top_k_per(first, ["request_id"], k, *order).drop("rank"), "first")
        least = first.groupBy("request_id").agg(F.min("rating").alias("least"), F.count("*").alias("n")).where(F.col("n") >= k)
        rest = rows.join(least.select("request_id", "least"), "request_id", "left")
        first = first.unionByName(scored(visits(rest, reach, 1, minimum)))
    return top_k_per(first, ["request_id"], k, *order)
