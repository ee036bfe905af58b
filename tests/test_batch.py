"""Lists for many requests against plain loops; blocks, copies and pruning change no list."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitrec.plans import batch
from sitrec.plans.batch import placed_items, recommend_filtered, visits
from sitrec.plans.recommend import Factors

CONTEXTS = [("a", "x"), ("b", "y"), ("a", "y")]


@pytest.fixture(scope="module")
def world(spark):
    rng = np.random.default_rng(5)
    users = {f"u{k}": rng.normal(0, 1, 3).round(1) for k in range(14)}
    items = {f"i{k:02d}": (rng.normal(0, 1, 3) * (3 if k % 9 == 0 else 0.3)).round(1) for k in range(60)}
    items["i01"], items["i40"] = items["i50"], items["i50"] * 0  # ties, and a vector without length
    facts = [(f"u{rng.integers(15)}", f"i{rng.integers(62):02d}", *CONTEXTS[rng.integers(3)]) for _ in range(500)]
    facts += [("u3", "i05", "a", "x")] * 30
    rating = spark.createDataFrame(facts, "userid string, itemid string, Time string, Location string")

    def index(names, name):
        return spark.createDataFrame([(n, i) for i, n in enumerate(names)], f"{name} string, idx int")

    def vectors(table):
        return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(table.values())], "id int, features array<double>")

    factors = Factors(index(users, "userid"), index(items, "itemid"), vectors(users), vectors(items), 3)
    asked = [(k * 10 + c, f"u{k}", *CONTEXTS[c]) for k in range(15) for c in range(3)]
    requests = spark.createDataFrame(asked, "request_id bigint, userid string, Time string, Location string")
    return users, items, facts, rating, factors, asked, requests


def slow(world, k, flow, minimum):
    users, items, facts, _, _, asked, _ = world
    rated, by_context, offered = defaultdict(set), defaultdict(set), defaultdict(set)
    for u, i, *c in facts:
        rated[u].add(i)
        by_context[u, *c].add(i)
        offered[tuple(c)].add(i)
    out = {}
    for request, u, *c in asked:
        if u not in users:
            continue
        names = {i for _, i, *_ in facts} if flow == "split" else offered[tuple(c)]
        gone = by_context[u, *c] if flow == "pre" else rated[u]
        scores = [(-round(float(users[u] @ items[i]), 9), i) for i in names - gone if i in items]
        out[request] = [(i, -s) for s, i in sorted(scores) if -s > minimum][:k]
    return {r: v for r, v in out.items() if v}


def lists(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.request_id, r["rank"])):
        out[r.request_id].append((r.itemid, round(r.rating, 9)))
    return dict(out)


@pytest.mark.parametrize("flow", ["pre", "post", "split"])
@pytest.mark.parametrize("chunk,block,k,minimum", [(1024, 16384, 4, 0.0), (5, 7, 4, 0.0), (3, 1, 2, -1e9), (6, 10, 100, 0.5)])
def test_lists(world, flow, chunk, block, k, minimum):
    _, _, _, rating, factors, _, requests = world
    got = recommend_filtered(requests, rating, factors, k, flow, ["Time", "Location"], minimum, chunk, block)
    assert lists(got) == slow(world, k, flow, minimum)


def test_left_out_blocks(spark, world):
    """Blocks that cannot reach a list are not visited, and most are not."""
    _, _, _, _, factors, _, _ = world
    placed, reach = placed_items(factors, 6)
    assert reach == sorted(reach, reverse=True) and placed.count() == 60
    rows = spark.createDataFrame([(1, 1.0, reach[3]), (2, 0.1, reach[0]), (3, 1.0, None), (4, 0.0, None)], "request_id long, length double, least double")
    seen = visits(rows, reach, 1, 0.0).groupBy("request_id").agg(F.count("*").alias("n")).collect()
    blocks = {r.request_id: r.n for r in seen}
    assert blocks[1] == sum(m >= reach[3] - 1e-9 for m in reach[1:]) and 2 not in blocks and blocks[3] == len(reach) - 1
    assert 4 in blocks  # nothing is known yet, and the lower limit is 0


def test_no_join_by_block_alone(world, monkeypatch):
    """Chunks of one block meet copies of it in different tasks."""
    _, _, _, rating, factors, _, requests = world
    plans = []
    kept = batch.top_k_per
    monkeypatch.setattr(batch, "top_k_per", lambda df, *a: plans.append(df) or kept(df, *a))
    recommend_filtered(requests, rating, factors, 3, "split", chunk=2, block=1 << 14)
    plan = plans[-1]._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]  # the block is a constant in the first pass
    assert any("_copy" in line for line in joins)
    assert all("_copy" in line for line in joins if "_block" in line)


def test_empty(spark, world):
    _, _, _, rating, factors, _, requests = world
    assert recommend_filtered(requests.limit(0), rating, factors, 3, "split").collect() == []
    bare = Factors(factors.users, factors.items.limit(0), factors.user_factors, factors.item_factors, 3)
    assert recommend_filtered(requests, rating, bare, 3, "split").collect() == []
