import hashlib
import math
from collections import Counter

import pytest
from cases import SCHEMA, rows
from pyspark.sql import functions as F

from sitrec.llm.mixing import mix_sources


def drawn(key, rate):
    parts = max(1, math.ceil(rate / 32.0))
    mean, n = rate / parts, 0
    for part in range(parts):
        u = int(hashlib.md5(f"42:{key}:{part}".encode()).hexdigest()[:13], 16) / 16**13
        p = c = math.exp(-mean)
        k = 0
        while c <= u and k < math.ceil(mean + math.sqrt(mean) * 12 + 20):
            k += 1
            p = p * mean / k
            c += p
            n += 1
    return n


@pytest.mark.parametrize("weights", [None, {"a": 300.0, "b": 1.0, None: 2.0, "c": 0.0}])
def test_against_brute_force(spark, weights):
    data = rows()
    got = mix_sources(spark.createDataFrame(data, SCHEMA), weights)
    volume, weight = Counter(), {}
    for _, t, _, s, *_ in data:
        volume[s] += len(t or "")
        weight[s] = (weights or {}).get(s, 1.0)
    every, sums = sum(volume.values()), sum(weight.values())
    want = Counter()
    for d, _, _, s, *_ in data:
        rate = weight[s] * (1.0 * every / sums) / volume[s] if volume[s] else 1.0
        for copy in range(drawn("" if d is None else d, rate)):
            want[d, s, copy] += 1
    assert Counter((r.doc_id, r.source, r.copy) for r in got.collect()) == want


def test_order_is_global(spark):
    keys = [r.shuffle_key for r in mix_sources(spark.createDataFrame(rows(), SCHEMA), epochs=3.0).collect()]
    assert keys == sorted(keys) and len(set(keys)) > 10


def test_rates_are_met(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("some text").alias("text"), F.when(F.col("id") % 4 == 0, "x").otherwise("y").alias("source")
    )
    n = {r.source: r["count"] for r in mix_sources(docs).groupBy("source").count().collect()}
    assert abs(n["x"] - 10_000) < 400 and abs(n["y"] - 10_000) < 400


def test_edges(spark, capsys):
    empty = spark.createDataFrame([], SCHEMA)
    assert mix_sources(empty).collect() == []
    with pytest.raises(ValueError):
        mix_sources(empty, {"a": -1.0})
    mix_sources(spark.createDataFrame(rows(), SCHEMA)).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan


def test_small_sources_are_joined(spark):
    data = [(i, "text of it", "big") for i in range(3000)] + [(5000, "few", "small"), (5001, "few", "other")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = mix_sources(docs, {"big": 1.0, "small": 0.01, "other": 0.01})
    assert {"small", "other"} <= {r.source for r in got.select("source").distinct().collect()}


def test_tiny_source_is_spread_in_blocks(spark):
    data = [(1, "x" * 1500, "large"), (2, "y" * 1500, "large"), (3, "ab", "tiny"), (3, "cd", "tiny"), (4, None, "tiny")]
    data = [(i, t if i == 3 or t is None else t * 100, s) for i, t, s in data]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = mix_sources(docs)
    rate = (2 * 150_000 + 4) / 2 / 4
    assert rate > 32_000  # several blocks a row
    n = drawn(3, rate)
    tiny = got.where("source = 'tiny'").groupBy("doc_id", "text").agg(
        F.count("*").alias("rows"), F.countDistinct("copy").alias("copies"), F.min("copy").alias("a"), F.max("copy").alias("b"), F.max("n_copies").alias("n")
    )
    found = {(r.doc_id, r.text): tuple(r)[2:] for r in tiny.collect()}
    assert found == {
        (3, "ab"): (n, n, 0, n - 1, n),
        (3, "cd"): (n, n, 0, n - 1, n),
        (4, None): (drawn(4, rate),) * 2 + (0, drawn(4, rate) - 1, drawn(4, rate)),
    }
    large = {d: drawn(d, (2 * 150_000 + 4) / 2 / 300_000) for d in (1, 2)}
    assert {r.doc_id: r["count"] for r in got.where("source = 'large'").groupBy("doc_id").count().collect()} == {
        d: k for d, k in large.items() if k
    }
