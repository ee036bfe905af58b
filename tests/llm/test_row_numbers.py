"""Rows keep their numbers when files are divided into other partitions between two jobs."""

from contextlib import contextmanager

import pytest

from sitrec.llm.exact_dedup import exact_dedup
from sitrec.llm.simhash import near_dedup
from sitrec.llm.suffix_dedup import suffix_dedup

FILES = 8


@contextmanager
def cores(spark, n):
    """Files are divided as for ``n`` cores."""
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.minPartitionNum", str(n))
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("numbers") / "docs")
    texts = [f"text number {i // 2} " + " ".join(f"w{i // 2}x{k}" for k in range(60)) for i in range(48)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows.repartitionByRange(FILES, "doc_id").write.parquet(path)
    with cores(spark, 1):
        a = spark.read.parquet(path).rdd.getNumPartitions()
    with cores(spark, FILES):
        assert spark.read.parquet(path).rdd.getNumPartitions() > a
    return spark.read.parquet(path)


def test_exact(spark, docs):
    with cores(spark, 1):
        out = exact_dedup(docs)
    with cores(spark, FILES):
        assert sorted(r.doc_id for r in out.collect() if r.kept) == list(range(1, 48, 2))


def test_near(spark, docs):
    with cores(spark, 1):
        out = near_dedup(docs)
    with cores(spark, FILES):
        assert sorted(r.doc_id for r in out.collect()) == list(range(0, 48, 2))


def test_suffix(spark, docs):
    with cores(spark, 1):
        out = suffix_dedup(docs, length=100)
    with cores(spark, FILES):
        assert all(r.n_removed == r.n_bytes for r in out.collect())
