"""From raw documents to packed training sequences, in five stages.

Each stage reads what the one before has written and works on all of it: language identification, exact
deduplication, near-deduplication, mixing of sources, packing.  All but the last keep the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitrec.llm.exact_dedup import exact_dedup
from sitrec.llm.language import identify, learn
from sitrec.llm.mixing import mix_sources
from sitrec.llm.near_copies import near_copies
from sitrec.llm.packing import pack_documents
from sitrec.storage import written


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = "512"  # rows of whole texts that go to Python together; the default, 10,000, holds tens of MB a task twice


def small_batches(spark: SparkSession) -> None:
    """Smaller batches for the stages that hand whole texts to Python, unless the session says otherwise."""
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, BATCH_ROWS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; null texts, texts without letters and narrow margins go."""
    small_batches(spark)
    return identify(docs, learn(docs)).where("not rejected").select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup(docs).where("kept").select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash classes and bands of registers propose them, five-word shingles
    with a Jaccard similarity of 0.8 or more decide."""
    small_batches(spark)
    return near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that all sources have the same share of the text."""
    return mix_sources(docs).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    small_batches(spark)
    return pack_documents(docs)


STAGES = [
    ("language", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mixing),
    ("packing", packing),
]

#: Compression, fingerprints, tokens and packing cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
