"""Exact deduplication by two passes over a Bloom filter; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrec.llm.columns import ascii_lower, numbered, quoted, text_or_empty, without
from sitrec.storage import written

ADDED = ("keep_id", "group_size", "kept", "text_sha256")
OWN = ("_bloom", "_row", "_word0", "_word1", "_mask0", "_mask1", "_keep_row", "_maybe")


def filter_bits(rows: int, most: int = 1 << 26) -> int:
    """A power of two with 16 bits a row or more, but never over ``most``.

    ``most`` bounds what is broadcast.  Beyond 4 million rows the filter fills up and more rows
    shuffle than need to; the result is the same.
    """
    return min(most, 1 << max(16, (16 * max(rows, 1) - 1).bit_length()))


def _slots(bits: int) -> list[Column]:
    low = F.col("_bloom").bitwiseAND(bits - 1)
    high = F.shiftrightunsigned("_bloom", 32).bitwiseAND(bits - 1)
    return [low, high]


def _word(slot: Column) -> Column:
    return F.shiftright(slot, 6)


def _bit(slot: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))


def repeated_bits(hashes: DataFrame, bits: int) -> DataFrame:
    """First pass: the filter's bits that two rows or more have set, as (word, mask).

    Rows are counted per bit, with partial sums before the shuffle; one row per used bit moves.
    """
    slots = hashes.select(F.explode(F.array(*_slots(bits))).alias("slot"))
    twice = slots.groupBy("slot").agg(F.count("*").alias("n")).where("n > 1")
    return twice.groupBy(_word(F.col("slot")).alias("word")).agg(F.bit_or(_bit(F.col("slot"))).alias("mask"))


def exact_dedup(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", most_bits: int = 1 << 26, hot_share: float = 1 / 1024
) -> DataFrame:
    """Every row of ``docs`` with ``keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are identical after lower-casing A-Z; a null text equals an empty
    one.  Of equal texts the row with the largest id stays (a null id is smaller than any other).
    Rows that repeat text and id are copies too: the last of them in the order of the input stays.
    The input is written once with a number for each row, which all passes read.
    ``keep_id`` is null only if all ids of a group are.  Columns of ``docs`` that have the name of
    an added column are replaced; all others pass through.  An empty table gives an empty table.

    First pass: bits of a Bloom filter set by two rows or more.  Second pass: rows whose bits are
    all among them are possibly repeated; only these shuffle.  The groups they make are stored.
    At most ``1 / hot_share`` groups hold more than that share of the rows: they are broadcast, so
    that no task gets all copies of a text; the others are joined.  The filter's own key is the text
    in lower case, coarser than equality of texts, so no copy escapes it.
    """
    clean = without(docs, (*ADDED, *OWN))
    columns = [quoted(c) for c in clean.columns]
    clean = numbered(clean)
    whole = text_or_empty(text)
    # the coarse key is much cheaper than the exact one and is all that most rows need
    rows = clean.select(*columns, "_row", F.xxhash64(F.lower(whole)).alias("_bloom"))
    total = clean.count()
    bits = filter_bits(total, most_bits)
    words = F.broadcast(repeated_bits(clean.select(F.xxhash64(F.lower(whole)).alias("_bloom")), bits))

    def hit(df: DataFrame, slot: Column, i: int) -> DataFrame:
        side = words.select(F.col("word").alias(f"_word{i}"), F.col("mask").alias(f"_mask{i}"))
        return df.join(side, _word(slot) == F.col(f"_word{i}"), "left")

    first, second = _slots(bits)
    looked = hit(hit(rows, first, 0), second, 1)
    both = (F.col("_mask0").bitwiseAND(_bit(first)) != 0) & (F.col("_mask1").bitwiseAND(_bit(second)) != 0)
    looked = looked.select(*columns, "_row", F.coalesce(both, F.lit(False)).alias("_maybe"))
    digest = F.sha2(ascii_lower(whole), 256).alias("text_sha256")

    groups = written(
        looked.where("_maybe")
        .select(digest, F.struct(quoted(doc_id).alias("id"), F.col("_row").alias("row")).alias("last"))
        .groupBy("text_sha256")
        .agg(F.max("last").alias("last"), F.count("*").alias("group_size"))
        .where("group_size > 1")
        .select("text_sha256", F.col("last.id").alias("keep_id"), F.col("last.row").alias("_keep_row"), "group_size"),
        "copies",
    )
    is_hot = F.col("group_size") > total * hot_share
    kept = F.col("_row") == F.coalesce("_keep_row", "_row")
    own = F.col("group_size").isNull()
    result = [
        *columns,
        F.when(own, quoted(doc_id)).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        kept.alias("kept"),
        "text_sha256",
    ]
    near = looked.select(*columns, "_row", "_maybe", digest).join(
        F.broadcast(groups.where(is_hot)), "text_sha256", "left"
    )
    straight = near.where(~F.col("_maybe") | F.col("group_size").isNotNull()).select(*result)
    shuffled = (
        near.where(F.col("_maybe") & own)
        .select(*columns, "_row", "text_sha256")
        .join(groups.where(~is_hot).hint("merge"), "text_sha256", "left")
        .select(*result)
    )
    return straight.unionByName(shuffled)
