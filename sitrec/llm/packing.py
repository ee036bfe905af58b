"""Packing documents into sequences of bounded length by best-two-fit."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitrec.llm.columns import quoted, text_or_empty
from sitrec.llm.word_tokens import WordEncoder, byte_slices, text_array, tokenizer_path, trimmed
from sitrec.storage import written

SLICE = 2 << 20  # bytes of texts that are encoded at a time
GROUP = 65_536  # pieces that one task packs together; a group leaves at most about one loose sequence


def pieces(
    docs: DataFrame, capacity: int, end_id: int, path: str, text: str, doc_id: str, with_ids: bool = False
) -> DataFrame:
    """One row per piece of a document: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``."""
    kind = docs.select(quoted(doc_id)).schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    @trimmed
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        for batch in batches:
            keys, texts = batch.column(0), text_array(batch.column(1))
            for begin, part in byte_slices(texts, SLICE):
                ids, offsets = encoder.encode(part, end_id)
                ids = ids.astype("<u4", copy=False)
                counts = -(-np.diff(offsets) // capacity)
                rows = np.repeat(np.arange(len(part)), counts)
                number = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = number * capacity
                begins = offsets[rows] + start
                ends = np.minimum(begins + capacity, offsets[rows + 1])
                crc = np.fromiter((zlib.crc32(ids[a:b]) for a, b in zip(begins, ends)), np.int64, len(rows))
                columns = [keys.take(pa.array(rows + begin)), number.astype(np.int32), start, ends - begins, crc]
                if with_ids:  # pieces tile the ids in order
                    columns.append(pa.ListArray.from_arrays(np.append(begins, len(ids)).astype(np.int32), ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    names = [c.split(" ")[0] for c in schema.split(", ")]
    return docs.select(quoted(doc_id).alias("doc_id"), text_or_empty(text).alias("text")).mapInArrow(cut, schema)


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece.

    A bin takes the longest piece left and then, again and again, the longest that fits.  If a gap is left,
    its smallest piece goes back for the two unpacked pieces whose sum fills the gap and its place best, if
    they fill more than it did.  Pieces of equal length are taken in their order.
    """
    order = np.argsort(lengths, kind="stable")
    left = np.bincount(lengths, minlength=capacity + 1)
    begin = np.cumsum(left) - left
    used = np.zeros(capacity + 1, np.int64)
    have = np.flatnonzero(left)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)

    def take(length: int) -> None:
        nonlocal have
        left[length] -= 1
        if not left[length]:
            have = np.delete(have, np.searchsorted(have, length))

    def give_back(length: int) -> None:
        nonlocal have
        if not left[length]:
            have = np.insert(have, np.searchsorted(have, length), length)
        left[length] += 1

    number = 0
    while len(have):
        content, gap = [], capacity
        while len(have) and (at := int(np.searchsorted(have, gap, side="right"))):
            length = int(have[at - 1])
            if not length:  # nothing but empty pieces fits
                content += [0] * int(left[0])
                left[0], have = 0, have[1:]
                break
            content.append(length)
            gap -= length
            take(length)
        if gap and len(content) > 1 and len(have):
            smallest = content[-1]
            room = gap + smallest
            other = np.searchsorted(have, room - have, side="right") - 1
            # the same length twice needs two pieces of it
            other = np.where((other >= 0) & (have[other] == have) & (left[have] < 2), other - 1, other)
            sums = np.where(other >= 0, have + have[other], 0)
            best = int(np.argmax(sums))
            if sums[best] > smallest:
                pair = (int(have[best]), int(have[other[best]]))
                content.pop()
                for length in pair:
                    take(length)
                give_back(smallest)
                content += pair
        place = 0
        for length in content:
            row = order[begin[length] + used[length]]
            used[length] += 1
            bins[row], offsets[row] = number, place
            place += length
        number += 1
    return bins, offsets


def pack_documents(
    docs: DataFrame,
    capacity: int = 4096,
    end_id: int = 1,
    path: str | None = None,
    text: str = "text",
    doc_id: str = "doc_id",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents with the sequence they are packed into.

    ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and, with ``with_ids``, the ids.  A
    document is its token ids and ``end_id``; only longer ones than ``capacity`` are cut, into full pieces
    and a rest.  A null text is empty: one piece of length 1.  Rows that repeat an id or are equal are packed
    one by one; a null id stays null.  Other columns of ``docs`` are not carried.  An empty table gives no rows.

    The pieces are stored, numbered and dealt in turn to groups of about ``GROUP``; a group is packed by
    itself, whoever holds it, so the result does not depend on the number of tasks, and loses about one
    sequence per group against packing all at once.  Texts are not shuffled, and ids only with ``with_ids``.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    table = written(pieces(docs, capacity, end_id, path or tokenizer_path(), text, doc_id, with_ids), "pieces")
    groups = max(1, -(-table.count() // GROUP))
    schema = T.StructType(list(table.schema)).add("sequence_id", "long").add("offset", "long")

    def pack(group: pa.Table) -> pa.Table:
        # rows come in any order after a shuffle; their number makes the packing repeatable
        group = group.sort_by("_number")
        bins, offsets = best_two_fit(group["length"].to_numpy(), capacity)
        first = group["_group"][0].as_py() << 32
        return (
            group.drop_columns(["_number", "_group"])
            .append_column("sequence_id", pa.array(bins + first))
            .append_column("offset", pa.array(offsets))
        )

    numbered = table.withColumn("_number", F.monotonically_increasing_id())
    # the low part of the number counts within a file part, the high part is the part
    dealt = numbered.withColumn("_group", F.pmod(F.col("_number") + F.shiftright("_number", 33), F.lit(groups)))
    return dealt.groupBy("_group").applyInArrow(pack, schema)
