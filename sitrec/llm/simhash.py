"""SimHash near-duplicates through one-wildcard variants of segments."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrec.llm.columns import numbered, quoted, repeatable, text_or_empty, without
from sitrec.llm.components import connected_components
from sitrec.llm.joins import with_group
from sitrec.llm.word_tokens import byte_slices, text_array
from sitrec.storage import written

BITS = 64
SEED = 42
BLOCK = 1 << 20  # bytes of a text whose words are held at a time
ADDED = ("fingerprint", "component_id", "kept")


def _word_blocks(text: bytes, shingle: int) -> Iterator[list[bytes]]:
    """Words of a text in lists that overlap by one shingle less a word; words are divided by ASCII white space."""
    if len(text) <= BLOCK:
        yield text.split()
        return
    edge, begin, kept = re.compile(rb"[\x20\x09-\x0D]"), 0, []
    while begin < len(text):
        found = edge.search(text, begin + BLOCK)
        end = found.start() if found else len(text)
        words = kept + text[begin:end].split()
        begin = end
        if len(words) >= shingle or not found:
            yield words
            kept = words[len(words) - shingle + 1 :] if found and shingle > 1 else []
        else:
            kept = words


def _hashes(words: list[bytes], shingle: int, seed: int) -> np.ndarray:
    from xxhash import xxh64_intdigest

    if not words:
        return np.empty(0, ">u8")
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    lasts = ends[min(shingle, len(words)) - 1 :]
    pairs = zip(starts[:n].tolist(), lasts.tolist())
    return np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in pairs), ">u8", n)


def fingerprint(text: bytes, shingle: int = 4, words: int = 1) -> tuple[list[int], int]:
    """Bits that more than half of the shingles' hashes have, 64 for each seed, and the number of shingles.

    A-Z are taken in lower case.
    """
    counts, total = np.zeros((words, BITS), np.int64), 0
    for block in _word_blocks(text.lower(), shingle):
        if total and len(block) < shingle:
            continue  # all of them belong to shingles counted before
        for k in range(words):
            hashes = _hashes(block, shingle, SEED + k)
            for at in range(0, len(hashes), 1 << 16):
                some = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
                counts[k] += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.int64)
        total += len(hashes)
    bits = np.packbits(2 * counts > total, axis=1)
    return [int.from_bytes(row.tobytes(), "big") for row in bits], total


def fingerprints(docs: DataFrame, shingle: int, words: int, text: str, keys: dict[str, Column]) -> DataFrame:
    """The columns ``keys``, ``f0, f1, ...`` with 64 bits each as signed longs, and ``shingles``, of every row."""
    table = docs.select(*(c.alias(k) for k, c in keys.items()), text_or_empty(text).alias("_text"))
    names = [*keys, *_parts(words), "shingles"]
    schema = table.drop("_text").schema
    for name in names[len(keys) :]:
        schema = schema.add(name, "long")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_array(batch.column(batch.num_columns - 1))
            marks = np.empty((words + 1, len(texts)), np.uint64)
            for begin, part in byte_slices(texts):
                for i, t in enumerate(part.cast(pa.binary()).to_pylist()):
                    marks[:words, begin + i], marks[words, begin + i] = fingerprint(t, shingle, words)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(m.view(np.int64)) for m in marks)], names=names)

    return table.mapInArrow(mark, schema)


def _parts(words: int) -> list[str]:
    return [f"f{k}" for k in range(words)]


def segments(distance: int, bits: int = BITS) -> list[tuple[int, int]]:
    """(first bit, width) of the fewest segments one of which differs by one bit at most."""
    n = distance // 2 + 1
    edges = [bits * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _variants(nodes: DataFrame, distance: int) -> DataFrame:
    """A row for each bit of ``f0``: ``key`` is that bit and its segment without it."""
    keys = []
    for first, width in segments(distance):
        part = F.shiftrightunsigned("f0", first).bitwiseAND(F.lit((1 << width) - 1))
        for bit in range(width):
            keys.append(part.bitwiseAND(F.lit(~(1 << bit))).bitwiseOR(F.lit((first + bit) << 32)))
    return nodes.select("*", F.explode(F.array(*keys)).alias("key"))


def _differ(words: int, a: str, b: str) -> Column:
    counts = [F.bit_count(F.col(f"{a}{k}").bitwiseXOR(F.col(f"{b}{k}"))) for k in range(words)]
    return sum(counts[1:], counts[0])


def _chosen_bit(distance: int) -> Column:
    """Of all variants that the fingerprints ``a0`` and ``b0`` share, the bit of the one their link is written at."""
    differing = F.col("a0").bitwiseXOR(F.col("b0"))
    choice = F.lit(None).cast("int")
    for first, width in reversed(segments(distance)):
        part = F.shiftrightunsigned(differing, first).bitwiseAND(F.lit((1 << width) - 1))
        # no bit differs: the first variant; one bit: the variant without it, found by counting the bits below
        below = F.bit_count(part - 1) + first
        choice = F.when(part == 0, F.lit(first)).when(F.bit_count(part) == 1, below).otherwise(choice)
    return choice


def linked_classes(nodes: DataFrame, words: int, distance: int, index_distance: int) -> DataFrame:
    """``id, root`` for nodes ``id, f0, f1, ...``; the root is one of the ids they can be reached from.

    First each variant's members are compared with one of them only, and what that links is one class.  Then
    variants whose members are all of one class are left out, the others are joined with themselves, and only
    pairs of different classes are verified.  A dense group of near copies has become one class by then, so its pairs
    are never formed.  Members are compared in the join, so only links become rows.
    """
    parts = _parts(words)
    variants = _variants(nodes.select("id", *parts), index_distance)
    rest = [F.min_by(f, "f0").alias(f"m{k}") for k, f in enumerate(parts) if k]
    least = variants.groupBy("key").agg(
        F.min("f0").alias("m0"), *rest, F.min_by("id", "f0").alias("m"), F.count("*").alias("n")
    )
    star = variants.join(least.where("n > 1").drop("n").hint("merge"), "key").where(
        (F.col("id") != F.col("m")) & (_differ(words, "f", "m") <= distance)
    )
    star = written(star.select(F.col("m").alias("u"), F.col("id").alias("v")).distinct(), "links")
    first = connected_components(star)
    classed = nodes.select("id", *parts).join(first.select(F.col("node").alias("id"), "root"), "id", "left")
    classed = written(classed.select("id", *parts, F.coalesce("root", "id").alias("root")), "classes")

    variants = _variants(classed.drop("id"), index_distance)
    held = variants.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("n"))
    of_one_class = held.where("a = b and n > 1").select("key")
    members = variants.join(of_one_class.hint("merge"), "key", "left_anti")

    def side(name: str) -> DataFrame:
        columns = [F.col(f).alias(f"{name}{k}") for k, f in enumerate(parts)]
        return members.select("key", *columns, F.col("root").alias(f"r{name}"))

    bit = F.shiftright("key", 32)
    crossing = (
        side("a")
        .hint("merge")
        .join(side("b"), "key")
        .where("ra < rb")
        .where((_differ(words, "a", "b") <= distance) & (bit == _chosen_bit(index_distance)))
    )
    links = written(crossing.select(F.col("ra").alias("u"), F.col("rb").alias("v")).distinct(), "links")
    second = connected_components(links)
    joined = classed.join(second.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    return joined.select("id", F.coalesce("top", "root").alias("root"))


def near_classes(
    docs: DataFrame,
    distance: int = 4,
    shingle: int = 4,
    words: int = 1,
    index_distance: int | None = None,
    least_shingles: int = 0,
    text: str = "text",
    doc_id: str = "doc_id",
    row: Column | None = None,
) -> DataFrame:
    """``doc_id, fingerprint, component_id, kept`` and ``_row`` for every row of ``docs``.

    A fingerprint has 64 bits for each of ``words`` seeds, made of the XXH64 hashes of all shingles of
    ``shingle`` words, repeats included; a shorter text is one shingle, one without words has the fingerprint 0.
    Fingerprints with at most ``distance`` differing bits are linked, and documents reach each other through links.
    All links are found if at most ``index_distance`` of the first 64 bits differ (by default ``distance``); of
    others those that agree in a segment but for one bit.  Texts of fewer than ``least_shingles`` shingles are
    only linked to those with the same fingerprint, as few shingles make unlike texts alike.
    ``component_id`` is the smallest id a document reaches; null ids are ignored, and it is null if there
    are no others.  Exactly one row of each component is ``kept``: of the rows with the smallest id (null
    ids last) the first in the order of the input, ``_row``.  A null text is an empty one.  Rows that repeat
    an id are separate rows.  An empty table gives no rows.

    ``_row`` is numbered in the one scan of ``docs`` unless ``row`` gives it.

    Texts do not move.  Copies are summed up to one node first; only distinct fingerprints are indexed.
    """
    parts = _parts(words)
    keys = {"doc_id": quoted(doc_id), "_row": F.monotonically_increasing_id() if row is None else row}
    rows = written(fingerprints(repeatable(docs), shingle, words, text, keys), "fingerprints")
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "_row"))
    nodes = rows.groupBy(*parts).agg(
        smallest.alias("first"), F.count("*").alias("n"), F.min("_row").alias("id"), F.max("shingles").alias("shingles")
    )
    nodes = written(nodes, "nodes")
    indexed = nodes.where(F.col("shingles") >= least_shingles)
    classes = written(linked_classes(indexed, words, distance, distance if index_distance is None else index_distance), "classes")
    named = nodes.join(classes, "id", "left").withColumn("root", F.coalesce("root", "id"))
    tops = named.groupBy("root").agg(F.min("first").alias("top"))
    named = named.join(tops, "root").select(
        *parts, "n", F.col("top.id").alias("component_id"), F.col("top._row").alias("_top")
    )
    out = with_group(rows, written(named, "components"), parts, "n", rows.count())
    hexed = F.concat(*(F.lpad(F.lower(F.hex(f)), 16, "0") for f in parts)).alias("fingerprint")
    return out.select("doc_id", hexed, "component_id", (F.col("_row") == F.col("_top")).alias("kept"), "_row")


def row_classes(
    docs: DataFrame, distance: int = 4, shingle: int = 4, words: int = 1, text: str = "text", row: str = "_row"
) -> DataFrame:
    """``_row, alike`` of the rows whose fingerprint (see ``near_classes``) is linked with that of another row.

    ``alike`` numbers the class of fingerprints.
    """
    parts = _parts(words)
    rows = written(fingerprints(docs, shingle, words, text, {"_row": quoted(row)}), "fingerprints")
    nodes = rows.groupBy(*parts).agg(F.min("_row").alias("id"), F.count("*").alias("n"))
    nodes = written(nodes, "nodes")
    classes = written(linked_classes(nodes, words, distance, distance), "classes")
    named = nodes.join(classes.hint("merge"), "id")
    many = named.groupBy("root").agg(F.sum("n").alias("rows")).where("rows > 1").select("root")
    named = named.join(many.hint("merge"), "root").select(*parts, "n", F.col("root").alias("alike"))
    return with_group(rows, written(named, "alike"), parts, "n", rows.count()).select("_row", "alike")


def near_dedup(docs: DataFrame, **how) -> DataFrame:
    """Rows of ``docs`` that ``near_classes`` keeps, with all their columns but for clashing ones (``_row``)."""
    clean = without(docs, ["_row"])
    columns = [quoted(c) for c in clean.columns]
    rows = numbered(clean)
    kept = written(near_classes(rows, row=F.col("_row"), **how).where("kept").select("_row"), "kept")
    return rows.join(kept, "_row", "left_semi").select(*columns)
