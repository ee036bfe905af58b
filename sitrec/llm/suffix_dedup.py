"""Removal of long repeated byte strings by hash-compared suffix sorting.

Every window of ``LENGTH`` bytes names an anchor: of the ``GRAM``-byte strings in it the one with the least
hash, the first of equal ones.  Equal windows have their anchor at the same place, so a window can only equal
windows whose anchors' strings are equal.  Consecutive windows with one anchor form a segment.

1.  Each document gives its anchors with a digest of the segment; texts stay where they are.
2.  Anchors are counted.  Where all segments of an anchor are equal, all their windows are repeated.
3.  Of anchors with several different segments, one copy of each is fetched.  Around the anchors, the texts to the
    right and, backwards, to the left are sorted as suffixes; two suffixes are compared by a binary search for
    the length at which their polynomial hashes part.  The common lengths of neighbours, checked byte by byte,
    tell which windows are equal.
4.  What is repeated in a segment holds for all its copies; documents lose the union.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitrec.llm.columns import numbered, quoted, text_or_empty
from sitrec.llm.joins import with_group
from sitrec.llm.word_tokens import byte_slices, gathered, text_array
from sitrec.storage import written

LENGTH = 400
GRAM = 64
STARTS = 1 << 20  # window starts that are hashed at a time
CHUNK = 4 << 20  # bytes of segments that are sorted together; an anchor's segments stay together
MANY = 20_000  # different segments of an anchor beyond which its windows are counted in a shuffle instead
ANCHOR = "_row long, at long, left int, size int, anchor long, high long, low long"


class Hasher:
    """Polynomial hashes modulo 2^64 of the substrings of one array, from sums over its prefixes."""

    def __init__(self, seed: int, most: int):
        rng = np.random.default_rng(seed)
        self.codes = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(1 << 40, 1 << 62)) * 2 + 1
        self.powers = self._powers(base, most)
        self.inverse = self._powers(pow(base, -1, 1 << 64), most + 1)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(max(n, 1), base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.codes[data] * self.powers[: len(data)], out=sums[1:])
        return sums

    def of(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[begin]) * self.inverse[begin]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive keys, from running minima of blocks in both directions."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, ends: np.ndarray, hasher: Hasher, length: int, gram: int):
    """Segments of texts that lie one after the other: text, anchor, first and last window start, anchor hash."""
    width = length - gram + 1
    found: list[tuple[np.ndarray, ...]] = []
    for begin in range(0, len(data) - length + 1, STARTS):
        part = data[begin : begin + STARTS + length - 1]
        sums = hasher.prefixes(part)
        at = np.arange(len(part) - gram + 1)
        grams = _mixed(hasher.of(sums, at, at + gram))
        # 40 bits of the hash decide, then the place
        least = _sliding_least((grams & ~np.uint64(0xFFFFFF)) | at.astype(np.uint64), width)
        place = (least & np.uint64(0xFFFFFF)).astype(np.int64)
        start = np.arange(len(place)) + begin
        text = np.searchsorted(ends, start, side="right")
        whole = start + length <= ends[text]
        start, place, text = start[whole], place[whole], text[whole]
        if not len(start):
            continue
        new = np.flatnonzero((np.diff(place) != 0) | (np.diff(text) != 0)) + 1
        first = np.concatenate([[0], new])
        last = np.concatenate([new - 1, [len(start) - 1]])
        rows = (text[first], place[first] + begin, start[first], start[last], grams[place[first]])
        if found and found[-1][1][-1] == rows[1][0] and found[-1][0][-1] == rows[0][0]:  # goes on in this block
            found[-1][3][-1] = rows[3][0]
            rows = tuple(r[1:] for r in rows)
        if len(rows[0]):
            found.append(rows)
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(4)) + (np.empty(0, np.uint64),)
    return tuple(np.concatenate(x) for x in zip(*found))


def _raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, one after the other, and where each ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


def _anchor_rows(length: int, gram: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(0, STARTS + length)
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for begin, part in byte_slices(text_array(batch.column(1)), STARTS):
                data, ends = _raw(part)
                text, anchor, first, last, grams = anchors(data, ends, hasher, length, gram)
                view = memoryview(data)
                digests = b"".join(
                    hashlib.blake2b(view[a : b + length], digest_size=16).digest() for a, b in zip(first.tolist(), last.tolist())
                )
                pair = np.frombuffer(digests, "<i8").reshape(-1, 2)
                origin = np.concatenate([[0], ends])[text]
                columns = [
                    rows[begin + text], first - origin, (anchor - first).astype(np.int32),
                    (last - first + length).astype(np.int32), grams.view(np.int64), pair[:, 0], pair[:, 1],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=names)

    names = [c.split(" ")[0] for c in ANCHOR.split(", ")]
    return find


class Contexts:
    """Texts on both sides of anchors, sorted as suffixes by comparing hashes."""

    def __init__(self, data: np.ndarray, anchor: np.ndarray, reach: np.ndarray, sign: int, hasher: Hasher):
        self.data, self.anchor, self.reach, self.sign = data, anchor, reach, sign
        self.hasher, self.sums = hasher, hasher.prefixes(data)

    def _equal(self, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
        a, b = self.anchor[x], self.anchor[y]
        if self.sign > 0:
            return self.hasher.of(self.sums, a, a + n) == self.hasher.of(self.sums, b, b + n)
        return self.hasher.of(self.sums, a - n, a) == self.hasher.of(self.sums, b - n, b)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Common length of suffixes, by binary search."""
        low, high = np.zeros(len(x), np.int64), np.minimum(self.reach[x], self.reach[y])
        while True:
            open_ = low < high
            if not open_.any():
                return low
            middle = (low + high + 1) >> 1
            same = self._equal(x, y, middle)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)

    def less(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether suffix x stands before suffix y; the end of a text is before any byte, then numbers decide."""
        n = self.common(x, y)
        last = len(self.data) - 1

        def byte(i: np.ndarray) -> np.ndarray:
            at = self.anchor[i] + n if self.sign > 0 else self.anchor[i] - 1 - n
            return np.where(n < self.reach[i], self.data[np.clip(at, 0, last)].astype(np.int64), -1)

        a, b = byte(x), byte(y)
        return (a < b) | ((a == b) & (x < y))

    def order(self, group: np.ndarray) -> np.ndarray:
        """Merge sort of every group (equal numbers stand together); all merges of a level are one step.

        An element's place in a merged run is its place in its own run and the number of the other run's
        elements before it, found by binary search.
        """
        n = len(group)
        begin = np.searchsorted(group, group, side="left")
        end = np.searchsorted(group, group, side="right")
        order, place = np.arange(n), np.arange(n)
        width = 1
        while n and width < int((end - begin).max()):
            local = place - begin
            run = local // width
            other = begin + (run ^ 1) * width
            low = np.minimum(other, end)
            high = np.minimum(other + width, end)
            start = low.copy()
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) >> 1
                before = self.less(order[middle], order[place[open_]])
                low[open_] = np.where(before, middle + 1, low[open_])
                high[open_] = np.where(before, high[open_], middle)
            merged = begin + (run >> 1) * 2 * width + local % width + (low - start)
            new = np.empty_like(order)
            new[merged] = order[place]
            order = new
            width *= 2
        return order

    def neighbours(self, order: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Common length with the suffix before, in order; -1 at the first of a group."""
        x, y = order[:-1], order[1:]
        n = self.common(x, y)
        if not self._verified(x, y, n):
            raise ArithmeticError("two different strings have one hash")
        return np.concatenate([[-1], np.where(group[x] == group[y], n, -1)])

    def _verified(self, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> bool:
        for at in range(0, len(x), 4096):
            a, b, size = self.anchor[x[at : at + 4096]], self.anchor[y[at : at + 4096]], n[at : at + 4096]
            if self.sign < 0:
                a, b = a - size, b - size
            every = np.arange(len(size))
            if not np.array_equal(gathered(self.data, a, size, every), gathered(self.data, b, size, every)):
                return False
        return True


def repeated_windows(
    data: np.ndarray, anchor: np.ndarray, left: np.ndarray, right: np.ndarray, group: np.ndarray, length: int, seed: int = 1
) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest distance from a repeated window's start to its anchor; -1 where no window is repeated.

    Two windows that start ``o`` bytes before their anchors are equal if the texts after the anchors agree for
    ``length - o`` bytes and those before for ``o``: if no shorter common length of neighbours stands between
    them in either order.  Should verification find two strings with one hash, other hashes are drawn.
    """
    while True:
        hasher = Hasher(seed, len(data) + 1)
        after = Contexts(data, anchor, right, 1, hasher)
        before = Contexts(data, anchor, left, -1, hasher)
        try:
            orders = [c.order(group) for c in (after, before)]
            commons = [c.neighbours(o, group) for c, o in zip((after, before), orders)]
            break
        except ArithmeticError:
            seed += 1
    n = len(anchor)
    most = []
    for order, common in zip(orders, commons):
        best = np.empty(n, np.int64)
        best[order] = np.maximum(common, np.append(common[1:], -1))
        most.append(best)
    least_o, most_o = np.full(n, -1), np.full(n, -1)
    first_o, last_o = np.maximum(length - most[0], 0), np.minimum(most[1], length)
    able = np.flatnonzero(first_o <= last_o)
    if not len(able):
        return least_o, most_o
    classes = [np.empty(n, np.int64), np.empty(n, np.int64)]
    for o in range(int(first_o[able].min()), int(last_o[able].max()) + 1):
        here = able[(first_o[able] <= o) & (o <= last_o[able])]
        if len(here) < 2:
            continue
        for number, order, common, depth in zip(classes, orders, commons, (length - o, o)):
            number[order] = np.cumsum(common < depth)
        _, inverse, counts = np.unique(classes[0][here] * n + classes[1][here], return_inverse=True, return_counts=True)
        same = here[counts[inverse] > 1]
        least_o[same] = np.where(least_o[same] < 0, o, least_o[same])
        most_o[same] = o
    return least_o, most_o


def _segments_of(rows: DataFrame, kind: str) -> DataFrame:
    """Cut the listed segments out of their documents: ``wanted`` lists them for each ``text``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            wanted = batch.column(1)
            for i in range(len(texts)):
                text = memoryview(texts[i].as_buffer())
                listed = wanted[i].values
                at, size = (listed.field(k).to_pylist() for k in ("at", "size"))
                for b in range(0, len(at), 4096):
                    some = listed.slice(b, 4096)
                    cuts = [bytes(text[a : a + n]) for a, n in zip(at[b : b + 4096], size[b : b + 4096])]
                    keys = [some.field(k) for k in ("anchor", "high", "low", "left")]
                    yield pa.RecordBatch.from_arrays([*keys, pa.array(cuts, pa.binary())], names=names)

    names = ["anchor", "high", "low", "left", "bytes"]
    return rows.mapInArrow(cut, kind)


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Tables of about ``most`` bytes whose rows, sorted by anchor, never divide an anchor."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size < most:
            continue
        table = pa.Table.from_batches(held)
        key = table["anchor"].to_numpy()
        edges = np.flatnonzero(np.diff(key))
        if not len(edges):
            held = table.combine_chunks().to_batches()
            continue
        cut = int(edges[-1]) + 1
        yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
        size = sum(b.nbytes for b in held)
    if held:
        yield pa.Table.from_batches(held)


def _sorted_groups(length: int):
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(batches, CHUNK):
            texts = table["bytes"].combine_chunks()
            texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
            data, ends = _raw(texts)
            starts = np.concatenate([[0], ends[:-1]])
            left = table["left"].to_numpy().astype(np.int64)
            anchor = starts + left
            least, most = repeated_windows(data, anchor, left, ends - anchor, table["anchor"].to_numpy(), length)
            keep = np.flatnonzero(least >= 0)
            columns = [table[k].to_numpy()[keep] for k in ("anchor", "high", "low")]
            columns += [least[keep].astype(np.int32), most[keep].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    names = ["anchor", "high", "low", "least", "most"]
    return solve


def _counted_windows(segments: DataFrame, length: int) -> DataFrame:
    """The same result as ``_sorted_groups`` for anchors with very many segments: equal windows are counted.

    Sums are formed before the shuffle, so that it does not matter how many segments share an anchor.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                anchor, high, low, left = (batch.column(k)[i].as_py() for k in range(4))
                text = memoryview(batch.column(4)[i].as_buffer())
                o = np.arange(left, left - (len(text) - length) - 1, -1, dtype=np.int32)
                digests = (hashlib.blake2b(text[b : b + length], digest_size=16).digest() for b in range(len(o)))
                pair = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                same = [pa.array(np.full(len(o), v, np.int64)) for v in (anchor, high, low)]
                window = [pa.array(np.ascontiguousarray(pair[:, k])) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(o), *window], names=names)

    names = ["anchor", "high", "low", "o", "w0", "w1"]
    rows = written(segments.mapInArrow(windows, "anchor long, high long, low long, o int, w0 long, w1 long"), "windows")
    keys = ["anchor", "o", "w0", "w1"]
    same = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    hits = with_group(rows, same, keys, "n", rows.count())
    return hits.groupBy("anchor", "high", "low").agg(F.min("o").alias("least"), F.max("o").alias("most"))


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, many: int = MANY) -> DataFrame:
    """``_row, begin, end`` of strings to remove, from ``_row, text``; a document's spans may overlap."""
    found = written(texts.mapInArrow(_anchor_rows(length, gram), ANCHOR), "anchors")
    counts = found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("high").alias("a"), F.max("high").alias("b"))
    counts = written(counts.where("n > 1"), "repeated")
    repeated = written(with_group(found, counts, ["anchor"], "n", found.count()), "repeated")
    whole = repeated.where("a = b").select("_row", F.col("at").alias("begin"), (F.col("at") + F.col("size")).alias("end"))

    # anchors with several segments: one copy of each, from the first document that has it
    mixed = repeated.where("a <> b")
    key = ["anchor", "high", "low"]
    place = F.struct("_row", "at", "left", "size")
    kinds = written(mixed.groupBy(*key).agg(F.min(place).alias("place"), F.count("*").alias("copies")), "segments")
    wanted = kinds.select("place._row", F.struct(*key, "place.left", "place.at", "place.size").alias("segment"))
    wanted = wanted.groupBy("_row").agg(F.collect_list("segment").alias("wanted"))
    held = texts.join(wanted.hint("merge"), "_row").select("text", "wanted")
    segments = _segments_of(held, "anchor long, high long, low long, left int, bytes binary")
    crowded = [r.anchor for r in kinds.groupBy("anchor").count().where(F.col("count") > many).select("anchor").collect()]
    solved = "anchor long, high long, low long, least int, most int"
    if crowded:  # fewer than one for every ``many`` segments
        segments = written(segments, "segments")
        is_crowded = F.broadcast(kinds.sparkSession.createDataFrame([(a,) for a in crowded], "anchor long"))
        counted = _counted_windows(segments.join(is_crowded, "anchor", "left_semi"), length)
        segments = segments.join(is_crowded, "anchor", "left_anti")
    dealt = segments.repartition("anchor").sortWithinPartitions("anchor")
    partial = dealt.mapInArrow(_sorted_groups(length), solved)
    if crowded:
        partial = partial.unionByName(counted)
    # all windows of a segment with copies are repeated; of another those found above
    facts = kinds.join(written(partial, "solved").hint("merge"), key, "left")
    copied = F.col("copies") > 1
    facts = written(
        facts.where(copied | F.col("most").isNotNull()).select(
            *key,
            "copies",
            F.when(copied, 0).otherwise(F.col("place.left") - F.col("most")).alias("from"),
            F.when(copied, F.col("place.size")).otherwise(F.col("place.left") - F.col("least") + length).alias("to"),
        ),
        "facts",
    )
    part = with_group(mixed.select("_row", "at", *key), facts, key, "copies", mixed.count())
    return whole.unionByName(part.select("_row", (F.col("at") + F.col("from")).alias("begin"), (F.col("at") + F.col("to")).alias("end")))


def _cutter():
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, part in byte_slices(text_array(batch.column(1))):
                kept, spans, sizes, gone = [], [], [], []
                for i, text in enumerate(part.cast(pa.binary())):
                    raw = memoryview(text.as_buffer())
                    listed = batch.column(2)[begin + i].values
                    pieces, runs, at = [], [], 0
                    if listed is not None and len(listed):
                        b, e = (listed.field(k).to_numpy(zero_copy_only=False) for k in ("begin", "end"))
                        order = np.argsort(b, kind="stable")
                        b, e = b[order], np.maximum.accumulate(e[order])
                        first = np.concatenate([[0], np.flatnonzero(b[1:] > e[:-1]) + 1])
                        last = np.concatenate([first[1:] - 1, [len(b) - 1]])
                        runs = list(zip(b[first].tolist(), e[last].tolist()))
                    for x, y in runs:
                        pieces.append(raw[at:x])
                        at = y
                    pieces.append(raw[at:])
                    kept.append(b"".join(pieces))
                    spans.append([{"begin": x, "end": y} for x, y in runs])
                    sizes.append(len(raw))
                    gone.append(len(raw) - len(kept[-1]))
                columns = [pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(part)), *columns], names=names)

    names = ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
    return cut


def suffix_dedup(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, many: int = MANY, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept`` of every row of ``docs``.

    Every byte that lies in a string of ``length`` bytes which also starts elsewhere, in the same or another text,
    is removed; strings are judged on the input.  ``spans`` are the maximal removed runs, ``kept`` the other
    bytes.  A null text is empty; shorter texts stay whole.  Rows that repeat an id or are equal are texts of
    their own, so equal texts of ``length`` bytes or more lose everything.  Other columns are not carried.  An
    empty table gives no rows.
    """
    kind = docs.select(quoted(doc_id)).schema[0].dataType.simpleString()
    whole = text_or_empty(text)
    rows = numbered(docs.select(quoted(doc_id).alias("doc_id"), whole.alias("text")))
    spans = repeated_spans(rows.select("_row", "text"), length, gram, many)
    by_row = written(spans.groupBy("_row").agg(F.collect_list(F.struct("begin", "end")).alias("spans")), "spans")
    joined = rows.join(by_row.hint("merge"), "_row", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(
        _cutter(), f"doc_id {kind}, n_bytes long, n_removed long, spans array<struct<begin:long,end:long>>, kept binary"
    )
