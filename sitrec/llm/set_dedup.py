"""Near copies by the Jaccard similarity of their shingles, through SetSketch registers; every link is verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitrec.llm.columns import quoted, text_or_empty
from sitrec.llm.components import connected_components, gathered
from sitrec.llm.exact_dedup import filter_bits
from sitrec.llm.joins import frequent, maybe_among, share, spread, spread_join
from sitrec.llm.set_sketch import SLICE, band_keys, bits, can_be, digests, most_differing, registers, shingle_sets
from sitrec.llm.word_tokens import byte_slices, text_array, trimmed
from sitrec.storage import new_path, remove, written


RARE = 64  # nodes; shingles that so few have name the pairs that they make


class Rule:
    """Which sets are linked, and the sketch that finds them.

    Sets are linked if 100 common members make ``percent`` of the union or more.  A pair just that similar
    misses all ``bands`` of ``rows`` registers with the probability (1 - similarity ** rows) ** bands.
    """

    def __init__(self, shingle: int, percent: int, rows: int, bands: int):
        self.shingle, self.percent, self.rows, self.bands = shingle, percent, rows, bands
        self.n = rows * bands
        self.words = self.n // 64
        self.differing = most_differing(percent / 100, 64 * self.words)
        if not self.words:
            raise ValueError("64 registers are the least")

    def fits(self, a: str, b: str) -> Column:
        """Whether sets of these sizes can be similar enough."""
        return F.least(a, b) * 100 >= F.greatest(a, b) * self.percent

    def prefix(self, size: str) -> Column:
        """So many members of a set of this size, the first in an order of all members, hold one of every linked set."""
        return F.floor(F.col(size) * (100 - self.percent) / 100) + 1

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        common = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * common >= self.percent * (len(a) + len(b) - common)


class Scratch:
    """Tables that are needed until the classes are known; ``rows`` has how many rows get one."""

    def __init__(self, spark: SparkSession, rows: int = 0):
        self.spark, self.tables, self.rows = spark, [], rows

    def narrow(self, df: DataFrame, name: str) -> DataFrame:
        """``written`` for rows of a few numbers: a small table is not a file for every shuffle partition."""
        return self.written(df.coalesce(gathered(self.rows)), name)

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(self.spark, name)
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.tables.append((path, table))
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Remove these tables, all if none is named."""
        gone = [(path, t) for path, t in self.tables if not tables or any(t is x for x in tables)]
        for path, _ in gone:
            remove(self.spark, path)
        self.tables = [x for x in self.tables if not any(x[1] is t for _, t in gone)]


def text_keys(text: Column) -> list[Column]:
    """128 bits by which a text is found again."""
    return [F.xxhash64(text).alias("t0"), F.xxhash64(text, F.lit(1)).alias("t1")]


def sketches(rows: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id, _row, t0, t1``, digest and size of the set of shingles, its registers and their bits, of ``doc_id, _row, text``."""
    table = rows.select("doc_id", "_row", *text_keys(F.col("text")), "text")
    bit_names = [f"b{k}" for k in range(rule.words)]
    schema = T.StructType(list(table.drop("text").schema))
    for name in ("d0", "d1", "size", *bit_names):
        schema = schema.add(name, "long")
    schema = schema.add("registers", "binary")
    names = schema.names

    @trimmed
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, part in byte_slices(text_array(batch.column(4)), SLICE):
                values, first = shingle_sets(part, rule.shingle)
                regs = registers(values, first, rule.n)
                marks = [d.view(np.int64) for d in digests(values, first)] + [np.diff(first)]
                marks += list(np.ascontiguousarray(bits(regs).view(np.int64).T))
                raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * rule.n), len(part), [None, pa.py_buffer(regs.tobytes())])
                own = batch.slice(begin, len(part))
                columns = [*own.columns[:4], *(pa.array(m) for m in marks), raw.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return table.mapInArrow(sketch, schema)


def _entries(nodes: DataFrame, rule: Rule) -> DataFrame:
    """A row ``key, id, size, b0, ...`` for every band of every node."""
    kept = ["id", "size", *(f"b{k}" for k in range(rule.words))]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                some = batch.slice(at, 4096)
                regs = np.frombuffer(b"".join(some.column(len(kept)).to_pylist()), np.uint16).reshape(-1, rule.n)
                keys = band_keys(regs, rule.rows).view(np.int64)
                rows = pa.array(np.repeat(np.arange(len(regs)), keys.shape[1]))
                columns = [some.column(i).take(rows) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), *columns], names=["key", *kept])

    schema = "key long, " + ", ".join(f"{c} long" for c in kept)
    return nodes.select(*kept, "registers").mapInArrow(cut, schema)


def _alike(rule: Rule, a: str, b: str) -> Column:
    """Few enough differing bits."""
    counts = [F.bit_count(F.col(f"{a}{k}").bitwiseXOR(F.col(f"{b}{k}"))) for k in range(rule.words)]
    return sum(counts[1:], counts[0]) <= rule.differing


def _frequent_sides(pairs: DataFrame, scratch: Scratch) -> dict[str, tuple[DataFrame | None, int]]:
    """``frequent`` of the columns ``u`` and ``v``, both counted in one pass and kept."""
    ends = [pairs.select(F.lit(side).alias("side"), F.col(side).alias("id")) for side in ("u", "v")]
    counts = ends[0].unionByName(ends[1]).groupBy("side", "id").agg(F.count("*").alias("_n"))
    limit = share(pairs.count())
    large = scratch.narrow(counts.where(F.col("_n") > limit), "frequent")
    found = {r["side"] for r in large.select("side").distinct().collect()}
    return {s: (large.where(F.col("side") == s).select(F.col("id").alias(s), "_n") if s in found else None, limit) for s in ("u", "v")}


def _paired(pairs: DataFrame, facts: DataFrame, columns: list[str], hot: dict[str, tuple[DataFrame | None, int]]) -> DataFrame:
    """The written ``pairs`` with the ``columns`` of ``facts`` for ``u`` and for ``v``, ending in ``_u`` and ``_v``."""
    out = pairs
    for side in ("u", "v"):
        named = facts.select(F.col("id").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns))
        out = spread(out, named, hot[side], [side], by=["u", "v"])
    return out


def verified(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, rule: Rule, scratch: Scratch) -> DataFrame:
    """The ``pairs`` ``u, v`` that are linked: joint likelihood of their registers first, then their whole sets."""

    @trimmed
    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                some = batch.slice(at, 4096)
                sizes = [some.column(c).to_numpy() for c in ("size_u", "size_v")]
                regs = [
                    np.frombuffer(b"".join(some.column(c).to_pylist()), np.uint16).reshape(-1, rule.n)
                    for c in ("registers_u", "registers_v")
                ]
                yield some.select(["u", "v"]).filter(pa.array(can_be(*regs, *sizes, rule.percent / 100)))

    @trimmed
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = [
                rule.linked(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64))
                for a, b in zip(batch.column("hashes_u"), batch.column("hashes_v"))
            ]
            yield batch.select(["u", "v"]).filter(pa.array(linked, pa.bool_()))

    pairs = scratch.narrow(pairs.select("u", "v"), "pairs")
    hot = _frequent_sides(pairs, scratch)  # of the pairs that are left, no key has more
    sketched = _paired(pairs, nodes, ["size", "registers"], hot)
    pairs = scratch.narrow(sketched.mapInArrow(likely, "u long, v long"), "likely")
    both = _paired(pairs, sets, ["hashes"], hot)
    return scratch.narrow(both.mapInArrow(compare, "u long, v long"), "links")


def _sets(rows: DataFrame, wanted: DataFrame, rule: Rule, total: int, scratch: Scratch) -> DataFrame:
    """``id, hashes`` of the ``wanted`` nodes (``id, t0, t1``); of texts only theirs move, copies once a task."""
    asked = rows.select("text", *text_keys(F.col("text")))
    asked = maybe_among(asked, F.col("t0"), wanted.select("t0"), filter_bits(total)).where("_maybe")
    asked = asked.dropDuplicates(["t0", "t1"]).join(wanted.hint("merge"), ["t0", "t1"]).select("id", "text")

    @trimmed
    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, part in byte_slices(text_array(batch.column(1)), SLICE):
                values, first = shingle_sets(part, rule.shingle)
                raw = [values[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(part)), pa.array(raw, pa.binary())], names=["id", "hashes"])

    return scratch.written(asked.mapInArrow(to_sets, "id long, hashes binary"), "sets")


def _rare_shingles(members: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """``id, shingle, n`` for the shingles of ``members`` (``id``) that ``RARE`` of them have or fewer."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                hashes = np.frombuffer(batch.column(1)[i].as_buffer(), np.int64)
                for at in range(0, len(hashes), 1 << 16):
                    some = hashes[at : at + (1 << 16)]
                    number = pa.array(np.full(len(some), batch.column(0)[i].as_py(), np.int64))
                    yield pa.RecordBatch.from_arrays([number, pa.array(some)], names=["id", "shingle"])

    held = sets.join(members.hint("merge"), "id", "left_semi").select("id", "hashes")
    rows = scratch.written(held.mapInArrow(listed, "id long, shingle long"), "shingles")
    rare = rows.groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") <= RARE)
    return scratch.written(spread_join(rows, scratch.written(rare, "rare"), ["shingle"]), "rare")


def _labelled(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """``id, root`` of all nodes; one that is linked with nothing is its own root."""
    named = nodes.select("id").join(classes.select(F.col("node").alias("id"), "root").hint("merge"), "id", "left")
    return named.select("id", F.coalesce("root", "id").alias("root"))


def _classes(
    nodes: DataFrame, rows: DataFrame, rule: Rule, total: int, scratch: Scratch, proposed: DataFrame | None = None
) -> DataFrame:
    """``id, root`` of the nodes that are linked with others.

    The ``proposed`` pairs ``u, v`` of another method are verified first, with the first pairs of bands.  Nodes that share a band meet as ``shared`` rows.  The centre of a band is the node that meets most others in all
    its bands.  Every node is compared with the centres of its bands: with the one it shares most bands with, then
    with those that are still of another class.  What remains are
    bands with several classes; only there nodes are joined with each other, across classes.  Two such nodes either
    have a rare shingle in common, of which no node makes more than ``RARE`` pairs, or nothing but other shingles,
    which have to be enough.  In order of rarity the first common shingle of linked nodes is among the first of both
    (``Rule.prefix``), so of the rare ones only these are joined.  Joins compare this, sizes and bits, so pairs that
    cannot be linked hardly become rows.
    """
    parts = [f"b{k}" for k in range(rule.words)]
    entries = scratch.written(_entries(nodes, rule), "bands")
    counts = scratch.written(entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "repeated")
    # bands that no other node has hardly move
    moved = maybe_among(entries, F.col("key"), counts.select("key"), filter_bits(counts.count())).where("_maybe").drop("_maybe")
    most = share(entries.count())
    met = scratch.written(spread(moved, counts, (counts.where(F.col("n") > most).withColumnRenamed("n", "_n"), most), ["key"]), "shared")
    scratch.drop(entries, counts)
    popular = met.groupBy("id").agg(F.sum("n").alias("popular"))
    shared = scratch.written(met.drop("n").join(popular.hint("merge"), "id"), "shared")
    scratch.drop(met)
    centre = F.max_by(F.struct("id", "size", *parts), F.struct("popular", (-F.col("id")).alias("least"))).alias("m")
    centres = shared.groupBy("key").agg(centre).select("key", "m.*").toDF("key", "m", "msize", *(f"m{k}" for k in range(rule.words)))
    star = spread_join(shared, scratch.written(centres, "centres"), ["key"])
    star = star.where("id <> m").where(rule.fits("size", "msize") & _alike(rule, "b", "m"))
    star = star.groupBy(F.col("m").alias("u"), F.col("id").alias("v")).agg(F.count("*").alias("n"))
    first = F.row_number().over(Window.partitionBy("v").orderBy(F.col("n").desc(), "u"))
    nearest = F.max(F.when(F.col("first") == 1, F.col("u"))).over(Window.partitionBy("v")).alias("near")
    star = scratch.narrow(star.withColumn("first", first).select("u", "v", nearest), "star")

    asked = shared.select("id")
    if proposed is not None:
        asked = asked.unionByName(proposed.select(F.explode(F.array("u", "v")).alias("id")))
    wanted = asked.distinct().join(nodes.select("id", "t0", "t1").hint("merge"), "id")
    sets = _sets(rows, scratch.narrow(wanted, "wanted"), rule, total, scratch)
    best = star.where("u = near").select("u", "v")
    if proposed is not None:
        best = best.unionByName(proposed.select("u", "v")).distinct()
    links = verified(best, nodes, sets, rule, scratch)
    first = scratch.narrow(connected_components(links), "classes")

    # a node linked with its nearest centre is of that one's class, so its other centres are compared as pairs of centres
    others = star.where("u <> near")
    known = first.select(F.col("node").alias("id"), "root")
    far = scratch.narrow(others.select("u", "near").distinct(), "centres")
    for c in ("u", "near"):
        far = spread_join(far, known.select(F.col("id").alias(c), F.col("root").alias(f"r{c}")), [c], "left")
        far = scratch.narrow(far, "centres")
    far = far.where(F.coalesce("ru", "u") != F.coalesce("rnear", "near")).select("u", "near")
    linked = links.select(F.col("u").alias("near"), "v").hint("merge")
    alone = others.join(linked, ["near", "v"], "left_anti")
    more = spread_join(others, far, ["u", "near"]).select("u", "v").unionByName(alone.select("u", "v")).distinct()
    again = verified(more, nodes, sets, rule, scratch)
    links = scratch.narrow(links.unionByName(again), "links")
    second = scratch.narrow(connected_components(links), "classes")

    roots = _labelled(nodes, second)
    members = spread_join(shared.select("key", "id", "size", *parts), roots, ["id"])
    members = scratch.written(members, "members")
    mixed = members.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("key")
    members = scratch.written(spread_join(members, mixed, ["key"]), "members")
    rare = _rare_shingles(members.select("id").distinct(), sets, scratch)
    few = scratch.narrow(rare.groupBy("id").agg(F.count("*").alias("few")), "few")
    known = members.drop("key").distinct().join(few.hint("merge"), "id", "left")
    known = scratch.written(known.withColumn("other", F.col("size") - F.coalesce("few", F.lit(0))).drop("few"), "known")

    def side(table: DataFrame, name: str, meeting: str) -> DataFrame:
        columns = [F.col(f"b{k}").alias(f"{name}{k}") for k in range(rule.words)]
        more = [F.col(c).alias(f"{c}_{name}") for c in ("size", "other")]
        return table.select(meeting, F.col("id").alias(name), F.col("root").alias(f"r{name}"), *more, *columns)

    def crossing(table: DataFrame, meeting: str, able: Column) -> DataFrame:
        pairs = spread_join(side(table, "u", meeting), side(table, "v", meeting), [meeting])
        pairs = pairs.where("ru < rv").where(rule.fits("size_u", "size_v") & able & _alike(rule, "u", "v"))
        return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))

    common = F.least("other_u", "other_v")
    possible = common * 100 >= (F.col("size_u") + F.col("size_v") - common) * rule.percent
    able = known.where(F.col("other") * 100 >= F.col("size") * rule.percent).select("id", "other")
    banded = scratch.written(members.join(able.hint("merge"), "id"), "members")
    rank = F.row_number().over(Window.partitionBy("id").orderBy("n", "shingle"))
    named = rare.join(known.hint("merge"), "id").withColumn("rank", rank).where(F.col("rank") <= rule.prefix("size"))
    named = scratch.written(named.where("n > 1").drop("n", "rank"), "members")
    crossed = crossing(banded, "key", possible).unionByName(crossing(named, "shingle", F.lit(True))).distinct()
    tested = star.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    last = verified(crossed.join(tested.hint("merge"), ["u", "v"], "left_anti"), nodes, sets, rule, scratch)
    return connected_components(links.unionByName(last))


def _proposed(marks: DataFrame, nodes: DataFrame, alike: DataFrame) -> DataFrame:
    """``u, v``: each node that stands in a class of ``alike``, with the smallest node of that class."""
    sets = ["d0", "d1", "size"]
    of_row = marks.where("size > 0").select("_row", *sets).join(alike.hint("merge"), "_row").drop("_row").distinct()
    members = of_row.join(nodes.select("id", *sets).hint("merge"), sets).select("alike", "id")
    least = members.groupBy("alike").agg(F.min("id").alias("u"))
    pairs = spread_join(members, least, ["alike"])
    return pairs.where("u <> id").select("u", F.col("id").alias("v")).distinct()


def set_classes(rows: DataFrame, rule: Rule, alike: DataFrame | None = None) -> DataFrame:
    """``doc_id, _row, size, root`` of every row of ``doc_id, _row, text``; ``root`` numbers the class of its set.

    ``alike`` (``_row, alike``) are classes that another method proposes: their rows are candidates too, and are linked
    only if their sets are.

    Rows with one set of shingles are one node, and nodes reach each other through links.  Of rows without
    shingles ``root`` is null.
    """
    scratch = Scratch(rows.sparkSession)
    sketched = scratch.written(sketches(rows, rule), "sketches")
    marks = written(sketched.select("doc_id", "_row", "d0", "d1", "size"), "marks")
    sets = sketched.where("size > 0").groupBy("d0", "d1", "size")
    firsts = [F.first(c).alias(c) for c in (*(f"b{k}" for k in range(rule.words)), "registers")]
    one = F.min(F.struct("t0", "t1")).alias("t")
    nodes = sets.agg(one, *firsts).select(F.monotonically_increasing_id().alias("id"), "t.t0", "t.t1", "*").drop("t")
    nodes = written(nodes, "nodes")
    scratch.drop(sketched)  # nodes hold the registers now
    scratch.rows = total = marks.count()
    proposed = None if alike is None else scratch.narrow(_proposed(marks, nodes, alike), "proposed")
    classes = written(_labelled(nodes, _classes(nodes, rows, rule, total, scratch, proposed)), "roots")
    scratch.drop()
    named = nodes.select("id", "d0", "d1", "size").join(classes.hint("merge"), "id").drop("id")
    return spread_join(marks, written(named, "named"), ["d0", "d1", "size"], "left").select("doc_id", "_row", "size", "root")


def near_sets(
    docs: DataFrame,
    shingle: int = 3,
    percent: int = 85,
    rows: int = 6,
    bands: int = 32,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Texts are linked if the common distinct shingles of ``shingle`` words are ``percent`` in a hundred of all
    theirs or more; A-Z count as lower case, a text of fewer words is one shingle.  Candidates share a band of
    registers; at the limit itself a pair in four million shares none, above it fewer (``Rule``).  Bits, sizes
    and the joint likelihood of all registers drop candidates, and whole sets decide.  ``component_id`` is the
    smallest id a document reaches, itself included; null ids are ignored, and it is null if there are no others.
    ``kept`` says whether it is the document's own (null ids: whether there are no others).  Texts without
    words, or null, reach only themselves.  Rows that repeat an id are rows of their own.  Other
    columns do not matter.  An empty table gives no rows.

    Texts move only if they share a band, once; equal sets are one node from the start.
    """
    rule = Rule(shingle, percent, rows, bands)
    plain = docs.select(
        quoted(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("_row"), text_or_empty(text).alias("text")
    )
    found = written(set_classes(plain, rule), "found")
    tops = found.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = spread_join(found, written(tops, "tops"), ["root"], "left")
    component = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
