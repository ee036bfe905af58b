"""Whitening of embeddings: exact sums on Spark, spectral divide and conquer of their covariance, broadcast projection."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitrec.llm.columns import quoted
from sitrec.llm.spectral import EPS, spectrum
from sitrec.storage import written

SCALE = 256
MOST = 1 << 46  # entries are held between -MOST and MOST, so that sums over a batch fit into 64 bits
ROWS = 1 << 14  # rows that are summed at a time
WIDTHS = ((2, "<i2", 1 << 15), (4, "<i4", 1 << 31), (8, "<i8", 1 << 62))
COMPONENT = "component"


def _whole_numbers(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrices of floor(256 c), one for each length; rows that are null or hold null or
    non-finite entries are left out."""
    offsets = vectors.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.values.to_numpy(zero_copy_only=False).astype(float)  # null becomes nan
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    held = vectors.is_valid().to_numpy(zero_copy_only=False) & (bad[offsets[1:]] == bad[offsets[:-1]])
    sizes = np.diff(offsets)
    for size in np.unique(sizes[held]):
        rows = np.flatnonzero(held & (sizes == size))
        for at in range(0, len(rows), ROWS):
            some = rows[at : at + ROWS]
            x = values[offsets[some][:, None] + np.arange(size)]
            yield some, np.clip(np.floor(SCALE * x), -MOST, MOST).astype(np.int64)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length and bytes of every vector, in the fewest bytes an entry that all its entries fit into."""
    for batch in batches:
        for _, x in _whole_numbers(batch.column(0)):
            largest = np.abs(x).max(axis=1, initial=0)
            least = -1
            for width, kind, most in WIDTHS:
                some = x[(largest > least) & (largest < most)]
                least = most - 1
                if not len(some):
                    continue
                ends = (np.arange(len(some) + 1) * width * x.shape[1]).astype(np.int32)
                raw = pa.Array.from_buffers(
                    pa.binary(), len(some), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(some.astype(kind).tobytes())]
                )
                dims = pa.array(np.full(len(some), x.shape[1], np.int32))
                yield pa.RecordBatch.from_arrays([dims, raw], names=["dims", "x"])


def _decode(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    for batch in batches:
        raw = batch.column(0)
        sizes = pc.binary_length(raw).to_numpy(zero_copy_only=False)
        for width, kind, _ in WIDTHS:
            rows = np.flatnonzero(sizes == width * dims)
            for at in range(0, len(rows), ROWS):
                some = raw.take(pa.array(rows[at : at + ROWS]))
                yield np.frombuffer(b"".join(some.to_pylist()), kind).reshape(-1, dims).astype(np.int64)


def fit_list(vectors: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Every distinct vector once, as bytes in ``x``, and its length.

    Vectors of one length belong together: of several lengths the one that most distinct vectors have is
    taken, of equally frequent ones the longest.  Copies are summed up before they shuffle.
    """
    encoded = vectors.select(quoted(vector).cast("array<double>").alias("v")).mapInArrow(_encode, "dims int, x binary")
    fit = written(encoded.where("dims > 0").distinct(), "fit")
    lengths = fit.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    dims = lengths[0].dims if lengths else 0
    return fit.where(F.col("dims") == dims).select("x"), dims


def exact_sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and their sum, exact; ``dims`` rows come back."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _decode(batches, dims):
            columns = [np.arange(dims), np.full(dims, len(x)), x.sum(axis=0)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i", "n", "s"])

    parts = fit.mapInArrow(add, "i long, n long, s long")
    total = F.sum(F.col("s").cast("decimal(20,0)"))
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), total.alias("s")).collect()
    sums = {r.i: int(r.s) for r in rows}
    return (rows[0].n if rows else 0), [sums.get(i, 0) for i in range(dims)]


def products(fit: DataFrame, dims: int, centre: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """Sum of (x - centre)(x - centre)' over the list, or of its projection by ``weights``.

    Every task gives one matrix, summed up in Spark entry by entry.  For a centre of whole numbers all is
    exact up to 2^53.
    """
    width = dims if weights is None else weights.shape[1]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((width, width)), False
        for x in _decode(batches, dims):
            z = x - centre
            z = z.astype(float) if weights is None else z @ weights
            total += z.T @ z
            some = True
        if some:
            i, j = np.triu_indices(width)
            columns = [i.astype(np.int32), j.astype(np.int32), total[i, j]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i", "j", "v"])

    out = np.zeros((width, width))
    for r in fit.mapInArrow(multiply, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r.v
    return out


class Whitening:
    """Mean and scaled components of a fit list; a matrix of ``dims`` by the components, and what they explain."""

    def __init__(self, fit: DataFrame, dims: int, components: int):
        self.dims = dims
        self.n, self.sums = exact_sums(fit, dims) if dims else (0, [])
        self.weights, self.explained, self.identity_error = np.empty((dims, 0)), [], None
        if self.n < 2:
            return
        n = self.n
        centre = [(2 * s + n) // (2 * n) for s in self.sums]  # nearest whole numbers
        rest = np.array([float(s - n * c) for s, c in zip(self.sums, centre)])
        covariance = (products(fit, dims, np.array(centre, np.int64)) - np.outer(rest, rest) / n) / n
        trace = float(np.trace(covariance))
        values, vectors = spectrum(covariance, components)
        kept = values > EPS * dims * trace  # a direction without variance cannot be whitened
        values, vectors = values[kept], vectors[:, kept]
        self.weights = vectors / np.sqrt(values)
        self.explained = (values / trace).tolist()
        if len(values):
            spread = products(fit, dims, self.mean(), self.weights) / n
            self.identity_error = float(np.abs(spread - np.eye(len(values))).max())

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def deviations(self, x: np.ndarray) -> list[Decimal | None]:
        """Sum of (n x - S)^2 of every row, in whole numbers."""
        bound = float(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.sums), default=0)
        if self.dims * bound**2 < 2.0**62:
            d = self.n * x - np.array(self.sums, np.int64)
            exact = (d * d).sum(axis=1).tolist()
        else:
            d = self.n * x.astype(object) - np.array(self.sums, object)
            exact = (d * d).sum(axis=1).tolist()
        return [Decimal(v) if v < 10**38 else None for v in exact]


def whiten(vectors: DataFrame, components: int = 4, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """``vec_id, n, deviation, whitened, explained, identity_error`` of every usable row; one array entry a component.

    Rows whose vector is null, empty or holds null or non-finite entries are left out, and so are those of another
    length than most distinct vectors have.  An entry c counts as floor(256 c), held between -2^46 and 2^46.  Mean,
    covariance (divisor n) and components belong to the list of all distinct vectors, so copies have no weight;
    they are projected all the same, each row of its own, with a null or repeated id too.  Components stand in
    order of falling variance; directions without variance are left out, so fewer may come back, none for
    fewer than two distinct vectors.  ``deviation`` is n^2 times the squared distance from the mean, a whole number
    (null beyond 38 digits).  Other columns are not carried.  An empty table gives no rows.

    The list shuffles once, in two bytes an entry if they do.  Sums come back entry by entry (``dims`` squared
    numbers at most, however many rows there are); the driver divides that one matrix, and its ``dims`` by
    ``components`` numbers are what every task is sent.
    """
    fit, dims = fit_list(vectors, vector)
    model = Whitening(fit, dims, components)
    kind = vectors.select(quoted(vec_id)).schema[0].dataType.simpleString()
    shared = vectors.sparkSession.sparkContext.broadcast(model)  # dims * components numbers

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        width = own.weights.shape[1]
        for batch in batches:
            for rows, x in _whole_numbers(batch.column(1)):
                if x.shape[1] != own.dims or not own.n:
                    continue
                y = (x - own.mean()) @ own.weights
                ends = np.arange(len(x) + 1, dtype=np.int32) * width
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows)),
                        pa.array(own.deviations(x), pa.decimal128(38, 0)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(y.ravel())),
                    ],
                    names=["vec_id", "deviation", "whitened"],
                )

    plain = vectors.select(quoted(vec_id).alias("vec_id"), quoted(vector).cast("array<double>").alias("v"))
    rows = plain.mapInArrow(project, f"vec_id {kind}, deviation decimal(38,0), whitened array<double>")
    return rows.select(
        "vec_id",
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.lit(model.explained).cast("array<double>").alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"),
    )


def by_component(whitened: DataFrame) -> DataFrame:
    """A row for every vector and component, numbered from 1; a deviation beyond 64 bits is null."""
    pair = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "pair")
    flat = whitened.select("vec_id", "n", F.col("deviation").try_cast("long").alias("deviation"), "identity_error", pair)
    return flat.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias(COMPONENT),
        "n",
        "deviation",
        F.col("pair.whitened").alias("whitened"),
        F.col("pair.explained").alias("explained"),
        "identity_error",
    )
