"""Quality classifier: a factorization machine over hashed words, structure statistics and text length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitrec.llm.columns import held_out, quoted, text_or_empty
from sitrec.llm.fertility import repeated_lines, repeated_words, summed
from sitrec.llm.word_tokens import byte_slices, text_array, words_of

BUCKETS = 1 << 12  # of hashed words
SHARES = (0.001, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.99)
#: Statistics and the limits that cut each into classes; a class is a feature of value 1.
LIMITS: dict[str, tuple[float, ...]] = {
    "words": (1, 5, 10, 20, 50, 100, 200, 500, 1000, 2000, 5000),
    "bytes": (1, 50, 200, 500, 1000, 2000, 5000, 10_000, 30_000, 100_000),
    "word_length": (2, 3, 4, 5, 6, 7, 8, 10, 12, 15),
    "distinct": SHARES,
    "commonest": SHARES,
    "repeated": SHARES,
    "lines": SHARES,
    "symbols": SHARES,
    "upper": SHARES,
    "digits": SHARES,
    "marks": SHARES,
    "wide": SHARES,
}
COUNTED = {"symbols": r"[#*$%&|<>]", "upper": r"\p{Lu}", "digits": "[0-9]", "marks": r"[.,;:!?'\"()-]", "wide": r"[^\x00-\x7F]"}
STARTS = np.cumsum([BUCKETS, *(len(x) + 1 for x in LIMITS.values())])
FEATURES = int(STARTS[-1])
SURE = 0.7  # score from which a document is predicted to be good


def text_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, feature numbers and values of each text; a feature stands once in a text.

    A word's value is its share of the text's words, so long and short texts are alike.
    """
    n_docs = len(texts)
    words, order, first = words_of(texts)
    chars = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    real = chars[order] > 0
    first = np.concatenate([[0], np.cumsum(real)])[first]
    order = order[real].astype(np.int64)
    n = np.diff(first)
    some = np.maximum(n, 1)
    doc = np.repeat(np.arange(n_docs), n)
    total = np.maximum(summed(chars[order], first), 1)
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False)

    n_words = max(len(words), 1)
    pairs, counts = np.unique(doc * n_words + order, return_counts=True)
    pair_doc, pair_word = pairs // n_words, pairs % n_words
    commonest = np.zeros(n_docs, np.int64)
    np.maximum.at(commonest, pair_doc, counts)
    stats = {
        "words": n,
        "bytes": size,
        "word_length": total / some,
        "distinct": np.bincount(pair_doc, minlength=n_docs) / some,
        "commonest": commonest / some,
        "repeated": summed(repeated_words(order, doc, n_words, max(n_docs, 1)), first) / some,
        "lines": repeated_lines(texts) / (pc.count_substring(texts, "\n").to_numpy(zero_copy_only=False) + 1),
    }
    for name, pattern in COUNTED.items():
        per_word = pc.count_substring_regex(words, pattern).to_numpy(zero_copy_only=False)
        stats[name] = summed(per_word[order], first) / total
    classes = [STARTS[i] + np.searchsorted(LIMITS[k], stats[k], side="right") for i, k in enumerate(LIMITS)]

    bucket = np.fromiter((zlib.crc32(w) % BUCKETS for w in pc.utf8_lower(words).cast(pa.binary()).to_pylist()), np.int64, len(words))
    keys, inverse = np.unique(pair_doc * BUCKETS + bucket[pair_word], return_inverse=True)
    share = np.bincount(inverse, weights=counts, minlength=len(keys)) / some[keys // BUCKETS]
    all_doc = np.concatenate([keys // BUCKETS, np.tile(np.arange(n_docs), len(classes))])
    all_feature = np.concatenate([keys % BUCKETS, *classes])
    all_value = np.concatenate([share, np.ones(n_docs * len(classes))])
    by_doc = np.argsort(all_doc, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(all_doc, minlength=n_docs))])
    return offsets, all_feature[by_doc].astype(np.int32), all_value[by_doc].astype(np.float32)


@dataclass
class Model:
    """Intercept, weights and factors of the features."""

    w0: float
    w: np.ndarray
    v: np.ndarray

    def margins(self, offsets: np.ndarray, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Linear part and all pairs: half of (square of the sum less sum of the squares), factor by factor."""
        starts = offsets[:-1]  # every text has features, so no run is empty
        if not len(starts):
            return np.empty(0)
        out = self.w0 + np.add.reduceat(self.w[feature] * value, starts)
        for f in range(self.v.shape[1]):
            x = self.v[feature, f] * value
            out += 0.5 * (np.add.reduceat(x, starts) ** 2 - np.add.reduceat(x * x, starts))
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def fit(
    offsets: np.ndarray, feature: np.ndarray, value: np.ndarray, label: np.ndarray,
    factors: int = 4, passes: int = 120, rate: float = 0.05, penalty: float = 1e-3, seed: int = 1,
) -> Model:
    """Logistic loss with a quadratic penalty, all rows a step, steps by Adam."""
    rng = np.random.default_rng(seed)
    share = np.clip(label.mean(), 0.01, 0.99)
    model = Model(float(np.log(share / (1 - share))), np.zeros(FEATURES), rng.normal(0, 0.05, (FEATURES, factors)))
    row = np.repeat(np.arange(len(label)), np.diff(offsets))
    theta = np.concatenate([[model.w0], model.w, model.v.ravel()])
    m, s = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, passes + 1):
        model = Model(float(theta[0]), theta[1 : FEATURES + 1], theta[FEATURES + 1 :].reshape(FEATURES, factors))
        error = (sigmoid(model.margins(offsets, feature, value)) - label) / len(label)
        pull = error[row] * value
        slopes = [np.array([error.sum()]), np.bincount(feature, weights=pull, minlength=FEATURES) + penalty * model.w]
        by_factor = np.empty((FEATURES, factors))
        for f in range(factors):
            x = model.v[feature, f] * value
            rest = np.add.reduceat(x, offsets[:-1])[row] - x
            by_factor[:, f] = np.bincount(feature, weights=pull * rest, minlength=FEATURES)
        slopes.append((by_factor + penalty * model.v).ravel())
        g = np.concatenate(slopes)
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Model(float(theta[0]), theta[1 : FEATURES + 1], theta[FEATURES + 1 :].reshape(FEATURES, factors))


def learn(
    docs: DataFrame, labels: DataFrame, sample: int = 4000, text: str = "text", doc_id: str = "doc_id",
    label: str = "quality", **how,
) -> Model:
    """Fit on at most ``sample`` labelled documents, those with the smallest hashes of their ids.

    Held-out rows (crc32 of the id, as text, leaves 2 modulo 4), rows with a null id or label, and ids without
    document are left out; a document with several different labels stands for each.  An id that repeats counts
    once a label, with the text of the smallest hash.  Their features, some hundreds of numbers a document, are
    gathered on the driver.  Without rows of both labels the model gives the share of 1.
    """
    known = labels.where(quoted(label).isNotNull() & quoted(doc_id).isNotNull() & ~held_out(quoted(doc_id)))
    known = known.select(quoted(doc_id).alias("id"), quoted(label).cast("double").alias("y"))
    chosen = known.distinct().orderBy(F.xxhash64(F.col("id").cast("string"), F.lit(9)), "id", "y").limit(sample)
    texts = docs.select(quoted(doc_id).alias("id"), text_or_empty(text).alias("text"))
    held = texts.join(F.broadcast(chosen), "id")  # at most ``sample`` ids, each task passing on one text of each
    rows = held.groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, part in byte_slices(text_array(batch.column(2))):
                offsets, feature, value = text_features(part)
                at = pa.array(offsets.astype(np.int32))
                lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (feature, value)]
                held = [batch.column(i).slice(begin, len(part)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*held, *lists], names=["id", "y", "feature", "value"])

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(features, f"id {kind}, y double, feature array<int>, value array<float>").toArrow()
    found = found.sort_by([("id", "ascending"), ("y", "ascending")]).combine_chunks()
    y = found["y"].to_numpy()
    if not len(y) or y.min() == y.max():
        share = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
        return Model(float(np.log(share / (1 - share))), np.zeros(FEATURES), np.zeros((FEATURES, 1)))
    lists = [pa.concat_arrays(found[c].chunks) for c in ("feature", "value")]
    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(lists[0]).to_numpy())])
    return fit(offsets, *(x.flatten().to_numpy() for x in lists), y, **how)


def score_quality(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; ``predicted`` is 1 from a score of ``SURE``.

    A null text is an empty one and has a score too, that of its empty statistics.  A null id stays null and is
    not held out; rows that repeat are scored one by one.  Other columns are not read.  Nothing is shuffled.
    """
    key = docs.select(quoted(doc_id)).schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((model.w0, model.w, model.v))  # FEATURES numbers a factor

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Model(*shared.value)
        for batch in batches:
            for begin, part in byte_slices(text_array(batch.column(1))):
                scores = sigmoid(machine.margins(*text_features(part)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, len(part)), pa.array(scores)], names=["doc_id", "score"]
                )

    table = docs.select(quoted(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    scored = table.mapInArrow(score, f"doc_id {key}, score double")
    sure = (F.col("score") >= SURE).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", sure)
