"""Language identification by compression with a dictionary per language."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitrec.llm.columns import held_out, quoted, text_or_empty, without
from sitrec.llm.word_tokens import byte_slices, text_array, trimmed

UNKNOWN = "und"
LEVEL = 6
SLICE = 1 << 20  # bytes of texts that are judged at a time
CHUNK = 4096  # bytes of a text that are compressed together, so that a long text keeps using the dictionary
SHORT = 512  # bytes up to which a text is measured behind contexts; alone it would hardly be compressed
CONTEXT = 1024  # bytes of a context
SOFT = 2.0  # bytes of a margin that change the odds by e
NARROW = 0.2  # bytes between the best two sizes; less is too narrow a margin
ADDED = ("lang_pred", "score", "rejected")


def learn(
    docs: DataFrame,
    samples: int = 64,
    sample_chars: int = 4096,
    contexts: int = 16,
    most_languages: int = 256,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
) -> dict[str, tuple[bytes, list[bytes]]]:
    """Dictionary and contexts of each language, from a bounded sample of labelled rows.

    Per language the ``samples + contexts`` ids with the smallest hash give up to ``sample_chars``
    characters each, for the ``most_languages`` languages with most rows; held-out rows and rows without
    id, label or text are left out.  An id counts once, however many rows repeat it, with the smallest
    text.  That is at most 75 MB at the defaults' bounds, 300 KB a language.  Only ids and hashes are
    ranked, each task passing on its best alone; texts are fetched for the chosen ids and one of each
    comes to the driver.
    """
    named = docs.where(
        quoted(lang).isNotNull() & quoted(doc_id).isNotNull() & ~held_out(quoted(doc_id)) & (F.length(F.trim(text_or_empty(text))) > 0)
    )
    rows = named.select(
        quoted(lang).cast("string").alias("lang"), quoted(doc_id).alias("id"), F.xxhash64(quoted(doc_id).cast("string"), F.lit(7)).alias("h")
    )
    top = [r.lang for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()]
    if not top:
        return {}
    wanted = samples + contexts

    def best(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            both = frame if held is None else pd.concat([held, frame])
            held = both.drop_duplicates().sort_values(["lang", "h", "id"]).groupby("lang", sort=False).head(wanted)
        if held is not None:
            yield held

    place = Window.partitionBy("lang").orderBy("h", "id")
    bests = rows.where(F.col("lang").isin(top)).mapInPandas(best, rows.schema).distinct()
    chosen = bests.withColumn("place", F.row_number().over(place)).where(F.col("place") <= wanted)
    texts = named.select(
        quoted(lang).cast("string").alias("lang"), quoted(doc_id).alias("id"), F.substring(text_or_empty(text), 1, sample_chars).alias("text")
    )
    # at most most_languages * wanted ids; each task passes on one text of each
    found = texts.join(F.broadcast(chosen), ["lang", "id"]).groupBy("lang", "place").agg(F.min("text").alias("text"))
    by_lang: dict[str, dict[int, str]] = {}
    for r in found.collect():
        by_lang.setdefault(r.lang, {})[r.place] = r.text
    out = {}
    for name, slots in sorted(by_lang.items()):
        parts = [slots[k].lower().encode() for k in sorted(slots)]
        apart = min(contexts, len(parts) // 2)
        behind = sorted(parts, key=lambda p: len(p) < CONTEXT)[:apart]  # in order of hash; those that fill a context first
        kept = [p for p in parts if p not in behind] or parts
        out[name] = (b"\n".join(kept), [p[:CONTEXT] for p in behind or parts])
    return out


class Classifier:
    """Sizes of a text under each language's dictionary."""

    def __init__(self, model: Mapping[str, tuple[bytes, list[bytes]]]):
        import zstandard

        self.names = sorted(model)
        self.compress, self.contexts = [], []
        for name in self.names:
            content, contexts = model[name]
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            bare = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
            compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, **bare).compress
            self.compress.append(compress)
            self.contexts.append([(c + b" ", len(compress(c + b" "))) for c in contexts])

    def sizes(self, data: bytes) -> list[float]:
        """Bytes that the text takes, or that it adds to a context on average if it is short."""
        if len(data) <= SHORT:
            return [
                sum(len(compress(c + data)) - size for c, size in contexts) / len(contexts)
                for compress, contexts in zip(self.compress, self.contexts)
            ]
        chunks = [data[at : at + CHUNK] for at in range(0, len(data), CHUNK)]
        return [float(sum(len(compress(c)) for c in chunks)) for compress in self.compress]

    def predict(self, text: str) -> tuple[str, float, bool]:
        sizes = self.sizes(text.lower().encode())
        least = min(sizes)
        score = 1.0 / sum(math.exp((least - s) / SOFT) for s in sizes)
        ranked = sorted(sizes)
        return self.names[sizes.index(least)], score, len(ranked) > 1 and ranked[1] - least < NARROW


def identify(docs: DataFrame, model: Mapping[str, tuple[bytes, list[bytes]]], text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``lang_pred, score, rejected``.

    The prediction is the language whose dictionary compresses the whole text, in lower case, best; of equal
    sizes the first by name.  The score is 1 over the sum of exp(-margin / SOFT bytes) over all languages.  A
    margin of less than ``NARROW`` bytes between the best two rejects the row, and so does a text that is null or
    has no letter: its language is ``und``, its score 0.  Without any learned language all rows are ``und``.
    Columns of ``docs`` that have the name of an added column are replaced.  Rows are judged one by one.
    """
    clean = without(docs, ADDED)
    shared = docs.sparkSession.sparkContext.broadcast(dict(model))  # bounded by learn()
    schema = T.StructType(list(clean.schema)).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    at = [c.lower() for c in clean.columns].index(text.lower())
    names = schema.names

    @trimmed
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(shared.value)
        for batch in batches:
            texts = text_array(batch.column(at))
            for begin, part in byte_slices(texts, SLICE):
                lettered = pc.match_substring_regex(part, r"\p{L}").to_pylist()
                found = [
                    classifier.predict(t) if ok and classifier.names else (UNKNOWN, 0.0, True)
                    for t, ok in zip(part.to_pylist(), lettered)
                ]
                added = [
                    pa.array([n for n, _, _ in found], pa.string()),
                    pa.array([s for _, s, _ in found], pa.float64()),
                    pa.array([r for _, _, r in found], pa.bool_()),
                ]
                rows = batch.slice(begin, len(part))
                yield pa.RecordBatch.from_arrays([*rows.columns, *added], names=names)

    return clean.mapInArrow(judge, schema)


def identify_language(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """Learn from the labelled rows that are not held out and predict every row; adds ``held_out`` too.

    Held out are rows whose crc32 of the id, as text, leaves 2 modulo 4; a null id is not held out.
    """
    model = learn(docs, text=text, doc_id=doc_id, **how)
    return identify(without(docs, ["held_out"]), model, text).withColumn("held_out", held_out(quoted(doc_id)))
