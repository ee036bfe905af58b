"""Quality rules: structure of words and lines, and the fertility of a public tokenizer within bands per script."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from sitrec.llm.columns import quoted, text_or_empty
from sitrec.llm.word_tokens import byte_slices, gathered, text_array, tokenizer_path, words_of

PIECES_FILE = "piece_bpe_32k.model"
WINDOW = 5
SYMBOL = "[#*$%&|<>]"


@dataclass(frozen=True)
class Band:
    """What a document of a script may have: code points per token, share of byte tokens, and token entropy.

    The entropy is compared with ``least_entropy`` times the logarithm of the number of tokens, counted up to
    1024, as a long text does not use ever more tokens.
    """

    least_chars: float
    most_chars: float
    most_fallback: float
    least_entropy: float = 0.45


#: Scripts in the order that decides ties; a text of any other script, or without letters, falls under "other".
SCRIPTS = ("Latin", "Cyrillic", "Greek", "Arabic", "Hebrew", "Devanagari", "Han", "Hiragana", "Katakana", "Hangul", "Thai")
#: Latin is measured: clean documents of sf0.1 have 1.88-2.32 characters a token (1st-99th percentile), English
#: licence texts 3.1-4.0; their relative entropy is 0.65 and more, their fallback 0.  The margins are 12 %, 24 %,
#: 11 % and five tokens in a hundred.  There is no clean text of other scripts here to measure; theirs are wide.
BANDS: dict[str, Band] = {
    "Latin": Band(1.65, 5.0, 0.05, 0.58),
    "Cyrillic": Band(0.8, 7.0, 0.25),
    "Greek": Band(0.5, 6.0, 0.6),
    "Arabic": Band(0.4, 6.0, 0.6),
    "Hebrew": Band(0.4, 6.0, 0.6),
    "Han": Band(0.25, 4.0, 0.95),
    "Hiragana": Band(0.25, 4.0, 0.95),
    "Katakana": Band(0.25, 4.0, 0.95),
    "Hangul": Band(0.25, 4.0, 0.95),
    "other": Band(0.2, 8.0, 1.0),
}
LEAST_TOKENS = 50  # of a text that is measured against its band; shorter ones are not judged by it


class PieceStore:
    """Pieces of distinct words, kept in one long array; at most ``remember`` words."""

    def __init__(self, path: str, remember: int = 400_000):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.is_byte = np.fromiter((self.model.is_byte(i) for i in range(size)), bool, size)
        self.remember = remember
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.lengths = np.empty(0, np.int32), np.empty(0, np.int64)

    def numbers(self, words: list[str]) -> np.ndarray:
        new = [w for w in words if w not in self.known]
        if self.known and len(self.known) + len(new) > self.remember:
            self._forget()
            new = words
        if new:
            pieces = self.model.encode(new, num_threads=1)
            base = len(self.lengths)
            self.known.update(zip(new, range(base, base + len(new))))
            more = np.fromiter(map(len, pieces), np.int64, len(pieces))
            flat = np.fromiter((i for p in pieces for i in p), np.int32, int(more.sum()))
            self.lengths, self.ids = np.concatenate([self.lengths, more]), np.concatenate([self.ids, flat])
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))


def summed(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[first])


def repeats_in(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def repeated_words(order: np.ndarray, doc: np.ndarray, n_distinct: int, n_docs: int) -> np.ndarray:
    """Whether each word lies in a window of five words that its document has twice or more.

    Windows are numbered by ranks of pairs, of pairs of pairs, and so on; equal numbers are equal windows.
    """
    n = len(order)
    out = np.zeros(n, bool)
    if n < WINDOW:
        return out

    def ranked(left: np.ndarray, right: np.ndarray, base: int) -> tuple[np.ndarray, int]:
        distinct, inverse = np.unique(left.astype(np.int64) * base + right, return_inverse=True)
        return inverse, len(distinct)

    two, n_two = ranked(order[:-1], order[1:], n_distinct)
    four, _ = ranked(two[:-2], two[2:], n_two)
    five, _ = ranked(four[:-1], order[4:], n_distinct)
    within = doc[: n - 4] == doc[4:]
    starts = np.flatnonzero(within)
    found = starts[repeats_in(five[starts].astype(np.int64) * n_docs + doc[starts])]
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, found, 1)
    np.add.at(cover, found + WINDOW, -1)
    return np.cumsum(cover[:-1]) > 0


def repeated_lines(texts: pa.Array) -> np.ndarray:
    """Number of each text's lines that hold a word and equal an earlier line of the text."""
    split = pc.split_pattern(texts, "\n")
    lines = split.flatten()
    doc = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    coded = lines.dictionary_encode()
    held = pc.match_substring_regex(coded.dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    number = coded.indices.to_numpy(zero_copy_only=False)
    use = held[number]
    number, doc = number[use].astype(np.int64), doc[use]
    distinct = np.unique(number * len(texts) + doc) % max(len(texts), 1)
    return np.bincount(doc, minlength=len(texts)) - np.bincount(distinct, minlength=len(texts))


def entropies(tokens: np.ndarray, offsets: np.ndarray, vocabulary: int) -> np.ndarray:
    """Shannon entropy, in bits, of the tokens between consecutive offsets."""
    sizes = np.diff(offsets)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    keys, counts = np.unique(doc * vocabulary + tokens, return_counts=True)
    part = counts * np.log2(counts)
    total = np.bincount(keys // vocabulary, weights=part, minlength=len(sizes))
    n = np.maximum(sizes, 1)
    return np.where(sizes > 0, np.log2(n) - total / n, 0.0)


def measured(texts: pa.Array, store: PieceStore) -> dict[str, np.ndarray]:
    """All figures of the texts of one array."""
    words, order, first = words_of(texts)
    chars = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    real = chars[order] > 0  # an edge of white space gives an empty word
    first = np.concatenate([[0], np.cumsum(real)])[first]
    order = order[real].astype(np.int64)
    n_words = np.diff(first)
    doc = np.repeat(np.arange(len(texts)), n_words)
    scripts = np.stack([pc.count_substring_regex(words, rf"\p{{{s}}}").to_numpy(zero_copy_only=False) for s in SCRIPTS])
    by_script = np.stack([summed(s[order], first) for s in scripts])
    best = np.argmax(by_script, axis=0)
    script = np.where(by_script.max(axis=0) > 0, np.array(SCRIPTS)[best], "other")

    number = store.numbers(words.to_pylist())[order]
    begin = np.cumsum(store.lengths) - store.lengths
    tokens = gathered(store.ids, begin, store.lengths, number)
    offsets = np.concatenate([[0], np.cumsum(store.lengths[number])])[first]
    n_tokens = np.diff(offsets)
    word_chars = summed(chars[order], first)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": pc.count_substring_regex(texts, SYMBOL).to_numpy(zero_copy_only=False),
        "n_dup_lines": repeated_lines(texts),
        "n_repeat_words": summed(repeated_words(order, doc, max(len(words), 1), max(len(texts), 1)), first),
        "script": script,
        "n_tokens": n_tokens,
        "chars_per_token": word_chars / np.maximum(n_tokens, 1),
        "fallback_share": summed(store.is_byte[tokens], offsets) / np.maximum(n_tokens, 1),
        "token_entropy": entropies(tokens, offsets, len(store.is_byte)),
    }


def verdicts(m: dict[str, np.ndarray], bands: Mapping[str, Band], least_tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """``base_failed`` and ``kept``."""
    failed = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
    band = [bands.get(s, bands["other"]) for s in m["script"]]

    def limit(name: str) -> np.ndarray:
        return np.array([getattr(b, name) for b in band], float)

    n = np.maximum(m["n_tokens"], 1)
    inside = (m["chars_per_token"] >= limit("least_chars")) & (m["chars_per_token"] <= limit("most_chars"))
    inside &= m["fallback_share"] <= limit("most_fallback")
    inside &= m["token_entropy"] >= limit("least_entropy") * np.log2(np.minimum(n, 1024))
    return failed, ~failed & (inside | (m["n_tokens"] < least_tokens))


def quality_rules(
    docs: DataFrame,
    bands: Mapping[str, Band] = BANDS,
    path: str | None = None,
    text: str = "text",
    doc_id: str = "doc_id",
    least_tokens: int = LEAST_TOKENS,
) -> DataFrame:
    """One row per document: figures of its whole text, ``base_failed`` and ``kept``.

    Words are divided by ASCII white space and encoded one by one.  The script of a text is that of most of its
    letters.  ``kept`` is false if the base rules fail (fewer than 10 words, or over a fifth of the words in
    repeated windows), or if a text of ``least_tokens`` tokens or more leaves the band of its script.
    A null text has no words and fails; a null id stays null; rows that repeat are judged one by one.
    Other columns are not carried.  A row depends on nothing but its own text; nothing is shuffled.
    """
    path = path or tokenizer_path(PIECES_FILE)
    bands = dict(bands)
    key = docs.select(quoted(doc_id)).schema[0].dataType.simpleString()
    schema = (
        f"doc_id {key}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, script string, n_tokens long, chars_per_token double, "
        "fallback_share double, token_entropy double"
    )
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = PieceStore(path)
        for batch in batches:
            for begin, part in byte_slices(text_array(batch.column(1))):
                m: dict = measured(part, store)
                m["base_failed"], m["kept"] = verdicts(m, bands, least_tokens)
                whole = [pa.array(m[n].astype(np.int64) if m[n].dtype.kind in "iu" else m[n]) for n in names[1:]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(part)), *whole], names=names)

    return docs.select(quoted(doc_id).alias("doc_id"), text_or_empty(text).alias("text")).mapInArrow(judge, schema)
