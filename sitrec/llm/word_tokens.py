"""Token ids of whole texts by the tokenizers library, each distinct word encoded once."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS_FILE = "word_bpe_49k.json"
# ASCII punctuation that makes a token run of its own after a letter; an apostrophe may start a contraction
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# letters and digits that stay what they are, one character, under normalisation
LETTER = "[a-z0-9À-ÖØ-öø-įı-ɏ]"
PLAIN = "[A-Za-zÀ-ÖØ-öø-įĲ-ňŊ-ſ]+"
BODY = f"^(?s:.*){LETTER}"
TAIL = LETTER + "[!-&(-/:-@\\[-`{-~]+$"


def _symbols() -> dict[int, int]:
    """Characters by which a byte-level vocabulary writes bytes: printable ones as they are, others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: 0x100 + i for i, b in enumerate(others)}


SYMBOLS = _symbols()


def tokenizer_path(name: str = WORDS_FILE) -> str:
    """Place of a public vocabulary on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def trimmed(task):
    """A task function that gives back memory at its end: Python workers stay, and so would what they held."""

    @functools.wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
            ctypes.CDLL(None).malloc_trim(0)

    return run


def byte_slices(texts: pa.Array, most: int = 8 << 20) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive parts of about ``most`` bytes, with the row each begins at; a longer text is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    begin = 0
    while begin < len(texts):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield begin, texts.slice(begin, end - begin)
        begin = end


def text_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One array of strings without nulls; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.string()), "")


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the number of each word in order, and where each text's words begin.

    Words are divided by ASCII white space; an empty word may stand at an edge of a text.
    """
    split = pc.ascii_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    first = split.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), first - first[0]


def gathered(values: np.ndarray, first: np.ndarray, length: np.ndarray, take: np.ndarray) -> np.ndarray:
    """Runs ``values[first[i] : first[i] + length[i]]`` for each i of ``take``, one after the other."""
    n = length[take]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(values)) < 2**31 else np.int64
    at = np.repeat((first[take] - ends + n).astype(kind), n)
    at += np.arange(total, dtype=kind)
    return values[at]


class WordEncoder:
    """Encodes texts word by word.

    The tokenizer drops white space before it merges, and no ASCII white space character joins with a
    neighbour under its normalisation, so a text's ids are those of its words, in order.  ASCII punctuation
    after a word's last letter or digit is a token run of its own, so it is encoded apart.  Parts of words
    met before are taken from a memory of at most ``remember`` entries.
    """

    def __init__(self, path: str, remember: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.remember = remember
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.ids = array("I")
        self.lengths = array("I", [0])

    def _learn(self, parts: list[str]) -> None:
        tokenize, known, ids, lengths = self.tokenizer.model.tokenize, self.known, self.ids, self.lengths
        rest, plain = [], re.compile(PLAIN).fullmatch
        for part in parts:
            if plain(part):  # one pre-token; lower case is all that normalisation does to it
                new = [t.id for t in tokenize(part.lower().encode().decode("latin-1").translate(SYMBOLS))]
                known[part] = len(lengths)
                ids.extend(new)
                lengths.append(len(new))
            else:
                rest.append(part)
        for at in range(0, len(rest), 10_000):
            some = rest[at : at + 10_000]
            for part, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                new = e.ids
                known[part] = len(lengths)
                ids.extend(new)
                lengths.append(len(new))

    def _parts(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of each word's body and of the punctuation behind it."""
        # a special token is looked for before anything else, so a word that may hold one stays as it is
        special = pc.match_substring(words, "<|")
        words = pc.if_else(special, words, pc.ascii_lower(words))
        cut = pc.and_not(pc.match_substring_regex(words, TAIL), special)
        tail = pc.if_else(cut, pc.replace_substring_regex(words, BODY, ""), "")
        body = pc.if_else(cut, pc.ascii_rtrim(words, PUNCTUATION), words)
        coded = pa.chunked_array([body, tail]).combine_chunks().dictionary_encode()
        parts = coded.dictionary.to_pylist()
        new = [p for p in parts if p not in self.known]
        if len(self.known) + len(new) > self.remember:
            self._forget()
            new = [p for p in parts if p not in self.known]
        self._learn(new)
        number = np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))
        both = number[coded.indices.to_numpy(zero_copy_only=False)]
        return both[: len(words)], both[len(words) :]

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the offsets of each; ``end`` follows every text."""
        words, order, first = words_of(texts)
        body, tail = self._parts(words)
        lengths = np.array(self.lengths, np.int64)
        take = np.empty(2 * len(order), np.int64)
        take[::2], take[1::2] = body[order], tail[order]
        values = gathered(np.array(self.ids, np.uint32), np.cumsum(lengths) - lengths, lengths, take)
        ends = np.concatenate([[0], np.cumsum((lengths[body] + lengths[tail])[order])])
        offsets = ends[first]
        if end is not None:
            values = np.insert(values, offsets[1:], end)
            offsets = offsets + np.arange(len(offsets))
        return values, offsets
