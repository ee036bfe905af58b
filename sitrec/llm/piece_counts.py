"""Counts of greedy word pieces by a linear longest-match automaton that never builds the pieces."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from sitrec.llm.columns import quoted, text_or_empty
from sitrec.llm.word_tokens import SYMBOLS, byte_slices, text_array, tokenizer_path, words_of

FINAL = 256  # added to the last byte of a word, so that pieces that end a word are others than those that do not
ALPHABET = 2 * FINAL
NONE = -1
LONG = 512  # bytes of a word beyond which it is walked by itself


def byte_level_pieces(path: str, word_end: str = "</w>") -> list[tuple[int, ...]]:
    """The pieces of a byte-level vocabulary file with word ends, as symbols; special tokens are left out."""
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    special = {t["content"] for t in content["added_tokens"]}
    back = {chr(c): b for b, c in SYMBOLS.items()}
    pieces = []
    for token in content["model"]["vocab"]:
        if token in special:
            continue
        body = token.removesuffix(word_end)
        symbols = [back[c] if c in back else ord(c) for c in body]
        if body != token and symbols:
            symbols[-1] += FINAL
        pieces.append(tuple(symbols))
    return [p for p in pieces if p]


def automaton_tables(pieces: Iterable[tuple[int, ...]]) -> tuple[np.ndarray, ...]:
    """Trie of the pieces with failure links: edge keys (in order) and their targets, links, popped counts.

    At a node without a child for the next symbol, ``popped`` says how many pieces the longest-match division
    has finished, and ``link`` is the node of what is left of the word so far.  A piece's own node pops that
    piece and goes back to the root.
    """
    children: list[dict[int, int]] = [{}]
    ends, parent, symbol = [False], [NONE], [NONE]
    for piece in pieces:
        node = 0
        for s in piece:
            if s not in children[node]:
                children[node][s] = len(children)
                children.append({})
                ends.append(False)
                parent.append(node)
                symbol.append(s)
            node = children[node][s]
        ends[node] = True
    link, popped = [NONE] * len(children), [0] * len(children)
    queue = list(children[0].values())
    for node in queue:  # grows while it is walked: breadth first
        queue.extend(children[node].values())
        if ends[node]:
            link[node], popped[node] = 0, 1
            continue
        at, count = link[parent[node]], popped[parent[node]]
        while at != NONE and symbol[node] not in children[at]:
            count += popped[at]
            at = link[at]
        if at != NONE:
            link[node], popped[node] = children[at][symbol[node]], count
    edges = sorted((n * ALPHABET + s, c) for n, kids in enumerate(children) for s, c in kids.items())
    keys, targets = (np.array([e[i] for e in edges], np.int64) for i in (0, 1))
    return keys, targets, np.array(link, np.int64), np.array(popped, np.int64)


class Automaton:
    """Counts pieces from the tables.

    Every symbol is read once and every pop is paid for by a symbol, so a word takes time in proportion to
    its length.
    """

    def __init__(self, keys: np.ndarray, targets: np.ndarray, link: np.ndarray, popped: np.ndarray):
        self.keys, self.targets, self.link, self.popped = keys, targets, link, popped
        self.edges: dict[int, int] = {}

    def count(self, symbols: Iterable[int]) -> int:
        """Pieces of one word; a word that cannot be divided is one unknown piece."""
        if not self.edges:
            self.edges = dict(zip(self.keys.tolist(), self.targets.tolist()))
        edges, link, popped = self.edges, self.link, self.popped
        node, n = 0, 0
        for s in symbols:
            while (to := edges.get(node * ALPHABET + s)) is None:
                n += int(popped[node])
                node = int(link[node])
                if node == NONE:
                    return 1
            node = to
        while node:
            n += int(popped[node])
            node = int(link[node])
            if node == NONE:
                return 1
        return n

    def _step(self, node: np.ndarray, n: np.ndarray, symbol: np.ndarray) -> None:
        todo = np.flatnonzero(node != NONE)
        while len(todo):
            want = node[todo] * ALPHABET + symbol[todo]
            at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            hit = self.keys[at] == want
            node[todo[hit]] = self.targets[at[hit]]
            todo = todo[~hit]
            n[todo] += self.popped[node[todo]]
            node[todo] = self.link[node[todo]]
            todo = todo[node[todo] != NONE]

    def counts(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Pieces of many words, bytes ``data[start : start + length]`` each: all words take a step at a time."""
        out = np.zeros(len(starts), np.int64)
        for i in np.flatnonzero(lengths > LONG):
            word = data[starts[i] : starts[i] + lengths[i]].tolist()
            word[-1] += FINAL
            out[i] = self.count(word)
        rows = np.flatnonzero((lengths <= LONG) & (lengths > 0))
        rows = rows[np.argsort(-lengths[rows], kind="stable")]
        size, start = lengths[rows], starts[rows]
        node, n = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for at in range(int(size[0]) if len(rows) else 0):
            active = int(np.searchsorted(-size, -at, side="left"))  # words longer than ``at`` stand first
            symbol = data[start[:active] + at].astype(np.int64) + FINAL * (size[:active] == at + 1)
            self._step(node[:active], n[:active], symbol)
        while True:  # what the words' ends have left
            open_ = np.flatnonzero(node > 0)
            if not len(open_):
                break
            n[open_] += self.popped[node[open_]]
            node[open_] = self.link[node[open_]]
        out[rows] = np.where(node == NONE, 1, n)
        return out


def piece_counts(
    docs: DataFrame, pieces: Iterable[tuple[int, ...]] | None = None, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``doc_id, n_words, n_pieces`` of every document.

    Words are divided by ASCII white space; A-Z count as lower case.  A word is divided from the left, each
    time by the longest piece that matches; its last byte only matches pieces that end a word.  A word that
    cannot be divided so is one piece.  ``pieces`` are given as symbols: bytes, plus 256 for a last byte; by
    default they are those of a public vocabulary, in which every byte is a piece.
    A null text has no words, a null id stays null, rows that repeat are counted one by one, other columns
    are not carried.  A row depends on its own text only; nothing is shuffled.  Memory is bounded by a slice
    of 8 MB of texts or one longer text.
    """
    tables = automaton_tables(byte_level_pieces(tokenizer_path()) if pieces is None else pieces)
    key = docs.select(quoted(doc_id)).schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(tables)  # as large as the vocabulary

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(*shared.value)
        for batch in batches:
            for begin, part in byte_slices(text_array(batch.column(1))):
                words, order, first = words_of(pc.ascii_lower(part))
                offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
                held = words.buffers()[2]
                data = np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8)
                lengths = np.diff(offsets).astype(np.int64)
                n = automaton.counts(data, offsets[:-1].astype(np.int64), lengths)[order]
                real = lengths[order] > 0
                both = [np.diff(np.concatenate([[0], np.cumsum(x)])[first]) for x in (real, n)]
                columns = [batch.column(0).slice(begin, len(part)), *map(pa.array, both)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_pieces"])

    table = docs.select(quoted(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    return table.mapInArrow(count, f"doc_id {key}, n_words long, n_pieces long")
