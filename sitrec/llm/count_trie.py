"""A trie of letter-group counts, searched with a budget of one count too many and one too few.

Words are byte strings of one byte a letter.  A letter's group is its code modulo ``GROUPS``; a word's path is the
number of its letters in one group after the other, so words that differ by one inserted, deleted or replaced
letter have paths that differ by one surplus and one deficit at most.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

GROUPS = 13
FRONT = 1 << 14  # places of the trie that are entered, and words that are compared, at a time
WIDE = 32  # bytes; longer words are compared one by one
EDGE = 3  # letters: of two words one edit apart the longer of which has 2 EDGE or more, that many at one end are equal


def letter_counts(words: Sequence[bytes]) -> np.ndarray:
    """Letters of each group in each word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer(b"".join(words), np.uint8).astype(np.int64) % GROUPS
    at = np.repeat(np.arange(len(words)) * GROUPS, sizes) + letters
    return np.bincount(at, minlength=len(words) * GROUPS).reshape(-1, GROUPS)


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


class Letters:
    """Words as rows of bytes that begin, or end, together; of words of more than ``WIDE`` letters only the ends."""

    def __init__(self, words: Sequence[bytes]):
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        left = b"".join([w[:WIDE].ljust(WIDE, b"\0") for w in words])
        right = b"".join([w[-WIDE:].rjust(WIDE, b"\0") for w in words])
        self.left, self.right = (np.frombuffer(r, np.uint8).reshape(-1, WIDE) for r in (left, right))
        powers = 1 << (8 * np.arange(EDGE))
        self.ends = self.left[:, :EDGE] @ powers, self.right[:, -EDGE:] @ powers


class CountTrie:
    """Words below one place of a trie; ``order`` names the groups that are still to be counted."""

    def __init__(self, words: Sequence[bytes], order: Sequence[int]):
        counts = letter_counts(words)[:, order]
        self.order = list(order)
        place = np.lexsort(counts.T[::-1]) if len(order) else np.arange(len(words))
        self.words = [words[i] for i in place]
        self.place = place
        self.letters = Letters(self.words)
        counts = counts[place]
        self.span = int(counts.max(initial=0)) + 3
        #: of each level, its nodes as parent * span + count, rising
        self.levels: list[np.ndarray] = []
        parent = np.zeros(len(words), np.int64)
        for j in range(len(order)):
            self.levels.append(np.unique(parent * self.span + counts[:, j]))
            parent = np.searchsorted(self.levels[-1], parent * self.span + counts[:, j])
        leaves = np.arange((int(parent[-1]) if len(words) else -1) + 1)
        self.first, self.last = np.searchsorted(parent, leaves), np.searchsorted(parent, leaves, side="right")

    def candidates(self, words: Sequence[bytes], surplus: np.ndarray, deficit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (asking word, word at a leaf) whose paths differ by ``surplus`` and ``deficit`` at most.

        Depth first: the deepest places found are entered next, at most ``FRONT`` of them together.
        """
        if not self.words or not words:
            return
        asked = letter_counts(words)[:, self.order]
        start = (np.arange(len(words)), np.zeros(len(words), np.int64), surplus.astype(np.int64), deficit.astype(np.int64))
        stack = [(0, start)]
        while stack:
            level, front = stack.pop()
            if len(front[0]) > FRONT:
                stack.append((level, tuple(x[FRONT:] for x in front)))
                front = tuple(x[:FRONT] for x in front)
            who, node, more, less = front
            if level == len(self.levels):
                n = self.last[node] - self.first[node]
                ends = np.cumsum(n)
                yield np.repeat(who, n), np.repeat(self.first[node] - ends + n, n) + np.arange(int(ends[-1]) if len(ends) else 0)
                continue
            nodes, found = self.levels[level], []
            for step in (0, 1, -1):
                count = asked[who, level] + step
                able = (count >= 0) & (count < self.span)
                able &= {0: able, 1: more > 0, -1: less > 0}[step]
                key = node * self.span + count
                child = np.minimum(np.searchsorted(nodes, key), len(nodes) - 1)
                go = np.flatnonzero(able & (nodes[child] == key))
                found.append((who[go], child[go], more[go] - (step > 0), less[go] - (step < 0)))
            front = tuple(np.concatenate(x) for x in zip(*found))
            if len(front[0]):
                stack.append((level + 1, front))

    def one_edit_away(
        self, words: Sequence[bytes], surplus: np.ndarray, deficit: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The candidates that differ by exactly one edit: numbers of the asking words and of this trie's words."""
        asking, own = Letters(words), self.letters
        for who, what in self.candidates(words, surplus, deficit):
            for at in range(0, len(who), FRONT):
                a, b = who[at : at + FRONT], what[at : at + FRONT]
                most = np.maximum(asking.sizes[a], own.sizes[b])
                near = (most < 2 * EDGE) | (asking.ends[0][a] == own.ends[0][b]) | (asking.ends[1][a] == own.ends[1][b])
                a, b, most = a[near], b[near], most[near]
                least = np.minimum(asking.sizes[a], own.sizes[b])
                near = most - least <= 1
                wide = np.flatnonzero(near & (most > WIDE))
                near[wide] = [one_edit(words[i], self.words[j]) for i, j in zip(a[wide], b[wide])]
                plain = np.flatnonzero(near & (most <= WIDE))
                a1, b1, m = a[plain], b[plain], least[plain]
                ahead = asking.left[a1] != own.left[b1]
                back = asking.right[a1][:, ::-1] != own.right[b1][:, ::-1]
                differ = ahead.any(axis=1)
                before = np.minimum(np.where(differ, ahead.argmax(axis=1), m), m)
                behind = np.minimum(np.where(differ, back.argmax(axis=1), m), m)
                # one edit lies between a common beginning and a common end
                near[plain] = differ & (before + behind >= most[plain] - 1)
                yield a[near], self.place[b[near]]
