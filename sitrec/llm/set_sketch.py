"""SetSketch registers of sets of shingles: exponentially spaced, truncated minima.

Register i of a set is ``floor(1 - log_b(x))`` held between 0 and ``LIMIT``, x the least of exponentially distributed
hashes (rate ``RATE``) of the set's members.  The registers of a union are the larger ones of both sets; two
sets share a register with about the probability of their Jaccard similarity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sitrec.llm.word_tokens import words_of

BASE, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 1
SLICE = 1 << 20  # bytes of texts whose shingles are held at a time
SURE = 5.0  # standard deviations that a filter leaves to true links: it drops one in three million
_RNG = np.random.default_rng(42)
_MOST = 1024
_XOR = _RNG.integers(0, 1 << 32, _MOST, np.uint64).astype(np.uint32)
_ODD = (_RNG.integers(0, 1 << 31, _MOST, np.uint64) * 2 + 1).astype(np.uint32)
_WIDE = _RNG.integers(0, 1 << 63, _MOST, np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    h = (h ^ _WIDE[seed]) * _FACTOR
    h ^= h >> np.uint64(32)
    h *= _FACTOR
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit hashes of each text's shingles, rising, and where each text's begin.

    A-Z count as lower case, words are divided by ASCII white space.  A text of fewer words is one shingle, one
    without words has none.
    """
    from xxhash import xxh64_intdigest

    distinct, codes, first = words_of(pc.ascii_lower(texts))
    names = distinct.cast(pa.binary()).to_pylist()
    hashed = np.fromiter((xxh64_intdigest(w, 42) for w in names), np.uint64, len(names))
    is_word = np.fromiter(map(len, names), np.int64, len(names)) > 0
    held = is_word[codes] if len(codes) else np.empty(0, bool)
    first = np.concatenate([[0], np.cumsum(held)])[first]
    h = hashed[codes[held]] if len(codes) else np.empty(0, np.uint64)
    n_words = np.diff(first)
    text = np.repeat(np.arange(len(n_words)), n_words)

    def rolled(begin: np.ndarray, length: int) -> np.ndarray:
        total = np.full(len(begin), length, np.uint64)
        for k in range(length):
            total = total * _FACTOR + h[begin + k]
        return mixed(total, length)

    at = np.arange(len(h))
    whole = at[at + shingle <= first[text + 1]] if len(h) else at
    found, owner = [rolled(whole, shingle)], [text[whole]]
    for length in range(1, shingle):
        short = np.flatnonzero(n_words == length)
        found.append(rolled(first[short], length))
        owner.append(short)
    values, owners = np.concatenate(found), np.concatenate(owner)
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    values, owners = values[new], owners[new]
    return values, np.searchsorted(owners, np.arange(len(n_words) + 1))


def _sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    total = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    return total[begin[1:]] - total[begin[:-1]]


def digests(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that do not depend on the order of a set's members."""
    return _sums(mixed(values, 1), begin), _sums(mixed(values, 2), begin)


def registers(values: np.ndarray, begin: np.ndarray, n: int) -> np.ndarray:
    """``n`` registers of every set; those of an empty set are 0."""
    sizes = np.diff(begin)
    full = np.flatnonzero(sizes > 0)
    out = np.zeros((len(sizes), n), np.uint16)
    if not len(full):
        return out
    starts = begin[:-1][full]
    short = (mixed(values) >> np.uint64(32)).astype(np.uint32)
    least, x, y = np.empty((n, len(full)), np.uint32), np.empty_like(short), np.empty_like(short)
    for k in range(n):
        np.bitwise_xor(short, _XOR[k], out=x)
        np.multiply(x, _ODD[k], out=x)
        np.right_shift(x, np.uint32(16), out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, np.uint32(0x85EBCA6B), out=x)
        least[k] = np.minimum.reduceat(x, starts)
    uniform = (least.T.astype(float) + 0.5) / 2.0**32
    spaced = np.floor(1.0 - np.log(-np.log1p(-uniform) / RATE) / np.log(BASE))
    out[full] = np.clip(spaced, 0, LIMIT).astype(np.uint16)
    return out


def bits(regs: np.ndarray) -> np.ndarray:
    """A hashed bit of each register, 64 to a word; registers beyond the last whole word are left out."""
    n = regs.shape[1] // 64 * 64
    x = (regs[:, :n].astype(np.uint32) ^ _XOR[:n]) * _ODD[:n]
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    return np.packbits((x >> np.uint32(31)).astype(np.uint8), axis=1).view(np.uint64)


def band_keys(regs: np.ndarray, rows: int) -> np.ndarray:
    """A key for every band of ``rows`` registers."""
    n = regs.shape[1] // rows
    parts = regs[:, : n * rows].reshape(len(regs), n, rows).astype(np.uint64)
    return mixed((parts * _WIDE[:rows]).sum(axis=2, dtype=np.uint64) + _WIDE[rows : rows + n])


def most_differing(similarity: float, n: int) -> int:
    """Bits that differ at most between two sets of that similarity, but for a chance of ``SURE`` deviations."""
    p = (1 - similarity) / 2
    return int(n * p + SURE * np.sqrt(n * p * (1 - p)) + 1)


def _log_times(count: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.where(count > 0, count * np.log(np.maximum(p, 1e-300)), 0.0)


def log_likelihood(greater: np.ndarray, less: np.ndarray, n: int, u: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of similarity ``j`` for two sets that have the shares ``u`` and 1 - u of the members of both.

    ``greater`` and ``less`` of ``n`` registers are larger, or smaller, in the first set.
    """
    v = 1 - u

    def part(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)

    a, b = part(u - v * j), part(v - u * j)
    return _log_times(greater, a) + _log_times(less, b) + _log_times(n - greater - less, 1 - a - b)


def joint_similarity(greater: np.ndarray, less: np.ndarray, n: int, u: np.ndarray, steps: int = 40) -> np.ndarray:
    """The similarity of largest likelihood, which has one maximum: thirds are cut off the range."""
    low, high = np.zeros(len(u)), np.minimum(u / (1 - u), (1 - u) / u)
    for _ in range(steps):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        rises = log_likelihood(greater, less, n, u, a) < log_likelihood(greater, less, n, u, b)
        low, high = np.where(rises, a, low), np.where(rises, high, b)
    return (low + high) / 2


def can_be(first: np.ndarray, second: np.ndarray, n_first: np.ndarray, n_second: np.ndarray, similarity: float) -> np.ndarray:
    """Whether pairs of registers may belong to sets of at least that similarity: the likeliest one is as large, or not
    likelier by more than ``SURE`` deviations."""
    greater, less = (first > second).sum(axis=1), (first < second).sum(axis=1)
    u = n_first / (n_first + n_second)
    best = joint_similarity(greater, less, first.shape[1], u)
    top = np.minimum(u / (1 - u), (1 - u) / u)
    asked = np.minimum(similarity, top)
    gap = log_likelihood(greater, less, first.shape[1], u, best) - log_likelihood(greater, less, first.shape[1], u, asked)
    return (best >= asked) | (2 * gap <= SURE**2)
