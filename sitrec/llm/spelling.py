"""Spelling variants of a corpus's words: one edit away and much rarer than the form they belong to."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitrec.llm.columns import ascii_lower, quoted
from sitrec.llm.count_trie import GROUPS, CountTrie, letter_counts
from sitrec.storage import written

# fixed values: the letters of a word (U+00C0 to U+00FF beside ASCII), and how often and where one is left out
LETTERS = "[A-Za-zÀ-ÿ]"
EVERY = 199
TOP = 5  # groups whose counts tell which tasks a word goes to
BITS = 12  # of a count in that key; counts beyond wrap around, and the words are told apart when compared
WORDS, ASKING = 1 << 13, 1 << 15  # words of a place of the trie, and words that ask there, that a task takes together
HOT = 1 << 16  # places that can have more


def vocabulary(
    docs: DataFrame, least_length: int = 6, least_count: int = 5, every: int = EVERY, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``word, n``: words of at least ``least_length`` letters with at least ``least_count`` occurrences.

    Words are maximal runs of letters, A-Z in lower case; ``every`` sets which of them lose a letter (0: none).
    Each task sums up its own occurrences before they shuffle.
    """
    runs = F.regexp_extract_all(quoted(text).cast("string"), F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0))
    rows = docs.select(quoted(doc_id).alias("id"), F.explode(runs).alias("run")).withColumn("run", ascii_lower(F.col("run")))
    word = F.col("run")
    if every:
        hashed = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
        rows = rows.select("run", F.crc32(hashed.cast("binary")).alias("h")).withColumn("cut", F.col("h") % every == 0)
        rows = rows.where(~F.col("cut") | (F.char_length("run") > least_length))
        size = F.char_length("run")
        at = (F.col("h") % size).cast("int")
        word = F.when(
            F.col("cut"), F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, size))
        ).otherwise(F.col("run"))
    counts = rows.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least_count)


def _coded(words: pa.Array) -> list[bytes]:
    """Words in Latin-1: all their letters have a byte of their own there."""
    return [w.encode("latin-1") for w in words.to_pylist()]


def _count_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n`` and the counts of all letter groups."""
    names = ["word", "n", *(f"c{g}" for g in range(GROUPS))]
    for batch in batches:
        counts = letter_counts(_coded(batch.column(0)))
        columns = [pa.array(np.ascontiguousarray(counts[:, g], np.int32)) for g in range(GROUPS)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=names)


def _fields(counts: np.ndarray) -> np.ndarray:
    return (counts & ((1 << BITS) - 1)) << (BITS * np.arange(counts.shape[1]))


def _probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places at the top of the trie that each word asks at, and what is left of its surplus and deficit.

    Of two places each asks in one only: the word at the lesser asks at the greater.
    """
    for batch in batches:
        counts = np.column_stack([batch.column(2 + i).to_numpy().astype(np.int64) for i in range(TOP)])
        own = _fields(counts)
        key = own.sum(axis=1)
        up, down = _fields(counts + 1) - own, np.where(counts > 0, _fields(counts - 1) - own, 0)
        every = np.arange(len(key))
        found = [(every, key, 1, 1)]
        for i in range(TOP):
            found += [(every, key + up[:, i], 0, 1), (every[counts[:, i] > 0], (key + down[:, i])[counts[:, i] > 0], 1, 0)]
            for j in range(TOP):
                able = np.flatnonzero(counts[:, j] > 0)
                if i != j:
                    found.append((able, (key + up[:, i] + down[:, j])[able], 0, 0))
        for k, (rows, place, surplus, deficit) in enumerate(found):
            if k:
                rows, place = rows[place > key[rows]], place[place > key[rows]]
            n = len(rows)
            columns = [batch.column(c).take(pa.array(rows)) for c in (0, 1)]
            columns += [pa.array(np.full(n, v, np.int32)) for v in (surplus, deficit)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(place), *columns, pa.array(np.full(n, k == 0))], names=["key", "word", "n", "s", "d", "same"]
            )


def _parts(rows: DataFrame, name: str, most: int) -> DataFrame:
    """Keys with more than ``most`` rows and how many parts they are divided into; ``HOT`` of them at most."""
    counts = written(rows.groupBy("key").agg(F.count("*").alias("n")), "places")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    limit = max(most, total // HOT)
    return counts.where(F.col("n") > limit).select("key", F.ceil(F.col("n") / limit).cast("int").alias(name))


def _dealt(rows: DataFrame, own: str, other: str, parts: DataFrame) -> DataFrame:
    """Rows in a part of their key's ``own`` parts, copied to all of the ``other`` ones."""
    with_parts = rows.join(F.broadcast(parts), "key", "left")
    mine = F.pmod(F.xxhash64("word"), F.coalesce(own, F.lit(1))).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
    return with_parts.select("*", mine.alias(f"{own}_part")).select(*rows.columns, f"{own}_part", copies.alias(f"{other}_part"))


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, na, b, nb``: every pair of words, once, that differ by exactly one inserted, deleted or replaced letter.

    ``words`` has distinct ``word`` and ``n``.  The counts of the first letter groups, those that vary most, are a
    word's place at the top of the trie.  A place's words meet the words that ask there in one task, where the rest
    of the trie is built and searched.  Places with many words or many that ask are divided on both sides.
    """
    counts = ", ".join(f"c{g} int" for g in range(GROUPS))
    counted = written(words.select("word", "n").mapInArrow(_count_groups, f"word string, n long, {counts}"), "counts")
    varied = counted.agg(*(F.coalesce(F.var_pop(f"c{g}"), F.lit(0.0)).alias(str(g)) for g in range(GROUPS))).first()
    order = sorted(range(GROUPS), key=lambda g: (-varied[g], g))
    top, rest = order[:TOP], order[TOP:]
    tops = [f"c{g}" for g in top]
    mask = (1 << BITS) - 1
    key = sum((F.shiftleft(F.col(c).cast("long").bitwiseAND(mask), BITS * i) for i, c in enumerate(tops)), F.lit(0).cast("long"))
    held = counted.select(key.alias("key"), "word", "n")
    asking = counted.select("word", "n", *tops).mapInArrow(_probes, "key long, word string, n long, s int, d int, same boolean")
    parts = _parts(held, "w", WORDS).join(_parts(asking, "q", ASKING), "key", "full")
    parts = written(parts, "parts")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("s", "int"), ("d", "int"), ("same", "boolean"))]
    both = _dealt(asking, "q", "w", parts).unionByName(_dealt(held.select("*", *none), "w", "q", parts))

    def search(place: pa.Table) -> pa.Table:
        is_word = place["same"].is_null()
        held, asking = place.filter(is_word), place.filter(place["same"].is_valid())
        found: list[tuple[np.ndarray, np.ndarray]] = []
        if held.num_rows and asking.num_rows:
            known, asked = (_coded(t["word"]) for t in (held, asking))
            same = asking["same"].to_numpy()
            budget = [asking[c].to_numpy() for c in ("s", "d")]
            for a, b in CountTrie(known, rest).one_edit_away(asked, *budget):
                # words of one place ask each other: one of the two answers counts
                once = np.fromiter((not same[i] or asked[i] < known[j] for i, j in zip(a, b)), bool, len(a))
                found.append((a[once], b[once]))
        a, b = (np.concatenate([f[k] for f in found] or [np.empty(0, np.int64)]) for k in (0, 1))
        columns = [t[c].take(pa.array(at)) for t, at in ((asking, a), (held, b)) for c in ("word", "n")]
        return pa.table(columns, names=["a", "na", "b", "nb"])

    return both.groupBy("key", "w_part", "q_part").applyInArrow(search, "a string, na long, b string, nb long")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` by doubling steps: a form is at least ``ratio`` times as frequent as its word, so chains are short."""
    steps = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = steps.join(onward.hint("merge"), "root", "left")
        new = written(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if new.where("moved").isEmpty():
            return new.select("word", "root")
        steps = new.select("word", "root")


def spelling_forms(
    docs: DataFrame,
    least_length: int = 6,
    least_count: int = 5,
    ratio: int = 5,
    every: int = EVERY,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the vocabulary of ``docs``.

    Words are maximal runs of ASCII letters and U+00C0 to U+00FF, A-Z in lower case; where ``every`` divides the
    crc32 h of ``<doc_id>:<run>``, the letter at h modulo the length is left out first.  Distinct words of
    ``least_length`` letters and ``least_count`` occurrences count.  Words are near if they differ by exactly
    one inserted, deleted or replaced letter; ``form`` is the near word with the largest n (equal ones: the first in
    code-point order) if that is at least ``ratio`` times the word's, ``root`` the last of the forms that follow.

    A null text has no words, a null id counts as empty, rows that repeat an id or are equal count each, other
    columns do not matter, and an empty table gives no rows.  ``ratio`` must be more than 1, or forms could go round.

    Texts do not move; a task's occurrences are summed up before they shuffle, and all that follows is of the
    size of the vocabulary.  A word has a bounded number of near words, so none is a hot key.
    """
    if ratio <= 1:
        raise ValueError("ratio must be more than 1")
    words = written(vocabulary(docs, least_length, least_count, every, text, doc_id), "words")
    pairs = written(near_pairs(words), "pairs")
    one = pairs.select(F.col("a").alias("word"), F.col("na").alias("n"), F.col("b").alias("near"), F.col("nb").alias("m"))
    other = pairs.select(F.col("b").alias("word"), F.col("nb").alias("n"), F.col("a").alias("near"), F.col("na").alias("m"))
    best = F.min(F.struct((-F.col("m")).alias("m"), F.col("near").alias("form"))).alias("best")
    facts = one.unionByName(other).groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
    is_form = -F.col("best.m") >= ratio * F.col("n")
    facts = facts.select(
        "word", "n_near", F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, -F.col("best.m")).alias("form_n")
    )
    facts = written(facts, "forms")
    out = words.join(facts.hint("merge"), "word", "left").join(_roots(facts.where("form is not null")).hint("merge"), "word", "left")
    return out.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )
