import math
from collections import Counter

import pytest
import sentencepiece
from cases import SCHEMA, rows, words

from sitrec.llm.fertility import BANDS, Band, quality_rules
from sitrec.llm.piece_counts import Automaton, automaton_tables, byte_level_pieces, piece_counts
from sitrec.llm.word_tokens import tokenizer_path


def figures(text):
    w = words(text)
    n = len(w)
    windows = Counter(tuple(w[i : i + 5]) for i in range(n - 4))
    covered = {j for i in range(n - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            repeated += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = n < 10 or 100 * len(covered) > 20 * n
    return n, sum(map(len, w)), symbols, repeated, len(covered), failed


def test_rules_against_brute_force(spark):
    data = rows() + [(99, "a b c d e f a b c d e f g h i j k l m n o p q r s t\nx\n x\nx\n \n ", "en", "a", 1, True, "k", 1, 0.5, 7, "s", "h")]
    got = quality_rules(spark.createDataFrame(data, SCHEMA)).collect()
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(((r.doc_id, *(r[f] for f in fields)) for r in got), key=str) == sorted(((d, *figures(t)) for d, t, *_ in data), key=str)
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    by_id = {d: t for d, t, *_ in data if d is not None and d != 7}
    for r in got:
        if r.doc_id not in by_id:
            continue
        ids = [i for w in words(by_id[r.doc_id]) for i in model.encode(w)]
        counts = Counter(ids)
        entropy = -sum(c / len(ids) * math.log2(c / len(ids)) for c in counts.values()) if ids else 0.0
        assert r.n_tokens == len(ids)
        assert r.token_entropy == pytest.approx(entropy, abs=1e-9)
        assert r.fallback_share == pytest.approx(sum(map(model.is_byte, ids)) / max(1, len(ids)))
        assert r.kept <= (not r.base_failed)


def test_bands_reject(spark):
    listed = "river stone window yellow garden music paper winter candle mirror bridge forest silver market kitchen"
    plain = " ".join(a + b for a in listed.split() for b in listed.split()[:6])
    docs = spark.createDataFrame([(1, plain), (2, " ".join(a + b for a in "река камень окно сад музыка зима свеча мост лес рынок".split() for b in "ами ого ость ение ать".split()))], "doc_id long, text string")
    got = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert got[1].script == "Latin" and got[2].script == "Cyrillic" and got[1].kept and got[2].kept
    strict = dict(BANDS, Latin=Band(5.0, 8.0, 0.1))
    assert {r.doc_id: r.kept for r in quality_rules(docs, strict).collect()} == {1: False, 2: True}
    noise = dict(BANDS, Latin=Band(0.0, 9.0, 1.0, least_entropy=1.01))
    assert not {r.doc_id: r.kept for r in quality_rules(docs, noise).collect()}[1]


def greedy(word, pieces, longest):
    symbols = list(word.encode())
    symbols[-1] += 256
    at = n = 0
    while at < len(symbols):
        for end in range(min(len(symbols), at + longest), at, -1):
            if tuple(symbols[at:end]) in pieces:
                break
        else:
            return 1
        at, n = end, n + 1
    return n


@pytest.mark.parametrize("small", [True, False])
def test_counts_against_greedy(spark, small):
    data = rows()
    if small:  # not every word can be divided, and failures go back over several pieces
        text = ["a", "b", "ab", "abcd", "bcda", "der", "d", "e", "r ", "er", "de", "the", "t", "h"]
        pieces = {tuple(p.strip().encode()) for p in text} | {(*p.strip().encode()[:-1], p.strip().encode()[-1] + 256) for p in text}
        data = data + [(500, "abcabcdab abcdbcdabab bcdbcda aab derder", "en", "a", 1, True, "k", 1, 0.5, 7, "s", "h")]
    else:
        pieces = set(byte_level_pieces(tokenizer_path()))
    longest = max(map(len, pieces))
    got = piece_counts(spark.createDataFrame(data, SCHEMA), pieces if small else None)
    known = {}

    def counted(text):
        out = 0
        for w in words(text):
            w = "".join(c.lower() if c.isascii() else c for c in w)
            if w not in known:
                known[w] = greedy(w, pieces, longest)
            out += known[w]
        return len(words(text)), out

    assert sorted(map(tuple, got.collect()), key=str) == sorted(((d, *counted(t)) for d, t, *_ in data), key=str)


def test_one_word_equals_many():
    pieces = {(97,), (98,), (97, 98, 99), (353,), (354,), (98, 99, 353)}
    automaton = Automaton(*automaton_tables(pieces))
    assert automaton.count([97, 98, 353]) == 3
    assert automaton.count([97, 98, 99, 353]) == 2
    assert automaton.count([99]) == 1


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert quality_rules(empty).collect() == [] and piece_counts(empty).collect() == []
