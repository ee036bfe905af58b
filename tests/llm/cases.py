"""Small documents with the awkward cases: nulls, empty and long texts, ties, repeats, clashing columns."""

import random
import re

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept boolean, KEEP_ID string, copy int, "
    "score double, _row long, spans string, held_out string"
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(rng, n, words=("the", "of", "Alpha", "beta,", "gamma.", "délta", "x1", "LONGWORD", "it's", "漢字")):
    return " ".join(rng.choice(words) + str(rng.randrange(40)) * (rng.random() < 0.5) for _ in range(n))


def rows(n=40, seed=3):
    rng = random.Random(seed)
    texts = [None, "", " \n\t ", "a", "Hello World", "hello world", "HELLO world", "\nx\n\nx\n", "ß ẞ É é", "one two three"]
    texts += ["<|endoftext|> it's. DON'T?! 12,3 a\x0bb\x0cc", "é́ İ. ǅ, ½.", "😀 😀😀", "Der " * 700, "z" * 3000]
    texts += [sentence(rng, rng.randrange(1, 400)) for _ in range(n)]
    texts += [texts[-1], texts[-2] + " end", texts[-3].upper(), texts[20] + "\n" + texts[21], sentence(rng, 20_000)]
    out = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["a", "a", "b", None])) for i, t in enumerate(texts)]
    out += [out[-1], out[-1], (7, "another text under a used id", "en", "b"), (None, "a row without id", "en", "c")]
    return [(d, t, la, s, None if t is None else len(t), True, "k", 1, 0.5, 7, "s", "h") for d, t, la, s in out]


def words(text):
    return WORD.findall(text or "")
