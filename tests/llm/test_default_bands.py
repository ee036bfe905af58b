"""The default band of Latin text rejects what is no text and keeps clean documents."""

import base64
import random

import pyarrow as pa
import pyarrow.parquet as pq

from sitrec.llm.fertility import BANDS, LEAST_TOKENS, PIECES_FILE, PieceStore, measured, verdicts
from sitrec.llm.word_tokens import tokenizer_path


def judged(texts):
    return verdicts(measured(pa.array(texts), PieceStore(tokenizer_path(PIECES_FILE))), BANDS, LEAST_TOKENS)


def test_noise_is_rejected():
    rng = random.Random(1)
    raw = rng.randbytes(1500)
    hexed, coded = raw.hex(), base64.b64encode(raw).decode()

    def noise(letters, least, most):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(least, most))) for _ in range(300))

    texts = [
        " ".join(hexed[i : i + 40] for i in range(0, 3000, 40)),
        " ".join(coded[i : i + 60] for i in range(0, 2000, 60)),
        noise("bcdfghjklmnpqrstvwxz", 3, 9),
        noise("asdfghjklqwertyuiop", 3, 9),
        noise("abcdefghijklmnopqrstuvwxyz", 1, 1),
        noise("абвгдежзиклмнопрстуфхцчшщ", 3, 9).encode().decode("latin-1").replace("\x85", ""),
    ]
    failed, kept = judged(texts)
    assert not failed.any() and not kept.any()


def test_clean_documents_stay(sf_dir):
    good = {r["doc_id"] for r in pq.read_table(f"{sf_dir}/labels.parquet").to_pylist() if r["quality"] == 1}
    docs = pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()
    failed, kept = judged([r["text"] or "" for r in docs if r["doc_id"] in good])
    assert (~failed).sum() > 50 and kept.sum() >= 0.99 * (~failed).sum()
