import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import SCHEMA, rows
from tokenizers import Tokenizer

from sitrec.llm.packing import best_two_fit, pack_documents
from sitrec.llm.token_files import sequence, token_files, write_token_files
from sitrec.llm.word_tokens import WordEncoder, byte_slices, text_array, tokenizer_path


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("remember", [60, 400_000])  # a memory that is emptied again and again, and one that is not
def test_encoder_equals_the_library(reference, remember):
    texts = [r[1] for r in rows()]
    encoder = WordEncoder(tokenizer_path(), remember)
    for begin, part in byte_slices(text_array(pa.array(texts)), 2000):
        ids, offsets = encoder.encode(part, 5)
        for i in range(len(part)):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == reference(texts[begin + i]) + [5]


@pytest.mark.parametrize("capacity", [4096, 7])
def test_packing(spark, reference, capacity):
    data = rows()
    got = pack_documents(spark.createDataFrame(data, SCHEMA), capacity, with_ids=True).collect()
    want = []
    for d, t, *_ in data:
        ids = reference(t) + [1]
        cuts = [ids[k : k + capacity] for k in range(0, len(ids), capacity)]
        want += [(d, k, k * capacity, len(c), crc(c), c) for k, c in enumerate(cuts)]
    assert sorted((tuple(r)[:5] + (r.ids,) for r in got), key=str) == sorted(want, key=str)
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for content in places.values():
        end = 0
        for offset, length in sorted(content):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(places) <= 1.1 * sum(w[3] for w in want) / capacity + 1


def test_best_two_fit_exchanges():
    # 5 + 3 leaves 2; the two pieces 3 + 2 fill what 3 and the gap leave
    lengths = np.array([5, 4, 4, 2, 1])
    bins, offsets = best_two_fit(lengths, 10)
    loads = np.bincount(bins, weights=lengths)
    assert loads[0] == 10 and loads.sum() == 16 and len(loads) == 2
    rng = np.random.default_rng(0)
    for _ in range(30):
        lengths = rng.integers(0, 30, rng.integers(0, 80))
        bins, offsets = best_two_fit(lengths, 32)
        assert len(bins) == len(lengths)
        if len(lengths):
            loads = np.bincount(bins, weights=lengths)
            assert loads.max() <= 32 and len(loads) <= max(1, 11 / 9 * -(-lengths.sum() // 32) + 1)
        for b in set(bins.tolist()):
            inside = sorted(zip(offsets[bins == b].tolist(), lengths[bins == b].tolist()))
            assert [o for o, _ in inside] == np.cumsum([0] + [x for _, x in inside])[:-1].tolist()


def test_token_files(spark, reference, tmp_path):
    data = [r for r in rows() if r[0] is not None]
    docs = spark.createDataFrame(data, SCHEMA).repartition(3)
    got = token_files(docs, f"file://{tmp_path}/a", length=16)
    ids = [(d, reference(t) + [2]) for d, t, *_ in data]
    found = sorted(map(tuple, got.collect()))
    assert sorted((d, len(x), crc(x)) for d, x in ids) == sorted((d, n, c) for d, _, n, c in found)
    assert [d for d, _, _, _ in sorted(found, key=lambda r: r[1])] == sorted(d for d, *_ in data)
    by_start = sorted(found, key=lambda r: r[1])
    assert [s for _, s, _, _ in by_start] == np.cumsum([0] + [n for _, _, n, _ in by_start])[:-1].tolist()


def test_random_access(spark, reference, tmp_path):
    docs = spark.createDataFrame([(1, "one two three " * 50)], "doc_id long, text string")
    shard = write_token_files(docs, str(tmp_path / "b"), length=8).first()
    whole = reference("one two three " * 50) + [2]
    ids, mask = sequence(shard.path, 3)
    assert ids.tolist() == whole[24:32] and all(mask.to_pylist())
    ids, mask = sequence(shard.path, len(whole) // 8)
    assert ids.tolist()[: len(whole) % 8] == whole[len(whole) // 8 * 8 :] and sum(mask.to_pylist()) == len(whole) % 8


def test_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert pack_documents(empty).collect() == []
    assert token_files(empty, str(tmp_path / "c")).collect() == []
