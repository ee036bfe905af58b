import hashlib
import re

import pytest
from cases import SCHEMA, rows

from sitrec.llm.exact_dedup import exact_dedup, filter_bits

UPPER = re.compile("[A-Z]")


def lowered(text):
    return UPPER.sub(lambda m: m[0].lower(), text or "")


def expected(data):
    groups = {}
    for d, t, *_ in data:
        groups.setdefault(lowered(t), []).append(d)
    out = []
    for d, t, *_ in data:
        ids = groups[lowered(t)]
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out.append((d, keep, len(ids), hashlib.sha256(lowered(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [1 << 6, 1 << 26])  # a filter that is full, and one that is not
@pytest.mark.parametrize("share", [0.0, 1.0])  # all groups broadcast, and none
def test_against_brute_force(spark, bits, share):
    data = rows()
    got = exact_dedup(spark.createDataFrame(data, SCHEMA), most_bits=bits, hot_share=share)
    found = got.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == expected(data)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.text_sha256 for r in found})  # one row of each group, repeated rows included
    assert all(r.doc_id == r.keep_id for r in kept)


def test_other_columns_pass_and_clashing_ones_are_replaced(spark):
    got = exact_dedup(spark.createDataFrame(rows(), SCHEMA))
    assert [c for c in got.columns if c.lower() == "kept"] == ["kept"]
    assert [c for c in got.columns if c.lower() == "keep_id"] == ["keep_id"]
    assert {"lang", "source", "n_chars", "copy"} <= set(got.columns)


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_native(spark, capsys):
    exact_dedup(spark.createDataFrame(rows(), SCHEMA)).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_filter_size():
    assert filter_bits(0) == 1 << 16
    assert filter_bits(10**12) == 1 << 26
