from __future__ import annotations

import struct
import zlib

from . import brute
import numpy as np
import pytest
from hirelens.llm import pfor
from hirelens.llm.common import vocabulary_path
from hypothesis import given, settings
from hypothesis import strategies as st
from .llm_util import rows_of


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50), st.integers(0, 2**32 - 1)), max_size=700))
def test_round_trip(values):
    ids = np.array(values, np.uint32)
    payload = pfor.encode(ids)
    assert pfor.decode(payload).tolist() == values
    for k in range(-(-len(values) // pfor.BLOCK)):  # one block through the index
        assert pfor.decode(payload, slice(k, k + 1)).tolist() == values[k * pfor.BLOCK : (k + 1) * pfor.BLOCK]


def test_outliers_go_to_the_exception_lists():
    few = np.tile(np.arange(16, dtype=np.uint32), 64)
    wide = few.copy()
    wide[::100] = 2**31
    assert len(pfor.encode(wide)) < len(pfor.encode(few)) + 6 * 11 + 16
    with pytest.raises(ValueError, match="not a segment"):
        pfor.decode(b"nonsense")


@pytest.mark.parametrize("segment", [1 << 18, 50])
def test_odd_rows(spark, odd, scratch_dir, segment):
    pfor.write_token_files(odd, scratch_dir + "/t", segment=segment)
    out = pfor.read_token_files(spark, scratch_dir + "/t").orderBy("start").collect()
    rows = sorted(rows_of(odd), key=lambda r: (r[0] is not None, r[0] or 0))
    want = dict(zip([(r[0], r[1]) for r in rows], brute.token_ids([r[1] for r in rows], vocabulary_path("word_bpe_49k.json"), 2)))
    assert [r["doc_id"] for r in out] == [r[0] for r in rows]
    at = 0
    texts = {}
    for r in out:
        assert r["start"] == at and r["n_tokens"] * 4 == len(r["ids"])
        at += r["n_tokens"]
        texts.setdefault(r["doc_id"], []).append(bytes(r["ids"]))
    for i in texts:
        assert sorted(texts[i]) == sorted(struct.pack(f"<{len(x)}I", *x) for (d, t), x in want.items() if d == i for _ in range(sum((q[0], q[1]) == (d, t) for q in rows)))


def test_empty_table(spark, none, scratch_dir):
    pfor.write_token_files(none, scratch_dir + "/t")
    assert pfor.read_token_files(spark, scratch_dir + "/t").collect() == []


def test_query(spark, small):
    from hirelens.llm.queries import queries
    from .llm_util import SF

    rows = sorted((r["doc_id"], r["text"]) for r in small.select("doc_id", "text").collect())
    ids = brute.token_ids([t for _, t in rows], vocabulary_path("word_bpe_49k.json"), 2)
    want, at = [], 0
    for (i, _), x in zip(rows, ids):
        want.append((i, at, len(x), zlib.crc32(struct.pack(f"<{len(x)}I", *x))))
        at += len(x)
    assert sorted(tuple(r) for r in queries()["op2_pfor_files"](spark, SF).collect()) == want
