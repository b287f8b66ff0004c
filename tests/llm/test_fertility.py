from __future__ import annotations

import os
import random

from . import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import numpy as np
from hirelens.llm.fertility import BASE, base_counts, fertility_filter
from .llm_util import got, rows_of


def _counts(texts):
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    out = base_counts(np.frombuffer(b"".join(raw), np.uint8), off)
    return [tuple(int(out[c][k]) for c in BASE) for k in range(len(texts))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t\r#\u00e9\x1c\xa0", max_size=60), max_size=6))
def test_base_counts_match_brute_force(texts):
    texts = [t * 3 for t in texts]
    assert _counts(texts) == [brute.base_rules(t)[:5] for t in texts]


def test_odd_rows(odd):
    out = fertility_filter(odd)
    assert out.columns.count("kept") == 1 and out.count() == odd.count()
    found = {r["row"]: r for r in out.collect()}
    for k, (_, text, *_) in enumerate(rows_of(odd)):
        want = brute.base_rules(text)
        assert tuple(found[k][c] for c in (*BASE, "base_failed")) == want
        if want[5]:
            assert found[k]["kept"] is False
        assert found[k]["text"] == text


def test_empty_table(none):
    assert fertility_filter(none).collect() == []


def test_bands_reject_what_differs_and_keep_the_rest(spark):
    words = "the quick brown fox jumps over the lazy dog and runs back home again before night falls on them".split()
    rows = [(k, " ".join(words[(k * 7 + j * j) % len(words)] for j in range(90)), "en", "s", 0) for k in range(200)]
    rows += [(900 + k, "".join(chr(0x4E00 + (k * 991 + j * 37) % 9000) + (" " if j % 4 == 0 else "") for j in range(160)), "en", "s", 0) for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in fertility_filter(df).where("kept").collect()}
    bad = {r["doc_id"] for r in fertility_filter(df).where("NOT base_failed AND NOT kept").collect()}
    assert not {i for i in bad if i < 900} and not {i for i in kept if i >= 900}


def test_labelled_quality(small, spark):
    from .llm_util import SF

    out = fertility_filter(small).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    clean = out.where("quality = 1 AND NOT base_failed")
    assert clean.where("NOT kept").count() <= 0.02 * clean.count()


def test_labelled_junk_is_rejected_and_clean_text_stays(spark):
    from .llm_util import SF

    sf = SF.replace("0.001", "0.1")
    if not os.path.exists(sf):
        pytest.skip("driver test data not present")
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(16)
    out = fertility_filter(docs, only=["doc_id"]).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("NOT base_failed")
    n = {(r["quality"], r["kept"]): r["count"] for r in out.groupBy("quality", "kept").count().collect()}
    junk, clean = n.get((0, False), 0) + n.get((0, True), 0), n.get((1, False), 0) + n.get((1, True), 0)
    assert junk > 200 and n.get((0, False), 0) >= 0.85 * junk
    assert clean > 2000 and n.get((1, False), 0) <= 0.01 * clean


def test_a_hot_group_of_copies_moves_no_band(spark):
    rng = random.Random(7)
    parts = [a + b for a in "b c d f g l m n p r s t v".split() for b in "a e i o u an er is on ur".split()]
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(900)]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(150, 300))), "en", "s", 0) for k in range(400)]
    rows += [(900 + k, *rows[0][1:]) for k in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    bad = fertility_filter(df, only=["doc_id"]).where("doc_id < 900 AND NOT base_failed AND NOT kept").count()
    assert bad <= 8


def test_thin_classes_are_held_against_their_neighbours(spark):
    """Junk in a language of few documents, and of a length that no other text
    of its language has."""
    rng = random.Random(7)
    parts = [a + b for a in "b c d f g l m n p r s t v".split() for b in "a e i o u an er is on ur".split()]
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(900)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    junk = lambda n: " ".join(f"{rng.choice(words)}%%#{rng.randrange(10**6)}&&" for _ in range(n))
    rows = [(k, prose(rng.randint(100, 300)), "en") for k in range(400)]
    rows += [(900, prose(200), "rare"), (901, junk(200), "rare"), (902, junk(4000), "en"), (903, prose(700), "en"), (904, junk(200), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    kept = {r["doc_id"]: r["kept"] for r in fertility_filter(df, only=["doc_id"]).where("doc_id >= 900").collect()}
    assert kept == {900: True, 901: False, 902: False, 903: True, 904: False}


def test_many_languages_are_joined_without_a_broadcast(spark, small, monkeypatch):
    from hirelens.llm import fertility

    want = got(fertility_filter(small), "doc_id", "kept")
    monkeypatch.setattr(fertility, "BROADCAST_LANGUAGES", 0)
    assert got(fertility_filter(small), "doc_id", "kept") == want


def test_documents_do_not_move_by_language(spark, small):
    plan = fertility_filter(small)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
