from __future__ import annotations

import os
import sys

from . import brute
import pytest
from hirelens.llm.common import stored, vocabulary_path
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline as C  # noqa: E402


@pytest.fixture(scope="module")
def stages(spark, odd, small):
    """What each stage returns, on odd and ordinary documents."""
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars").union(small.withColumn("doc_id", F.col("doc_id") + 1000).limit(80))
    out = [stored(docs, "pipeline_input")]
    for _, f in C.STAGES:
        out.append(stored(f(spark, out[-1], ""), "pipeline_stage"))
    return out


def test_stages_return_documents(stages):
    assert len(C.STAGES) == 5
    for df in stages[1:-1]:
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert df.where("n_chars <> length(text)").count() == 0


def test_quality_keeps_what_passes(stages):
    before, after = stages[0].collect(), stages[1].collect()
    assert all(not brute.base_rules(r["text"])[5] for r in after)
    gone = [r for r in before if not brute.base_rules(r["text"])[5]]
    assert len(after) >= 0.9 * len(gone)


def test_one_document_of_each_group_stays(stages):
    before, after = stages[2].collect(), stages[3].collect()
    groups = brute.near_components(list({(r["doc_id"], r["text"]) for r in before if r["doc_id"] is not None}))
    kept = sorted(r["doc_id"] for r in after if r["doc_id"] is not None)
    assert kept == sorted({c for _, c in groups.values()})
    assert sum(r["doc_id"] is None for r in after) == sum(r["doc_id"] is None for r in before)


def test_no_secret_is_left(stages):
    assert sum(len(brute.base_secrets(r["text"])) for r in stages[3].collect()) > 0
    assert all(not brute.base_secrets(r["text"]) for r in stages[4].collect())


def test_packing_holds_every_token(stages):
    docs = stages[4].where("doc_id IS NOT NULL").collect()
    ids = dict(zip([r["doc_id"] for r in docs], brute.token_ids([r["text"] for r in docs], vocabulary_path("word_bpe_49k.json"), 1)))
    rows = stages[5].where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in rows} == {i: len(x) for i, x in ids.items()}


def test_columns_of_any_name_and_type_come_through(spark, small):
    """Names of the operators' results, dots, names that differ in case, maps;
    repeated rows and ids."""
    docs = small.select("doc_id", "text", "lang", "source", "n_chars").limit(30)
    docs = docs.union(docs.limit(4)).union(docs.limit(3).withColumn("text", F.concat("text", F.lit(" x"))))
    names = ["kept", "n_lines", "a.b", "place", "row", "DOC", "KEPT"]
    further = [F.lit("mine"), F.lit(7), F.lit(1.5), F.lit("p"), F.array(F.lit(1)), F.create_map(F.lit("k"), F.lit(None).cast("int")), F.lit(b"x")]
    docs = stored(docs.select("*", *further).toDF(*docs.columns, *[f"f{i}" for i in range(len(names))]), "pipeline_wide").toDF(*docs.columns, *names)
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        rows = out.collect()
        assert rows and all(tuple(r)[5:] == ("mine", 7, 1.5, "p", [1], {"k": None}, b"x") for r in rows), name
        assert name != "near-duplicates" or len({r[0] for r in rows}) == len(rows)
    assert C.STAGES[-1][1](spark, docs, "").count() > 0


def test_empty_table(spark, none):
    docs = none
    for _, f in C.STAGES:
        docs = stored(f(spark, docs, ""), "pipeline_empty")
        assert docs.count() == 0
