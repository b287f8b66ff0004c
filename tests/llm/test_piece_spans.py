from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelens.llm import piece_spans as S
from hirelens.llm.common import vocabulary_path

from .llm_util import SF, got, rows_of

spm = pytest.importorskip("sentencepiece")
PATH = vocabulary_path("piece_bpe_32k.model")
CHARS = list("abc ABC  \t\n.,") + ["▁", " ", "é", "é", "ﬁ", "Ａ", "½", "　", "​", "﻿", "\U0001f600", "你", "가", "ᄀ", "ᅡ", "\0", "­", "…", "㌔", "ﷺ", "<s>", "ß", "İ"]


def model(tmp_path, rule="nmt_nfkc", **spec) -> str:
    """The vocabulary with another normaliser."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m, n = pb.ModelProto(), pb.ModelProto()
    with open(PATH, "rb") as f:
        m.ParseFromString(f.read())
    n.ParseFromString(spm.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    m.normalizer_spec.precompiled_charsmap = n.normalizer_spec.precompiled_charsmap
    for k, v in spec.items():
        setattr(m.normalizer_spec, k, v)
    path = tmp_path / "m.model"
    path.write_bytes(m.SerializeToString())
    return str(path)


def packed(texts):
    raws = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raws), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raws])]).astype(np.int64)


def texts(n=3000):
    rnd = random.Random(0)
    return ["".join(rnd.choices(CHARS, k=rnd.randrange(14))) for _ in range(n)] + ["", " ", "   ", "▁", "▁ ", " ▁", "the the  the", "x" * 300, "ab " * 200]


@pytest.mark.parametrize("spec", [None, {}, {"remove_extra_whitespaces": True}, {"remove_extra_whitespaces": True, "add_dummy_prefix": False}, {"rule": "nfkc_cf", "add_dummy_prefix": False}])
def test_pieces_and_spans_equal_the_library(tmp_path, spec):
    path = PATH if spec is None else model(tmp_path, **spec)
    sp, every = spm.SentencePieceProcessor(model_file=path), texts()
    ids, begins, ends, at = S.Encoder(path).batch(*packed(every))
    out, off = S.Decoder(path).batch(ids, at)
    for i, t in enumerate(every):
        want = [(p.id, p.begin, p.end) for p in sp.encode(t.encode(), return_type="proto").pieces]
        assert list(zip(*(c[at[i] : at[i + 1]].tolist() for c in (ids, begins, ends)))) == want, t
        assert out[off[i] : off[i + 1]].tobytes().decode() == sp.decode([x[0] for x in want]), t


@pytest.mark.parametrize("spec", [None, {"remove_extra_whitespaces": True}])
def test_any_ids_decode_like_the_library(tmp_path, spec):
    path = PATH if spec is None else model(tmp_path, **spec)
    sp, rnd = spm.SentencePieceProcessor(model_file=path), random.Random(1)
    lists = [[rnd.choice([rnd.randrange(32000), rnd.randrange(3, 259), rnd.choice([0, 1, 2, 28705, 259])]) for _ in range(rnd.randrange(9))] for _ in range(4000)]
    out, off = S.Decoder(path).batch(np.array([x for s in lists for x in s]), np.concatenate([[0], np.cumsum([len(s) for s in lists])]).astype(np.int64))
    assert [out[a:b].tobytes().decode() for a, b in zip(off[:-1], off[1:])] == [sp.decode(s) for s in lists]
    with pytest.raises(ValueError):
        S.Decoder(path).batch(np.array([32000]), np.array([0, 1]))


def test_pieces_across_marks_are_merged(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(PATH, "rb") as f:
        m.ParseFromString(f.read())
    for name in ("of▁", "of▁t", "of▁the"):
        m.pieces.add(piece=name, score=-0.5)
    path = tmp_path / "m.model"
    path.write_bytes(m.SerializeToString())
    e, sp = S.Encoder(str(path)), spm.SentencePieceProcessor(model_file=str(path))
    assert e.beside[ord('f'), 0xFF] and not e.beside[ord('q'), 0xFF]
    text = "out of the house of those  of\n"
    assert e.batch(*packed([text]))[0].tolist() == sp.encode(text)


def test_other_models_raise(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(PATH, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.byte_fallback = False
    (tmp_path / "m.model").write_bytes(m.SerializeToString())
    with pytest.raises(ValueError):
        S.Encoder(str(tmp_path / "m.model"))


def _want(text):
    sp = spm.SentencePieceProcessor(model_file=PATH)
    ids = sp.encode(text or "")
    return ids, sp.decode(ids)


def test_odd_rows(spark, odd):
    enc = S.encode_pieces(odd, PATH)
    assert {"row", "kept", "ids", "begins", "ends"} <= set(enc.columns) and "IDS" not in enc.columns
    found = {r["row"]: r for r in S.decode_pieces(enc, PATH).collect()}
    for k, (_, text, *_) in enumerate(rows_of(odd)):
        ids, decoded = _want(text)
        assert (found[k]["ids"], found[k]["decoded"], found[k]["text"]) == (ids, decoded, text)
        raw = (text or "").encode()
        assert b"".join(raw[a:b] for a, b in zip(found[k]["begins"], found[k]["ends"])) == raw
    assert got(S.encode_pieces(odd, PATH, spans=False), "ids") == got(enc, "ids")


def test_null_ids_no_rows_and_bytes_that_are_no_text(spark, none):
    assert got(S.decode_pieces(S.encode_pieces(none, PATH), PATH), "doc_id", "ids", "decoded") == []
    df = spark.createDataFrame([(1, None), (2, []), (3, [22557])], "k long, ids array<int>")
    assert got(S.decode_pieces(df, PATH), "k", "decoded") == [(1, ""), (2, ""), (3, "Hello")]
    df = spark.sql("SELECT cast(x'61ff62' AS string) AS text")
    assert got(S.encode_pieces(df, PATH), "ids") == [(_want("a�b")[0],)]


def test_query_equals_the_library(spark, small):
    from hirelens.llm.queries import queries

    found = {r["doc_id"]: tuple(r)[1:] for r in queries()["op12_piece_spans"](spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "span_bytes").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for r in small.collect():
        ids, decoded = _want(r["text"])
        want[r["doc_id"]] = (len(ids), sha(",".join(map(str, ids))), sha(decoded), len((r["text"] or "").encode()))
    assert found == want
