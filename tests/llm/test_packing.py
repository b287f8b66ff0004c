from __future__ import annotations

import random
import zlib
from collections import Counter

from . import brute
from hirelens.llm.common import vocabulary_path
from hirelens.llm.nnls_pack import Plan, combinations, pack, sequences, solve
from pyspark.sql import functions as F


def test_combinations_fill_the_window():
    found = combinations(sorted(random.Random(1).sample(range(1, 64), 30)), 64)
    assert found and all(sum(c) == 64 and 1 < len(c) <= 3 for c in found)


def test_solution_meets_a_histogram_that_can_be_met():
    counts = {10: 300, 54: 300, 32: 200}
    x = dict(zip(combinations([10, 32, 54], 64), solve(combinations([10, 32, 54], 64), counts)))
    assert abs(x[10, 54] - 300) < 1 and abs(x[32, 32] - 100) < 1


def _check_plan(counts, window):
    plan, seqs = Plan(counts, 7, window), {}
    for n, c in counts.items():
        for rank in range(c):
            at = 0
            for start, size, seq, offset in plan.place(n, rank):
                assert start == at and size > 0
                at += size
                seqs.setdefault(seq, []).append((offset, size))
            assert at == n
    padding = 0
    for found in seqs.values():
        at = 0
        for offset, size in sorted(found):
            assert offset == at
            at += size
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    assert padding == 0 and min(seqs, default=7) == 7 and len(seqs) == max(seqs, default=6) - 6


def test_plans_place_everything_without_padding():
    rnd = random.Random(2)
    for _ in range(60):
        window = rnd.choice([16, 64, 2048])
        lengths = rnd.sample(range(1, window), rnd.randrange(1, min(window, 40)))
        _check_plan({n: rnd.choice([1, 2, 5, rnd.randrange(1, 400)]) for n in lengths}, window)
    _check_plan({}, 64)
    _check_plan({63: 1000}, 64)


def test_solved_combinations_place_nearly_all():
    """Prose-like lengths: many short rests, all lengths present."""
    rnd = random.Random(3)
    for docs in (2_000, 20_000, 2_000_000):
        share = docs // 2_000
        counts = Counter()
        for _ in range(2_000):
            counts[1 + int(rnd.betavariate(1.2, 2.0) * 2046)] += share
        plan = Plan(dict(counts), 0)
        assert plan.solved * 2048 >= 0.85 * sum(n * c for n, c in counts.items())


def _pieces(df):
    return [tuple(r) for r in df.select("doc_id", "start", "length", F.crc32("ids"), "doc_tokens", "sequence_id", "offset").collect()]


def test_odd_rows(odd):
    rows = odd.select((F.col("row") + 100).alias("doc_id"), "text", "IDS", F.lit(1).alias("offset"))
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    ids = dict(zip(texts, brute.token_ids(list(texts.values()), vocabulary_path("word_bpe_49k.json"), 1)))
    out = pack(rows)
    assert brute.check_pieces(_pieces(out), ids) == 0
    whole = Counter()
    for r in sequences(out).collect():
        assert len(r["ids"]) == 4 * sum(r["lengths"]) <= 4 * 2048
        whole[zlib.crc32(bytes(r["ids"]))] += 1
    assert sum(whole.values()) == out.select("sequence_id").distinct().count()


def test_ranks_by_join_place_alike(small):
    docs = small.limit(200).cache()
    by_join, by_broadcast = pack(docs, broadcast_bytes=-1), pack(docs)
    assert sorted(_pieces(by_join)) == sorted(_pieces(by_broadcast))
    assert "BroadcastHashJoin" in by_broadcast._jdf.queryExecution().executedPlan().toString()


def test_repeated_rows_and_null_ids(odd):
    tokens = pack(odd).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    n = {r["doc_id"]: r["n"] for r in tokens}
    one = n[1]
    assert n[2] == 2 * one and n[None] == one + 1 and n[4] == n[5] == 1


def test_empty_table(none):
    assert pack(none).collect() == []


def test_hot_length(spark):
    rows = [(k, "same words in every text") for k in range(3000)] + [(5000 + k, "word " * (k % 50)) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    ids = dict(zip([r[0] for r in rows], brute.token_ids([r[1] for r in rows], vocabulary_path("word_bpe_49k.json"), 1)))
    assert brute.check_pieces(_pieces(pack(df)), ids) == 0
