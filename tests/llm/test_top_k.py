from __future__ import annotations

import math
import random

from . import brute
import pytest
from hirelens.llm.va_topk import top_k
from pyspark.sql import functions as F


def _found(df, **kw):
    return sorted(tuple(r) for r in top_k(df, **kw).select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 40, "query_rows": 3}])
def test_matches_brute_force(spark, blocks):
    rnd = random.Random(6)
    rows = [(k, [rnd.gauss(0, 0.2) for _ in range(12)]) for k in range(400)]
    rows += [(500 + k, rows[7][1]) for k in range(60)]  # ties
    rows += [(1000, None), (1050, [None] * 12), (1100, [float("nan")] * 12), (1150, [float("inf")] + [0.0] * 11), (1200, [0.5, 0.25]), (1201, [1.0, 1.0]), (1250, []), (None, [0.1] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    assert _found(df, **blocks) == brute.best_vectors(rows)


def test_large_components_are_exact(spark):
    rnd = random.Random(7)
    rows = [(k, [rnd.choice([-1, 1]) * rnd.uniform(1e4, 2e5) for _ in range(4)]) for k in range(101)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert _found(df) == brute.best_vectors(rows)


def test_components_beyond_a_long(spark):
    rnd = random.Random(9)
    rows = [(k, [rnd.choice([1.0, 1e9, 1e17, 1e200, 1e305]) * rnd.uniform(-1, 1) for _ in range(3)]) for k in range(160)]
    scaled = {k: [math.floor(256 * x) for x in v] for k, v in rows}
    want = []
    for k in scaled:
        if k % 50 == 0:
            s = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(scaled[k], v)))), i) for i, v in scaled.items() if i != k)
            want += [(k, r + 1, i, -x) for r, (x, i) in enumerate(s[:5])]
    assert _found(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block_rows=40) == sorted(want)


def test_few_candidates_repeated_rows_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(0, [1.0, 0.5])] * 3 + [(3, [0.25, 0.25]), (4, [0.25, 0.25])]
    assert _found(spark.createDataFrame(rows, schema)) == [(0, 1, 3, 64 * 256 + 64 * 128), (0, 2, 4, 64 * 256 + 64 * 128)]
    assert _found(spark.createDataFrame([], schema)) == []
    assert _found(spark.createDataFrame([(1, [1.0])], schema)) == []


def test_query_matches_sql(spark, small):
    import duckdb

    from hirelens.llm.oracle import oracle_queries
    from hirelens.llm.queries import queries
    from .llm_util import SF

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = sorted(con.execute(f"SELECT query_id, rank, vec_id, score FROM ({oracle_queries()['op10_va_top_k']})").fetchall())
    assert sorted(tuple(r) for r in queries()["op10_va_top_k"](spark, SF).select("query_id", "rank", "vec_id", "score").collect()) == want


def test_bounds_hold_the_exact_scores():
    import numpy as np

    from hirelens.llm.va_topk import CELLS, bounds

    rng = np.random.default_rng(3)
    v, q = np.floor(256 * rng.normal(0, 0.3, (500, 16))), np.floor(256 * rng.normal(0, 0.3, (40, 16)))
    low = v.min(0)
    step = (v.max(0) - low) / CELLS
    lower, upper = bounds(q, np.minimum((v - low) / step, CELLS - 1).astype(np.uint8), low, step)
    exact = q @ v.T
    assert (lower <= exact).all() and (exact <= upper).all()
    # narrow enough to leave few vectors to be read
    least = np.sort(lower, 1)[:, -5]
    assert ((upper >= least[:, None]).sum(1) < 25).all()


def test_a_third_of_the_rows_in_one_vector(spark):
    rnd = random.Random(11)
    hot = [0.9, 0.8, 0.7, 0.1]
    rows = [(k, hot if k % 3 == 0 else [rnd.uniform(-1, 1) for _ in range(4)]) for k in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert _found(df, block_rows=100, query_rows=4) == brute.best_vectors(rows)


def test_copies_of_blocks_do_not_pass_the_driver(spark, monkeypatch):
    """Blocks are multiplied before cells and queries meet, and Spark judges a
    side by its size before that: a broadcast would gather every copy."""
    from hirelens.llm import va_topk

    plans, stored = [], va_topk.stored

    def seen(df, *args):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, *args)

    monkeypatch.setattr(va_topk, "stored", seen)
    rnd = random.Random(12)
    rows = [(k, [rnd.uniform(-1, 1) for _ in range(4)]) for k in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert _found(df, block_rows=20, query_rows=4) == brute.best_vectors(rows)
    (scan,) = [p for p in plans if "MapInArrow" in p and "q_ids" in p]
    assert "Join" in scan and "Broadcast" not in scan
