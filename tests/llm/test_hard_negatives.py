from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelens.llm import hilbert_negatives as H

from .llm_util import SF, got

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, positives=5, negatives=3, low=50, high=95, every=50) -> list[tuple]:
    use = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in v):
            use.append((i, [math.floor(256 * x) for x in v], label))
    out = []
    for a, (anchor, q, label) in enumerate(use):
        if anchor % every:
            continue
        s = [(max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(q, v)))), i, k) for b, (i, v, k) in enumerate(use) if b != a and len(v) == len(q)]
        s.sort(key=lambda x: (-x[0], x[1]))
        for p, pid, _ in [x for x in s if x[2] == label][:positives]:
            fits = [x for x in s if x[2] != label and low * p <= 100 * x[0] <= high * p][:negatives]
            out += [(anchor, pid, r + 1, n, p, x) for r, (x, n, _) in enumerate(fits)]
    return sorted(out, key=repr)


def clusters(rnd, n=420, dim=6):
    centres = [[rnd.gauss(0, 0.6) for _ in range(dim)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = rnd.randrange(6)
        rows.append((i * 5, [x + rnd.gauss(0, 0.15) for x in centres[c]], rnd.choice([c, c, c, rnd.randrange(8)])))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 13, "group": 4}])
def test_matches_brute_force(spark, sizes):
    rnd = random.Random(3)
    rows = clusters(rnd)
    rows += [(10_000 + k, rows[7][1], 9) for k in range(40)] + [(20_000 + k, rows[7][1], rows[7][2]) for k in range(40)]  # ties
    rows += [(i, v, k) for i, v, k in rows[20:40]] + [rows[50]] * 3  # repeated rows, anchors among them
    rows += [(30_000, None, 1), (30_050, [0.1] * 6, None), (30_100, [None] * 6, 1), (30_150, [float("nan")] * 6, 1), (30_200, [float("inf")] * 6, 2), (None, [0.2] * 6, 1), (30_250, [], 1), (30_251, [], 1), (30_252, [], 2)]
    rows += [(30_300 + k, [rnd.random(), rnd.random()], k % 2) for k in range(30)] + [(40_000, [0.0] * 6, 3), (40_001, [0.0] * 6, 3), (40_002, [-1.0] * 6, 3)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"block": F.lit("clash"), "a.b": F.lit(1)})
    want = brute(rows)
    assert got(H.hard_negatives(df, **sizes), *"anchor_id positive_id rank negative_id positive_score negative_score".split()) == want
    assert len(want) > 300
    kw = {"positives": 2, "negatives": 7, "low": 20, "high": 100}
    assert got(H.hard_negatives(df, **sizes, **kw)) == brute(rows, **kw)


def test_huge_components(spark):
    rnd = random.Random(5)
    rows = [(k, [rnd.choice([1, 1e3, 1e9, 1e17, 1e200, 1e306]) * rnd.uniform(-0.1, 1) for _ in range(3)], k % 3) for k in range(120)]
    rows += [(200 + k, [rnd.uniform(2e5, 3e5) for _ in range(3)], k % 2) for k in range(120)]
    assert got(H.hard_negatives(spark.createDataFrame(rows, SCHEMA), every=10)) == brute(rows, every=10)


def test_no_rows_and_lone_rows(spark):
    assert got(H.hard_negatives(spark.createDataFrame([], SCHEMA))) == []
    assert got(H.hard_negatives(spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 2)], SCHEMA))) == []
    rows = [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2)]
    assert got(H.hard_negatives(spark.createDataFrame(rows, SCHEMA))) == brute(rows) == [(0, 1, 1, 2, 65536, 32768)]


def test_neighbours_on_the_curve_touch():
    for dim, bits in ((2, 4), (3, 3), (4, 2), (5, 1)):
        cells = np.stack(np.meshgrid(*[np.arange(2**bits)] * dim, indexing="ij"), -1).reshape(-1, dim)
        keys = [k.tobytes() for k in H.hilbert_keys(cells, bits)]
        assert len(set(keys)) == len(cells)
        walk = cells[sorted(range(len(cells)), key=keys.__getitem__)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_bounds_hold_and_rule_out_blocks(spark):
    rnd = random.Random(8)
    rng = np.random.default_rng(2)
    v, q = rng.normal(0, 40, (50, 8)).round(), rng.normal(0, 40, (9, 8)).round()
    least, most = H.bounds(q, v.min(0)[None], v.max(0)[None])
    s = H.products(q, v)
    assert (least[:, 0] <= s.min(1)).all() and (s.max(1) <= most[:, 0]).all()
    rows = spark.createDataFrame(clusters(rnd, 3000, 3), SCHEMA).selectExpr("vec_id AS id", "cast(label AS long) AS label", "transform(embedding, x -> cast(floor(256 * x) AS double)) AS v", "3 AS dim")
    blocks = H.hilbert_blocks(rows, 3000, 64)
    z = blocks.select("low", "high", "rows").collect()
    assert sum(r["rows"] for r in z) == 3000 and max(r["rows"] for r in z) <= 64
    low, high = (np.stack([np.frombuffer(r[c], "<f8") for r in z]) for c in ("low", "high"))
    q = np.array([r["v"] for r in rows.where("id % 250 = 0").collect()])
    s = H.products(q, np.array([r["v"] for r in rows.collect()]))
    best = np.sort(s, 1)[:, -6]
    needed = (H.bounds(q, low, high)[1] >= best[:, None]).mean()
    assert needed < 0.5  # clustered vectors of few dimensions


def test_query_matches_sql(spark, small):
    import duckdb

    from hirelens.llm.oracle import oracle_queries
    from hirelens.llm.queries import queries

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    cols = "anchor_id positive_id rank negative_id positive_score negative_score".split()
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({oracle_queries()['op11_hilbert_negatives']})").fetchall()
    assert got(queries()["op11_hilbert_negatives"](spark, SF), *cols) == sorted(want, key=repr)
