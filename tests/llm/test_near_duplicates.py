from __future__ import annotations

import random

from . import brute
import numpy as np
from hirelens.llm.bayes_minhash import components, least_matches, near_duplicates, survivors
from .llm_util import got, rows_of


def test_odd_rows(odd):
    out = got(near_duplicates(odd), "doc_id", "n_shingles", "component_id", "kept")
    rows = rows_of(odd)
    want = brute.near_components(list({(i, t) for i, t, *_ in rows if i is not None}))
    expected = [(i, *want[i], want[i][1] == i) if i is not None else (None, len(brute.shingles(t)), None, True) for i, t, *_ in rows]
    assert out == sorted(expected, key=repr)


def test_empty_table(none):
    assert near_duplicates(none).collect() == []


def test_chains_and_shared_passages(spark):
    """Chains in which only neighbours are similar enough, texts around the
    threshold, a passage that many share, and small blocks."""
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    passage = [word() for _ in range(60)]
    rows, base = [], [word() for _ in range(120)]
    for k in range(60):  # a chain: each drifts from the one before
        rows.append((k, " ".join(base)))
        base = base[3:] + [word() for _ in range(3)]
    star = [word() for _ in range(90)]
    for k in range(60):  # copies with random edits, near the threshold
        own = list(star)
        for _ in range(rnd.randrange(0, 5)):
            own[rnd.randrange(len(own))] = word()
        rows.append((100 + k, " ".join(own)))
    rows += [(200 + k, " ".join(passage + [word() for _ in range(rnd.randrange(10, 60))])) for k in range(40)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df, block=8).collect()}
    assert out == brute.near_components(rows)


def test_a_row_and_its_id_are_one_vertex(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    df = spark.createDataFrame([(5, a), (5, b), (7, a), (8, b), (9, "c d e f g h")], "doc_id long, text string")
    assert [r[1] for r in got(near_duplicates(df), "doc_id", "component_id")] == [5, 5, 5, 5, 9]


def test_components(spark):
    rnd = random.Random(1)
    edges = [(k, k + 1) for k in range(0, 40)] + [tuple(sorted(rnd.sample(range(100, 160), 2))) for _ in range(50)]
    up = {n: n for e in edges for n in e}
    for _ in range(len(up)):
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    assert dict(got(components(spark.createDataFrame(edges, "lo long, hi long")), "node", "comp")) == up


def test_pruning_keeps_what_is_similar():
    least = least_matches(1e-5)
    rng = np.random.default_rng(0)
    n = 20000
    same = rng.random((n, 128)) < 0.75
    a = rng.integers(0, 256, (n, 128), dtype=np.uint8)
    b = np.where(same, a, a ^ rng.integers(1, 256, (n, 128), dtype=np.uint8))
    assert len(survivors(a, b, least)[0]) >= n - 20
    far = np.where(rng.random((n, 128)) < 0.4, a, a ^ np.uint8(1))
    assert len(survivors(a, far, least)[0]) <= 0.02 * n
