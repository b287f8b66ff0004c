from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hirelens.llm import divergence as D

from .llm_util import SF, got

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
COLS = ("lang", "source", "part", "item", "value", "rank")


def brute(rows, min_docs=10, top=10) -> list[tuple]:
    """rows: (text, lang, source)"""
    rows = [tuple(x or "" for x in r) for r in rows]
    seen, count = {}, {}
    for text, lang, source in rows:
        c = Counter(t.translate(LOWER) for t in TERM.findall(text))
        count.setdefault((lang, source), Counter()).update(c)
        seen.setdefault(lang, Counter()).update(c.keys())
    out = []
    for lang, docs in seen.items():
        kept = [t for t, n in docs.items() if n >= min_docs]
        v = len(kept)
        own = {s: {t: c[t] for t in kept} for (g, s), c in count.items() if g == lang}
        weigh = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * v) for t in kept}
        p = {s: weigh(c) for s, c in own.items()}
        q = weigh({t: sum(c[t] for c in own.values()) for t in kept})
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in own:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in own if o != s)
            out += [(lang, s, "pair", o, -x, k + 1) for k, (x, _, o) in enumerate(pairs)]
            terms = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept if own[s][t] and p[s][t] > q[t])
            out += [(lang, s, "term", t, -x, k + 1) for k, (x, _, t) in enumerate(terms[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [{}, {"TERM_ROWS": 40, "SOURCE_BLOCK": 3}])
def test_matches_brute_force(spark, monkeypatch, size):
    for k, v in size.items():
        monkeypatch.setattr(D, k, v)
    rnd = random.Random(4)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(150)] + ["Été", "ÉTÉ", "naïve", "你好", "😀", "ß"]
    rows = [(" ".join(rnd.choices(words, k=rnd.randint(0, 25))) + rnd.choice(["", ".", "\n", " 42-The THE the"]), rnd.choice(["en", "de", None]), f"s{min(rnd.randint(0, 11), rnd.randint(0, 11))}") for _ in range(250)]
    rows += [(None, "en", "silent"), ("", "en", None), ("alone in its language", "xx", "only"), ("a b", "few", "p"), ("a c", "few", "q"), (None, None, None)]
    rows += [("tied words stand here " * 3, "en", "s1")] * 12
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumns({"term": F.lit(1), "VALUE": F.lit("clash"), "a.b": F.lit(0)})
    for kw in ({}, {"min_docs": 3, "top": 4}):
        assert got(D.divergence(df, **kw), *COLS) == brute(rows, **kw)


def test_odd_rows(spark, odd):
    rows = [(r["text"], r["lang"], r["source"]) for r in odd.collect()]
    assert got(D.divergence(odd, min_docs=2), *COLS) == brute(rows, min_docs=2)


def test_no_rows_and_no_kept_terms(spark, none):
    assert got(D.divergence(none), *COLS) == []
    df = spark.createDataFrame([("one two", "en", s) for s in "abc"], "text string, lang string, source string")
    assert got(D.divergence(df), *COLS) == brute([("one two", "en", s) for s in "abc"])
    assert [r[4] for r in got(D.divergence(df), *COLS)] == [0] * 6


def test_terms_cut_at_the_ends_of_texts():
    import numpy as np

    words, doc = D._terms(np.frombuffer(b"abCd ef", np.uint8), np.array([0, 0, 2, 2, 4, 7, 7]))
    assert (words.to_pylist(), doc.tolist()) == ([b"ab", b"cd", b"ef"], [1, 3, 4])


def test_weights_are_exact_beyond_a_long(spark):
    n = 8 * 10**18
    df = spark.createDataFrame([(n, n + 10**17, 10**9)], "c long, n long, v long")
    assert df.select(D._weight(F.col("c"), F.col("n"), F.col("v")).alias("p")).head()[0] == 1 + 10**9 * (n + 2) // (n + 10**17 + 2 * 10**9)


def test_query_matches_sql(spark, small):
    import duckdb

    from hirelens.llm.oracle import oracle_queries
    from hirelens.llm.queries import queries

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(f"SELECT {', '.join(COLS)} FROM ({oracle_queries()['op13_source_divergence']})").fetchall()
    assert got(queries()["op13_source_divergence"](spark, SF), *COLS) == sorted(want, key=repr)
