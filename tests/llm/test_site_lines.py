from __future__ import annotations

from collections import Counter

import pytest
from hirelens.llm.site_lines import BROADCAST_BYTES, drop_boilerplate
from .llm_util import rows_of


def _expected(rows, max_ratio, min_pages):
    cut = lambda t: t.split("\n")
    trim = lambda x: x.strip(" \t\r")
    pages = Counter(s for _, _, _, s, _ in rows)
    seen = Counter((s, k) for _, t, _, s, _ in rows if t is not None for k in {trim(x) for x in cut(t)} if k)
    bad = {k for k, n in seen.items() if n >= min_pages and n > max_ratio * pages[k[0]]}
    out = []
    for _, t, _, s, _ in rows:
        if t is None:
            out.append((None, 0, 0))
            continue
        keep = [x for x in cut(t) if (s, trim(x)) not in bad]
        out.append(("\n".join(keep), len(cut(t)), len(cut(t)) - len(keep)))
    return out


@pytest.mark.parametrize("broadcast_bytes", [BROADCAST_BYTES, -1])
@pytest.mark.parametrize("max_ratio,min_pages", [(0.05, 5), (0.3, 2), (0.0, 1)])
def test_odd_rows(odd, max_ratio, min_pages, broadcast_bytes):
    out = drop_boilerplate(odd, max_ratio=max_ratio, min_pages=min_pages, broadcast_bytes=broadcast_bytes)
    found = [(r["text"], r["n_lines"], r["n_dropped"]) for r in out.orderBy("row").collect()]
    assert found == _expected(rows_of(odd), max_ratio, min_pages)


def test_empty_table(none):
    assert drop_boilerplate(none).collect() == []


def test_hot_line_and_host(spark):
    rows = [(k, f"menu\nown line {k}\n  menu \r\n", "en", "hot" if k % 3 else "cold", 0) for k in range(300)]
    rows += [(1000 + k, f"only here {k}", "en", "cold", 0) for k in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r["doc_id"]: r for r in drop_boilerplate(df).where("doc_id < 1000").collect()}
    # two of three pages of one host carry it; a fiftieth of the other's
    assert all(out[k]["n_dropped"] == (2 if k % 3 else 0) for k in range(300))
    assert out[1]["text"] == "own line 1\n"


@pytest.mark.parametrize("broadcast_bytes", [BROADCAST_BYTES, -1])
def test_matches_sql(spark, small, broadcast_bytes):
    import duckdb

    from hirelens.llm.oracle import OP1
    from .llm_util import SF

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cols = ["doc_id", "source", "text", "n_lines", "n_dropped"]
    want = sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({OP1})").fetchall(), key=repr)
    found = sorted((tuple(r) for r in drop_boilerplate(small, broadcast_bytes=broadcast_bytes).select(*cols).collect()), key=repr)
    assert found == want


def test_clashing_names_and_copies(spark):
    from pyspark.sql import functions as F

    rows = [(k, "menu\nsame page", "en", "hot", 0) for k in range(500)] + [(k, f"page {k}\nmenu", "en", "hot", 0) for k in range(500, 700)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df = df.withColumns({"N_LINES": F.lit("x"), "drops": F.lit(1), "host": F.lit("y"), "part": F.lit(2), "a.b": F.lit(3)})
    for broadcast_bytes in (BROADCAST_BYTES, -1):
        out = drop_boilerplate(df, broadcast_bytes=broadcast_bytes).collect()
        assert sorted(r["doc_id"] for r in out) == list(range(700))
        assert {(r["n_lines"], r["n_dropped"], r["drops"], r["host"], r["part"], r["a.b"]) for r in out} == {(2, 2, 1, "y", 2, 3), (2, 1, 1, "y", 2, 3)}
