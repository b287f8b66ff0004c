from __future__ import annotations

SF = "/root/testdata/sf0.001"


def got(df, *cols) -> list[tuple]:
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def rows_of(odd) -> list[tuple]:
    return [tuple(r)[:5] for r in odd.orderBy("row").collect()]
