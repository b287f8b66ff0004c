"""Table sinks (the create-table-as-select side of the marts)."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: CSV as databases read and write it: a quote inside a field is doubled and a
#: backslash is an ordinary character
CSV_DIALECT = {"header": "true", "quote": '"', "escape": '"'}


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Overwrite ``path`` with ``df`` (rerun-safe full reload)."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        # null: nothing between the commas; an empty string: two quotes
        writer = writer.options(**CSV_DIALECT, nullValue="", emptyValue='""')
    writer.save(path)
    return path


def export_csv(df: DataFrame, path: str) -> str:
    """CSV with a header row, for consumers that want flat files."""
    return write_table(df, path, fmt="csv")
