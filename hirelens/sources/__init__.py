"""Sources and sinks."""

from hirelens.sources.binding import bind_testdata
from hirelens.sources.files import read_csv_table, read_hiring_tables, read_parquet_table
from hirelens.sources.sinks import export_csv, write_table

__all__ = [
    "bind_testdata",
    "export_csv",
    "read_csv_table",
    "read_hiring_tables",
    "read_parquet_table",
    "write_table",
]
