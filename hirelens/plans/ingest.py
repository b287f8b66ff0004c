"""CSV exports to stored tables, all or nothing, with a list of what is wrong.

Each export is read once and written as Parquet; lines that don't fit the
declared schema are counted on the way. If there are any, in any file, every
one of them is listed with its file and the reason, and the load fails: no
table of it is used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hirelens.model import HiringTables
from hirelens.schemas import table_schema
from hirelens.sources.files import INPUT_TABLES, REJECTED, _normalise_ids, rejected_lines, scan_csv
from hirelens.sources.sinks import write_table


class LoadAborted(Exception):
    """Raised for rejected lines; how many per table, and where they are."""

    def __init__(self, counts: dict[str, int], path: str):
        self.counts, self.path = counts, path
        super().__init__(f"rejected lines: {counts}, listed in {path}")


def ingest_csv(spark: SparkSession, directory: str, out_dir: str, rejects_dir: str, id_type: str = "string", multi_line: bool = False) -> HiringTables:
    """The six tables of ``directory``/<table>.csv, stored below ``out_dir``.
    Raises ``LoadAborted`` after writing the rejected lines of all files to
    ``rejects_dir`` (table_name, file, line, reason)."""
    rejected: dict[str, int] = {}
    bad: list[DataFrame] = []
    stored: dict[str, DataFrame] = {}
    for name in INPUT_TABLES:
        schema = table_schema(name, id_type)
        lines = scan_csv(spark, f"{directory.rstrip('/')}/{name}.csv", schema, multi_line)
        seen = Observation(f"rejected of {name}")
        rows = lines.observe(seen, F.count(REJECTED).alias("n")).where(F.col(REJECTED).isNull()).drop(REJECTED)
        path = f"{out_dir.rstrip('/')}/{name}"
        write_table(_normalise_ids(rows, name), path)
        stored[name] = spark.read.schema(schema).parquet(path)
        if seen.get["n"]:
            rejected[name] = int(seen.get["n"])
            bad.append(rejected_lines(lines, name, schema))
    if bad:
        write_table(reduce(DataFrame.unionByName, bad), rejects_dir)
        raise LoadAborted(rejected, rejects_dir)
    return HiringTables(**stored)
