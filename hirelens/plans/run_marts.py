"""Command-line job: load the exports, audit them, build the marts, publish.

    spark-submit -m hirelens.plans.run_marts --input s3://.../exports --format csv \\
        --out s3://.../marts [--constraints enforce] [--duplicate-mode symmetric]

Everything is written below ``--out``/_runs/<run id>; the run is published when
all of it is there (``plans.publish``), so a failure leaves the earlier marts
readable; runs older than the last ``--keep`` are then removed. Lines of a CSV
export that don't fit its schema fail the job and are listed below
``--out``/_rejected/<run id>. The session comes from the launcher (``spark-submit`` decides master
and resources); only SQL settings that the library relies on are set, and only
when the launcher left them unset.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from hirelens.plans.ingest import ingest_csv
from hirelens.plans.load import MODES, load_tables
from hirelens.plans.marts import MartPaths, build_marts, mart_paths
from hirelens.plans.publish import current_run, delete_dir, is_published, new_run, publish, sweep
from hirelens.sources.files import read_hiring_tables

SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def run(
    spark: SparkSession,
    input_dir: str,
    out_dir: str,
    fmt: str = "csv",
    id_type: str = "string",
    constraints: str = "audit",
    duplicate_mode: str = "reference",
    out_format: str = "parquet",
    multi_line: bool = False,
    keep: int = 2,
) -> MartPaths:
    """Load, audit, build and publish; the paths of the published marts."""
    for key, value in SQL_DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    run_id, run_dir = new_run(out_dir)
    try:
        if fmt == "csv":
            exports = ingest_csv(spark, input_dir, f"{run_dir}/exports", f"{out_dir.rstrip('/')}/_rejected/{run_id}", id_type, multi_line)
        else:
            exports = read_hiring_tables(spark, input_dir, fmt=fmt, id_type=id_type)
        tables = load_tables(exports, f"{run_dir}/tables", constraints)
        paths = build_marts(tables, f"{run_dir}/marts", duplicate_mode=duplicate_mode, fmt=out_format)
        publish(spark, out_dir, run_id)
    except Exception:
        # a failure after the line was written leaves a run that readers see
        if not is_published(spark, out_dir, run_id):
            delete_dir(spark, run_dir)
        raise
    sweep(spark, out_dir, keep)
    return paths


def published_marts(spark: SparkSession, out_dir: str) -> MartPaths | None:
    """The marts of the run that ``out_dir`` currently shows."""
    run_dir = current_run(spark, out_dir)
    return mart_paths(f"{run_dir}/marts") if run_dir else None


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Build the hiring reporting marts.")
    p.add_argument("--input", required=True, help="directory with <table>.csv or <table>.parquet")
    p.add_argument("--out", required=True, help="output directory for the marts")
    p.add_argument("--format", default="csv", choices=("csv", "parquet"))
    p.add_argument("--multi-line", action="store_true", help="quoted CSV fields may hold line breaks")
    p.add_argument("--out-format", default="parquet", choices=("csv", "parquet"))
    p.add_argument("--id-type", default="string", choices=("string", "long"))
    p.add_argument("--constraints", default="audit", choices=MODES, help="write the violations, or fail if there are any")
    p.add_argument("--duplicate-mode", default="reference", choices=("reference", "symmetric"))
    p.add_argument("--keep", type=int, default=2, help="published runs that stay on storage")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("hirelens-marts").getOrCreate()
    paths = run(spark, a.input, a.out, a.format, a.id_type, a.constraints, a.duplicate_mode, a.out_format, a.multi_line, a.keep)
    print(json.dumps(paths.as_dict()))


if __name__ == "__main__":
    main()
