"""Physical layout of stored tables: what replaces access paths by index.

Two kinds, chosen per table:

* ``cluster``: rows are dealt out by ranges of the columns and sorted within
  each file, so the files' minima and maxima don't overlap and a filter on the
  leading columns reads the files (and row groups) that can hold it. All listed
  columns make the range, so a leading value with a third of all rows is split
  by the next ones.
* ``bucket``: rows with equal columns lie in the same bucket, sorted; joins and
  aggregates on these columns need no shuffle. A bucket is one file, so choose
  columns without very hot values and as many buckets as make files of some
  hundred MB.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.plans.marts import MART_EXCEPTIONS, MART_LIFECYCLE, MART_SLA_BREACHES, MART_SLA_COMPLIANCE
from hirelens.sources.sinks import write_table


@dataclass(frozen=True)
class Layout:
    cluster: tuple[str, ...] = ()
    bucket: tuple[str, ...] = ()
    sort: tuple[str, ...] = ()  # within a bucket


#: what reports filter by and what the operators join on
LAYOUTS: dict[str, Layout] = {
    "candidates": Layout(bucket=("candidate_id",)),
    "requisitions": Layout(bucket=("req_id",)),
    "applications": Layout(bucket=("application_id",)),
    "stage_events_raw": Layout(bucket=("application_id",), sort=("application_id", "stage_ts")),
    "stage_events": Layout(bucket=("application_id",), sort=("application_id", "stage_ts")),
    "offers": Layout(bucket=("application_id",)),
    "hires": Layout(bucket=("application_id",)),
    MART_LIFECYCLE: Layout(bucket=("application_id",), sort=("org", "recruiter_id")),
    MART_EXCEPTIONS: Layout(bucket=("application_id",), sort=("exception_type",)),
    MART_SLA_BREACHES: Layout(cluster=("recruiter_id", "org", "application_id")),
    MART_SLA_COMPLIANCE: Layout(cluster=("recruiter_id", "org", "transition_name")),
}


def clustered(df: DataFrame, by: tuple[str, ...], files: int) -> DataFrame:
    """``df`` in ``files`` ranges of ``by``, sorted within each. Spark samples
    the input for the ranges, so give it a stored table."""
    return df.repartitionByRange(files, *by).sortWithinPartitions(*by)


def write_clustered(df: DataFrame, path: str, by: tuple[str, ...], files: int) -> str:
    return write_table(clustered(df, by, files), path)


def save_table(df: DataFrame, name: str, path: str, layout: Layout = Layout(), parts: int = 1) -> DataFrame:
    """Drop the catalog table ``name`` if it exists, create it from ``df`` with
    its files below ``path`` and return it."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if layout.cluster:
        staged = path.rstrip("/") + "_unordered"
        write_table(df, staged)  # what defines df runs once, not once more for the sample
        df = clustered(spark.read.schema(df.schema).parquet(staged), layout.cluster, parts)
    elif layout.bucket:
        df = df.repartition(parts, *layout.bucket)  # one file per bucket
    writer = df.write.mode("overwrite").format("parquet").option("path", path)
    if layout.bucket and not layout.cluster:
        writer = writer.bucketBy(parts, *layout.bucket).sortBy(*(layout.sort or layout.bucket))
    writer.saveAsTable(name)
    return spark.table(name)


def file_ranges(df: DataFrame, column: str) -> DataFrame:
    """(file, low, high, nulls) of a stored table's column."""
    file = F.col("_metadata.file_path").alias("file")
    return df.select(file, column).groupBy("file").agg(F.min(column).alias("low"), F.max(column).alias("high"), F.count_if(F.col(column).isNull()).alias("nulls"))


def layout_of(name: str, layouts: Mapping[str, Layout] = LAYOUTS) -> Layout:
    return layouts.get(name, Layout())
