"""File sources for the seven hiring tables (CSV exports and Parquet)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.model import HiringTables
from hirelens.schemas import table_schema
from hirelens.sources.sinks import CSV_DIALECT

ID_COLUMNS = {
    "candidates": ("candidate_id",),
    "requisitions": ("req_id",),
    "applications": ("application_id", "candidate_id", "req_id", "recruiter_id"),
    "stage_events_raw": ("event_id", "application_id"),
    "stage_events": ("event_id", "application_id"),
    "offers": ("offer_id", "application_id"),
    "hires": ("hire_id", "application_id"),
}
INPUT_TABLES = ("candidates", "requisitions", "applications", "stage_events_raw", "offers", "hires")


def _normalise_ids(df: DataFrame, name: str) -> DataFrame:
    """UUID text compares in byte order only when lower-cased."""
    cols = {c: F.lower(F.col(c)) for c in ID_COLUMNS[name] if dict(df.dtypes).get(c) == "string"}
    return df.withColumns(cols) if cols else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header row against a declared schema, in the dialect of a
    database load: a doubled quote inside a quoted field is one quote, a
    backslash is an ordinary character, an unquoted empty field is null and a
    quoted empty string stays an empty string (the null marker is a character
    that never occurs in text).

    ``FAILFAST`` makes a malformed value (e.g. an unparsable timestamp) fail
    the read instead of silently becoming null, and ``enforceSchema=False``
    checks the header against the declared names. Date-only text is accepted
    for timestamp columns. ``multi_line`` allows line breaks in quoted fields;
    a file is then read by one task, so leave it off for exports that have
    none."""
    return (
        spark.read.schema(schema)
        .options(**CSV_DIALECT, mode="FAILFAST", enforceSchema=False, nullValue="\u0000", multiLine=multi_line)
        .csv(path)
    )


#: holds a line that does not fit the schema, whole; null for the others
REJECTED = "_rejected_line"


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """As ``read_csv``, but a line with a malformed value or the wrong number
    of fields comes as a row with its text in ``REJECTED`` instead of failing
    the read. A wrong header still fails it."""
    held = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    return (
        spark.read.schema(held)
        .options(**CSV_DIALECT, mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED, enforceSchema=False, nullValue="\u0000", multiLine=multi_line)
        .csv(path)
    )


def rejected_lines(scanned: DataFrame, name: str, schema: T.StructType) -> DataFrame:
    """(table_name, file, line, reason) of the rejected lines of ``scan_csv``:
    the first column whose text is no value of its type, or the field count."""
    texts = ", ".join(f"`{f.name}` string" for f in schema.fields)
    options = {**CSV_DIALECT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_short", "nullValue": "\u0000"}
    bad = scanned.where(F.col(REJECTED).isNotNull()).select("*", F.col("_metadata.file_path").alias("_file"))
    bad = bad.withColumn("_t", F.from_csv(REJECTED, texts + ", _short string", options))
    reason = F.when(F.col("_t._short").isNotNull(), F.lit(f"not {len(schema.fields)} fields"))
    for f in schema.fields:
        text = F.col("_t").getField(f.name)
        what = F.concat(F.lit(f"{f.name}: no {f.dataType.simpleString()}: "), text)
        reason = reason.when(text.isNotNull() & F.col(f.name).isNull(), what)
    return bad.select(F.lit(name).alias("table_name"), F.col("_file").alias("file"), F.col(REJECTED).alias("line"), reason.otherwise("malformed").alias("reason"))


def read_csv_table(spark: SparkSession, path: str, name: str, id_type: str = "string", multi_line: bool = False) -> DataFrame:
    """One CSV export of a hiring table, see ``read_csv``."""
    return _normalise_ids(read_csv(spark, path, table_schema(name, id_type), multi_line), name)


def read_parquet_table(spark: SparkSession, path: str, name: str, id_type: str = "string") -> DataFrame:
    """One Parquet table, projected to the declared columns in order."""
    schema = table_schema(name, id_type)
    df = spark.read.parquet(path)
    return _normalise_ids(df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]), name)


def read_hiring_tables(
    spark: SparkSession, directory: str, fmt: str = "csv", id_type: str = "string", multi_line: bool = False
) -> HiringTables:
    """All six input tables from ``directory/<table>.<fmt>``; the clean
    event table is derived by promotion, as the load does."""
    base = directory.rstrip("/")
    if fmt == "csv":
        frames = {n: read_csv_table(spark, f"{base}/{n}.csv", n, id_type, multi_line) for n in INPUT_TABLES}
    else:
        frames = {n: read_parquet_table(spark, f"{base}/{n}.{fmt}", n, id_type) for n in INPUT_TABLES}
    return HiringTables(**frames)
