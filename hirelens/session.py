"""Session construction and shared-storage helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "hirelens",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the library is tuned for.

    AQE is on so joins against measured-small sides turn into broadcast
    joins at runtime, skewed join partitions get split, and shuffle
    partitions get coalesced. The session time zone is pinned to UTC (the
    library's arithmetic is zone-free anyway). PySpark's per-call call-site
    capture for error messages is switched off: it inspects the Python
    stack and makes extra JVM round trips for every column function, which
    dominates driver-side planning time of column-heavy jobs.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.parquet.inferTimestampNTZ.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The directory that ``spark.checkpoint.dir`` names: storage that every
    executor and the driver reach. There is no other choice to fall back on: a
    machine-local folder would lose what another machine wrote."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        raise RuntimeError("set spark.checkpoint.dir to a directory that all machines share")
    return path.rstrip("/")


def set_checkpoint_dir_if_unset(spark: SparkSession, path: str) -> str:
    """Use ``path`` for checkpoints only when the session names no shared
    checkpoint directory itself (tests, local benchmarks); a configured
    ``spark.checkpoint.dir`` always wins."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return shared_dir(spark)


def new_run_dir(spark: SparkSession, kind: str) -> str:
    """Fresh sub-directory of the shared directory for one materialisation."""
    return f"{shared_dir(spark)}/hirelens/{kind}/{uuid.uuid4().hex}"
