"""Publication of a finished run: one line in a log, added and never changed.

A job writes everything below ``root/_runs/<run id>`` and, when all of it is
there, adds one small file with one line (version, run id) to ``root/_log``, in
a directory of its own (jobs that write to one directory clear away each
other's unfinished files). Readers take the line of the highest version, so they see the tables of one
run, never a mixture. Nothing is renamed over something else or overwritten, so
this holds on object stores as on file systems:

* a job that dies before its line is written leaves the earlier run published;
  what it wrote is a run that no line names;
* of two jobs that publish at the same time both lines stay; all readers order
  them alike, by (version, run id), and follow the same one;
* a line counts only if it is whole (it ends with its own run id again).

``sweep`` removes the runs that nobody should read any more.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG, RUNS = "_log", "_runs"
_LINE = "version long, run_id string, written_ms long, whole string"


def new_run(root: str) -> tuple[str, str]:
    """(run id, its directory)"""
    run_id = uuid.uuid4().hex
    return run_id, run_dir(root, run_id)


def run_dir(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/{RUNS}/{run_id}"


def published(spark: SparkSession, root: str) -> DataFrame:
    """(version, run_id, written_ms) of every published run, the current one
    first: one row per run."""
    path = f"{root.rstrip('/')}/{LOG}"
    if not _exists(spark, path):
        return spark.createDataFrame([], "version long, run_id string, written_ms long")
    lines = spark.read.schema(_LINE).options(mode="DROPMALFORMED", recursiveFileLookup=True).json(path)
    whole = lines.where("whole = run_id AND version IS NOT NULL").groupBy("run_id").agg(F.max("version").alias("version"), F.max("written_ms").alias("written_ms"))
    return whole.select("version", "run_id", "written_ms").orderBy(F.desc("version"), F.desc("run_id"))


def publish(spark: SparkSession, root: str, run_id: str) -> int:
    """Let readers of ``root`` see the run ``run_id`` from now on; its version."""
    top = published(spark, root).first()
    version = (top["version"] if top else 0) + 1
    line = spark.createDataFrame([(version, run_id, int(time.time() * 1000), run_id)], _LINE)
    line.coalesce(1).write.json(f"{root.rstrip('/')}/{LOG}/{run_id}-{version}")
    return version


def current_run(spark: SparkSession, root: str) -> str | None:
    """Directory of the published run, if there is one."""
    top = published(spark, root).first()
    return run_dir(root, top["run_id"]) if top else None


def is_published(spark: SparkSession, root: str, run_id: str) -> bool:
    return bool(published(spark, root).where(F.col("run_id") == run_id).head(1))


# Spark has no call to look for or delete a directory; Hadoop's file systems do.


def _files(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    target, fs = _files(spark, path)
    return fs.exists(target)


def delete_dir(spark: SparkSession, path: str) -> None:
    """Remove what a failed run has written."""
    target, fs = _files(spark, path)
    fs.delete(target, True)


def sweep(spark: SparkSession, root: str, keep: int = 2, unpublished_ms: int = 7 * 24 * 3600 * 1000, now_ms: int | None = None) -> list[str]:
    """Delete the directories of all but the ``keep`` newest published runs,
    and of runs that were never published and haven't changed for
    ``unpublished_ms`` (what a dead job left; a longer time than any job
    takes). Their lines stay in the log. The ids of the deleted runs."""
    if keep < 1:
        raise ValueError("the published run has to stay")
    now = now_ms if now_ms is not None else int(time.time() * 1000)
    order = [r["run_id"] for r in published(spark, root).collect()]
    target, fs = _files(spark, f"{root.rstrip('/')}/{RUNS}")
    if not fs.exists(target):
        return []
    gone = []
    for status in fs.listStatus(target):
        run_id = status.getPath().getName()
        old = run_id in order[keep:] if run_id in order else now - status.getModificationTime() > unpublished_ms
        if old:
            fs.delete(status.getPath(), True)
            gone.append(run_id)
    return sorted(gone)
