"""The load step: store the tables, promote raw events, check them on the way.

The input tables are written once (one directory per table) and every report
reads the stored tables instead of deriving its inputs again. Promotion of raw
events into the FK-clean event table happens here.

The checks of single rows (not null, range, domain, date order, length) are
counted while the tables are written (``DataFrame.observe``): a clean load
reads nothing twice for them, and only tables that have failing rows are read
again to list these. Keys and references compare rows and are checked on the
stored tables. A load becomes visible only when its run is published
(``plans.publish``).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Observation

from hirelens.model import HiringTables
from hirelens.operators.constraints import ConstraintViolation, audit_keys, audit_rows, row_check_metrics, violation_counts
from hirelens.operators.stages import promote_events
from hirelens.schemas import SPECS
from hirelens.sources.files import INPUT_TABLES
from hirelens.sources.sinks import write_table

VIOLATIONS = "constraint_violations"
MODES = ("off", "audit", "enforce")


def write_checked(df: DataFrame, path: str, name: str) -> dict[tuple[str, str], int]:
    """Write ``df`` and return how many rows fail each check of the table
    ``name``: (constraint type, columns) -> rows, failing ones only."""
    checks = row_check_metrics(SPECS[name])
    seen = Observation(f"checks of {name}")
    numbered = {f"n{i}": key for i, key in enumerate(checks)}
    write_table(df.observe(seen, *[checks[key].alias(n) for n, key in numbered.items()]), path)
    found = seen.get
    return {key: int(found[n]) for n, key in numbered.items() if found[n]}


def load_tables(tables: HiringTables, out_dir: str, mode: str = "audit") -> HiringTables:
    """Write the seven tables under ``out_dir`` and return them read back.

    ``mode="audit"`` writes the violations of the declared constraints to
    ``out_dir/constraint_violations``. ``"enforce"`` raises
    ``ConstraintViolation`` if there are any: for failing rows as soon as the
    tables are written, without another scan. ``"off"`` checks nothing."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    spark = tables.applications.sparkSession
    base = out_dir.rstrip("/")
    failing: dict[str, dict[tuple[str, str], int]] = {}

    def store(name, df):
        path = f"{base}/{name}"
        if mode == "off" or name not in SPECS:
            write_table(df, path)
        elif found := write_checked(df, path, name):
            failing[name] = found
        return spark.read.schema(df.schema).parquet(path)

    stored = HiringTables(**{name: store(name, getattr(tables, name)) for name in INPUT_TABLES})
    # promotion reads the stored raw events and applications, not their lineage
    stored = replace(stored, stage_events=store("stage_events", promote_events(stored.stage_events_raw, stored.applications)))
    if mode == "off":
        return stored
    if mode == "enforce" and failing:
        counts: dict[str, int] = {}
        for found in failing.values():
            for (kind, _), n in found.items():
                counts[kind] = counts.get(kind, 0) + n
        raise ConstraintViolation(counts)
    every = stored.as_dict()
    keys = audit_keys(every)
    if mode == "enforce":
        if found := violation_counts(keys):
            raise ConstraintViolation(found)
        return stored
    listed = audit_rows({name: every[name] for name in failing}).unionByName(keys) if failing else keys
    store(VIOLATIONS, listed)
    return stored
