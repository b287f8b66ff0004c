"""Declared constraints as audit queries.

Spark enforces no keys or checks, so every declared constraint becomes a
query that lists its violations in one long form:

    table_name, constraint_type, column_names, key_value, violation_count

Row-level checks (not null, range, domain, date order, length, foreign
key) report one row per offending row, keyed by the row's primary key, in
one narrow pass per table (an exploded, filtered array of the failed
checks). Key checks (primary key, composite unique) report one row per
duplicated key with its multiplicity; they are partial aggregates, so a
hot key shuffles one row per map task.

``enforce_constraints`` raises when any audit finds a violation; the load step
(``plans.load``) runs it over the stored tables before they are published.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.schemas import SPECS, TableSpec

AUDIT_COLUMNS = ("table_name", "constraint_type", "column_names", "key_value", "violation_count")


def _as_text(col: Column) -> Column:
    return col.cast("string")


def _row_violations(df: DataFrame, spec: TableSpec, checks: list[tuple[Column, str, str]]) -> DataFrame:
    """One pass over ``df``; ``checks`` are (failed-condition, type, column)."""
    if not checks:
        return _empty(df)
    hits = [
        F.when(cond, F.struct(F.lit(kind).alias("constraint_type"), F.lit(cols).alias("column_names")))
        for cond, kind, cols in checks
    ]
    failed = F.filter(F.array(*hits), lambda x: x.isNotNull())
    # as a plain filter too, which Spark moves below the joins that made ``df``
    df = df.where(reduce(or_, [cond for cond, _, _ in checks]))
    return df.select(_as_text(F.col(spec.primary_key)).alias("key_value"), F.explode(failed).alias("_c")).select(
        F.lit(spec.name).alias("table_name"),
        F.col("_c.constraint_type").alias("constraint_type"),
        F.col("_c.column_names").alias("column_names"),
        "key_value",
        F.lit(1).cast("long").alias("violation_count"),
    )


def _empty(df: DataFrame) -> DataFrame:
    return df.select(
        F.lit(None).cast("string").alias("table_name"),
        F.lit(None).cast("string").alias("constraint_type"),
        F.lit(None).cast("string").alias("column_names"),
        F.lit(None).cast("string").alias("key_value"),
        F.lit(None).cast("long").alias("violation_count"),
    ).where(F.lit(False))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _duplicate_keys(df: DataFrame, table: str, kind: str, cols: tuple[str, ...], nulls_violate: bool) -> DataFrame:
    """Keys occurring more than once, from ONE partial aggregate.

    With ``nulls_violate`` (primary keys) the null key is its own group of
    the same aggregate and is reported as a NOT_NULL violation with its row
    count; otherwise rows with a null part are dropped first (SQL UNIQUE lets
    them coexist)."""
    present = F.lit(True)
    for c in cols:
        present = present & F.col(c).isNotNull()
    src = df if nulls_violate else df.where(present)
    grouped = src.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    is_null_key = ~present
    found = grouped.where(is_null_key | (F.col("n") > 1)) if nulls_violate else grouped.where(F.col("n") > 1)
    key = F.concat_ws("|", *[_as_text(F.col(c)) for c in cols])
    return found.select(
        F.lit(table).alias("table_name"),
        F.when(is_null_key, F.lit("NOT_NULL")).otherwise(F.lit(kind)).alias("constraint_type"),
        F.lit(",".join(cols)).alias("column_names"),
        F.when(is_null_key, F.lit(None).cast("string")).otherwise(key).alias("key_value"),
        F.col("n").cast("long").alias("violation_count"),
    )


def audit_primary_key(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Duplicated primary keys (and null keys, counted per table)."""
    return _union(
        [
            _duplicate_keys(tables[name], name, "PRIMARY_KEY", (spec.primary_key,), nulls_violate=True)
            for name, spec in SPECS.items()
            if name in tables
        ]
    )


def audit_unique(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Duplicated composite unique keys; rows with a null part never
    conflict (SQL UNIQUE semantics)."""
    parts = [
        _duplicate_keys(tables[name], name, "UNIQUE", cols, nulls_violate=False)
        for name, spec in SPECS.items()
        if name in tables
        for cols in spec.unique
    ]
    return _union(parts)


def _row_checks(spec: TableSpec) -> list[tuple[Column, str, str]]:
    """All row-level checks of a table: (failed-condition, type, columns).
    A null passes every check but NOT NULL."""
    checks = [(F.col(c).isNull(), "NOT_NULL", c) for c in spec.not_null]
    checks += [(~F.col(c).between(lo, hi), "RANGE", c) for c, lo, hi in spec.ranges]
    checks += [(~F.col(c).isin(*values), "DOMAIN", c) for c, values in spec.domains]
    checks += [(F.col(late) < F.col(early), "DATE_ORDER", f"{early},{late}") for early, late in spec.date_orders]
    checks += [(F.length(F.col(c)) > n, "LENGTH", c) for c, n in spec.max_length]
    return checks


def row_check_metrics(spec: TableSpec) -> dict[tuple[str, str], Column]:
    """(constraint type, columns) -> number of rows that fail, as aggregates
    for ``DataFrame.observe``: counted in the pass that writes the table."""
    return {(kind, cols): F.count_if(failed) for failed, kind, cols in _row_checks(spec)}


def audit_rows(tables: Mapping[str, DataFrame], kinds: tuple[str, ...] = ("NOT_NULL", "RANGE", "DOMAIN", "DATE_ORDER", "LENGTH")) -> DataFrame:
    """Every row-level violation, in one narrow pass per table."""
    parts = []
    for name, spec in SPECS.items():
        checks = [c for c in _row_checks(spec) if c[1] in kinds] if name in tables else []
        if checks:
            parts.append(_row_violations(tables[name], spec, checks))
    return _union(parts) if parts else _empty(next(iter(tables.values())))


def audit_not_null(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Nulls in declared NOT NULL columns (primary key nulls included)."""
    return audit_rows(tables, ("NOT_NULL",))


def audit_range(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Values outside a declared inclusive range (null passes)."""
    return audit_rows(tables, ("RANGE",))


def audit_domain(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Values outside a declared list (null passes, as in a CHECK)."""
    return audit_rows(tables, ("DOMAIN",))


def audit_date_order(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Requisitions closed before they opened."""
    return audit_rows(tables, ("DATE_ORDER",))


def audit_length(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Strings longer than their declared VARCHAR length."""
    return audit_rows(tables, ("LENGTH",))


def audit_foreign_key(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Child rows whose non-null reference has no parent (left-anti join
    against the parent's key column only)."""
    parts = []
    for name, spec in SPECS.items():
        if name not in tables:
            continue
        for col, parent, parent_key in spec.foreign_keys:
            if parent not in tables:
                continue
            child = tables[name].select(spec.primary_key, col).where(F.col(col).isNotNull())
            keys = tables[parent].select(F.col(parent_key).alias(col))
            missing = child.join(keys, col, "left_anti")
            parts.append(
                missing.select(
                    F.lit(name).alias("table_name"),
                    F.lit("FOREIGN_KEY").alias("constraint_type"),
                    F.lit(col).alias("column_names"),
                    _as_text(F.col(spec.primary_key)).alias("key_value"),
                    F.lit(1).cast("long").alias("violation_count"),
                )
            )
    return _union(parts)


AUDITS = {
    "PRIMARY_KEY": audit_primary_key,
    "NOT_NULL": audit_not_null,
    "RANGE": audit_range,
    "DOMAIN": audit_domain,
    "DATE_ORDER": audit_date_order,
    "UNIQUE": audit_unique,
    "FOREIGN_KEY": audit_foreign_key,
    "LENGTH": audit_length,
}


def audit_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The checks that compare rows: one aggregate per key, one anti join per
    reference. A null primary key is left to the row checks."""
    keys = audit_primary_key(tables).where("constraint_type = 'PRIMARY_KEY'")
    return _union([keys, audit_unique(tables), audit_foreign_key(tables)])


def audit_constraints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every audit in one long-form result: one pass per table for all
    row-level checks, one aggregate per key, one anti join per reference."""
    return _union([audit_rows(tables), audit_primary_key(tables), audit_unique(tables), audit_foreign_key(tables)])


class ConstraintViolation(Exception):
    """Raised by ``enforce_constraints``; carries the violation counts."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        super().__init__(f"constraint violations: {counts}")


def violation_counts(violations: DataFrame) -> dict[str, int]:
    """Violations per constraint type; at most one row per type comes back."""
    counts = violations.groupBy("constraint_type").agg(F.sum("violation_count").alias("n")).collect()
    return {r["constraint_type"]: int(r["n"]) for r in counts if r["n"]}


def enforce_constraints(tables: Mapping[str, DataFrame]) -> None:
    """Raise ``ConstraintViolation`` if any audit reports a row."""
    found = violation_counts(audit_constraints(tables))
    if found:
        raise ConstraintViolation(found)
