"""Filters, projections and selection helpers (all pushed into one plan)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattspark.functions.timeops import in_range


def col(name: str) -> Column:
    """Column by exact name (hyphens, dots and spaces are taken literally)."""
    if name.startswith("`") and name.endswith("`"):
        return F.col(name)
    return F.col("`" + name.replace("`", "``") + "`")


def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    """``column == value``; pushed to the Parquet scan / partition pruning."""
    return df.where(col(column) == F.lit(value))


def filter_regex(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Partial regular-expression match; a missing value never matches."""
    return df.where(col(column).rlike(pattern))


def filter_time_range(df: DataFrame, start: datetime, stop: datetime,
                      column: str = "_time") -> DataFrame:
    """``start <= column < stop``."""
    return df.where(in_range(col(column), start, stop))


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cond = None
    for c in columns:
        e = col(c).isNotNull()
        cond = e if cond is None else cond & e
    return df.where(cond) if cond is not None else df


def contains(df: DataFrame, column: str, text: str, case_sensitive: bool = True) -> DataFrame:
    """Substring test; a missing value never matches."""
    c = col(column)
    if case_sensitive:
        return df.where(c.contains(text))
    return df.where(F.lower(c).contains(text.lower()))


def dropna_any(df: DataFrame) -> DataFrame:
    """Drop rows with a missing (null or NaN) value in any column."""
    return df.na.drop("any")


def dropna_subset(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop("any", subset=list(columns))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns; names that are absent are ignored."""
    present = [c for c in columns if c in df.columns]
    return df.drop(*present)


def select_columns(df: DataFrame, columns: Sequence[str], *, strict: bool = True) -> DataFrame:
    """Keep-list projection (column pruning reaches the scan)."""
    missing = [c for c in columns if c not in df.columns]
    if missing and strict:
        raise KeyError(f"columns not found: {missing}")
    return df.select(*[col(c) for c in columns if c in df.columns])


def distinct_trimmed(df: DataFrame, column: str, alias: str | None = None,
                     sort: bool = True) -> DataFrame:
    """Distinct non-blank trimmed values of ``column`` (sorted when asked)."""
    out_name = alias or column
    out = (df.select(F.trim(col(column)).alias(out_name))
           .where(col(out_name).isNotNull() & (col(out_name) != ""))
           .distinct())
    return out.orderBy(out_name) if sort else out


def distinct_pairs(df: DataFrame, a: str, b: str, sort: bool = True) -> DataFrame:
    """Distinct (a, b) pairs without blank lines (both missing or empty)."""
    blank = ((col(a).isNull() | (F.trim(col(a)) == "")) & (col(b).isNull() | (F.trim(col(b)) == "")))
    out = df.select(col(a), col(b)).where(~blank).distinct()
    return out.orderBy(a, b) if sort else out


def exists_gate(df: DataFrame, gate: DataFrame) -> DataFrame:
    """Return ``df`` when ``gate`` has at least one row, else no rows.

    An uncorrelated EXISTS: ``gate.exists()`` plans a subquery that runs
    once (``SELECT 1 ... LIMIT 1``), so the gate is a constant filter, with
    no join, and filters above it still push down.  Where DataFrame
    subqueries are unavailable, a left-semi join with one broadcast row of
    the gate (bounded by construction) is used instead.
    """
    exists = getattr(gate, "exists", None)
    if exists is not None:
        return df.where(exists())
    one = gate.limit(1).select(F.lit(1).alias("__gate"))
    return df.join(F.broadcast(one), F.lit(True), "left_semi")


def export_name(inventory_id: str | None, vm_name_filter: str | None) -> str:
    """Export file stem: the id, else the filter regex without its first
    and last character (e.g. '^prod-' -> 'prod')."""
    if inventory_id:
        return inventory_id
    if vm_name_filter is None:
        raise ValueError("need an inventory id or a vm_name filter")
    return vm_name_filter[1:-1]


def export_name_col(id_col: str | None, vm_name_filter: str | None) -> Column:
    """Column form of :func:`export_name` (per-row id, else the regex stem)."""
    stem = F.lit(vm_name_filter[1:-1] if vm_name_filter else None).cast("string")
    if id_col is None:
        return stem
    return F.coalesce(col(id_col), stem)
