"""Grouped aggregates with the reference's missing-value rules, and distinct."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattspark.functions.missing import clean_value
from wattspark.operators.select import col

_AGG = {"mean", "sum", "min", "max", "count"}


def _agg_expr(name: str, how: str) -> Column:
    c = clean_value(col(name))
    if how == "mean":
        return F.avg(c).alias(name)
    if how == "sum":
        # the sum of a group whose values are all missing is 0.0, not missing
        return F.coalesce(F.sum(c), F.lit(0.0)).alias(name)
    if how == "min":
        return F.min(c).alias(name)
    if how == "max":
        return F.max(c).alias(name)
    return F.count(c).alias(name)


def group_aggregate(df: DataFrame, keys: Sequence[str], spec: Mapping[str, str]) -> DataFrame:
    """``groupBy(keys).agg({col: 'mean'|'sum'|...})`` with missing-value rules.

    Rows with a missing key are dropped (grouping skips missing keys); ``mean``
    skips missing values and is missing for an all-missing group; ``sum`` of
    an all-missing group is 0.0.  Aggregation is algebraic, so Spark combines
    map-side before the shuffle and a hot key costs one row per partition.
    """
    bad = {h for h in spec.values() if h not in _AGG}
    if bad:
        raise ValueError(f"unsupported aggregations: {bad}")
    keys = list(keys)
    cond = None
    for k in keys:
        c = col(k).isNotNull()
        cond = c if cond is None else cond & c
    base = df.where(cond) if cond is not None else df
    return base.groupBy(*[col(k) for k in keys]).agg(*[_agg_expr(c, h) for c, h in spec.items()])


def sum_zero(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Group sum where an all-missing group sums to 0.0."""
    return group_aggregate(df, keys, {c: "sum" for c in columns})


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication; missing equals missing, as in the reference."""
    return df.dropDuplicates()
