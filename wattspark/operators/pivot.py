"""Long -> wide pivots (mean of duplicates) and their cleaning rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattspark.functions.missing import clean_value, to_numeric
from wattspark.operators.select import col

FILE_COL = "_file"


def pivot_mean(df: DataFrame, index: Sequence[str], fields: Sequence[str] | str,
               *, value_col: str = "_value", field_col: str = "_field",
               per_file: bool | None = None, strict: bool = False) -> DataFrame:
    """Pivot long telemetry to one row per index key, one column per field.

    Each cell is the mean of the values of that (key, field); duplicates
    (several scrapes with an equal key) are averaged.  Missing-value rules:

    * a missing value (null or NaN) never contributes and never forms a row,
      so an index key whose values are all missing does not appear;
    * a key with a missing index column is dropped;
    * a declared field with no non-missing value is an all-null column
      (``strict=True`` raises instead, as a later step needing it would);
    * a text ``_value`` column is coerced to numbers first; text that is not
      a number (e.g. 'running') is missing.

    The plan is a single hash aggregate over ``index`` with one conditional
    ``avg`` per field: partial aggregation runs map-side, so a hot key is
    combined before the shuffle and only one exchange is planned.

    ``per_file``: when the input carries a ``_file`` column (one row set per
    exported file), pivot each file separately as the reference does, so an
    equal key in two overlapping exports stays two rows.  Defaults to True
    exactly when the column exists.  ``fields='discover'`` pivots the fields
    that have at least one non-missing value (one extra job that collects
    the field names, a set bounded by the metric vocabulary).
    """
    index = list(index)
    if per_file is None:
        per_file = FILE_COL in df.columns
    if per_file and FILE_COL not in df.columns:
        raise ValueError("per_file=True needs a _file column")
    value = _value_expr(df, value_col)
    if isinstance(fields, str):
        if fields != "discover":
            raise ValueError("fields must be a list or 'discover'")
        fields = sorted(r[0] for r in df.where(col(field_col).isNotNull() & value.isNotNull())
                        .select(field_col).distinct().collect())
    fields = list(fields)
    if strict:
        present = set(present_fields(df, fields, value_col=value_col, field_col=field_col))
        missing = [f for f in fields if f not in present]
        if missing:
            raise KeyError(f"declared fields without any value: {missing}")
    keys = ([FILE_COL] if per_file else []) + index
    cond = col(field_col).isin(fields)
    for k in index:
        cond = cond & col(k).isNotNull()
    # the value is computed once, in this projection: a filter on it would be
    # pushed below and compute it again, so keys without any value go after
    # the aggregate instead
    base = df.where(cond).select(*[col(k) for k in keys], col(field_col), value.alias(value_col))
    aggs = [F.avg(F.when(col(field_col) == f, col(value_col))).alias(f) for f in fields]
    out = base.groupBy(*[col(k) for k in keys]).agg(*aggs)
    if fields:
        out = out.where(F.coalesce(*[col(f) for f in fields]).isNotNull())
    else:
        out = out.where(F.lit(False))
    return out.select(*[col(c) for c in index + fields])


def _value_expr(df: DataFrame, value_col: str):
    """The value as a clean double: text coerced, NaN -> missing."""
    if isinstance(df.schema[value_col].dataType, T.StringType):
        return to_numeric(col(value_col))
    return clean_value(col(value_col))


def present_fields(df: DataFrame, fields: Sequence[str], *, value_col: str = "_value",
                   field_col: str = "_field") -> list[str]:
    """Declared fields with at least one non-missing value, in declared order.

    One aggregation job; the collected set is bounded by ``len(fields)``.
    """
    value = _value_expr(df, value_col)
    seen = {r[0] for r in df.where(col(field_col).isin(list(fields)) & value.isNotNull())
            .select(field_col).distinct().collect()}
    return [f for f in fields if f in seen]


def coerce_numeric_values(df: DataFrame, value_col: str = "_value") -> DataFrame:
    """Text values -> double; unparseable text (e.g. 'running') becomes missing."""
    return df.withColumn(value_col, to_numeric(F.col(value_col)))
