"""Table profiles: shape, missing counts, per-column value summaries, head."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattspark.operators.select import col


def _missing(c: str, dtype: T.DataType):
    e = col(c).isNull()
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        e = e | F.isnan(col(c))
    return e


def shape(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per named table: ``table, n_rows, n_columns``.

    Row counts are one aggregation job per table; the union is one plan.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("table"), "n_rows",
                     F.lit(len(df.columns)).cast("bigint").alias("n_columns"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def null_counts(df: DataFrame) -> DataFrame:
    """Missing (null or NaN) count per column in a single scan.

    Returns ``column, position, n_missing`` (long format, one row per column).
    """
    fields = df.schema.fields
    counts = df.agg(*[F.sum(F.when(_missing(f.name, f.dataType), 1).otherwise(0))
                      .cast("bigint").alias(f"c{i}") for i, f in enumerate(fields)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(i).alias("position"),
                 F.col(f"c{i}").alias("n_missing"))
        for i, f in enumerate(fields)]))
    return counts.select(stacked.alias("s")).select("s.*")


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, *,
                   exact: bool = False, rsd: float = 0.01) -> DataFrame:
    """Per column: distinct count, missing count, constant flag, min / max
    for numeric columns (as doubles) and the time span for timestamp
    columns (``min_time`` / ``max_time``).

    ``exact=False`` uses HyperLogLog (``approx_count_distinct``), one pass
    with no per-column shuffle; ``exact=True`` counts exactly.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    aggs = []
    for i, f in enumerate(fields):
        c = col(f.name)
        nd = F.count_distinct(c) if exact else F.approx_count_distinct(c, rsd)
        aggs += [nd.alias(f"d{i}"),
                 F.sum(F.when(_missing(f.name, f.dataType), 1).otherwise(0)).cast("bigint")
                 .alias(f"m{i}")]
        numeric = isinstance(f.dataType, T.NumericType)
        timed = isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
        none_d, none_t = F.lit(None).cast("double"), F.lit(None).cast(T.TimestampNTZType())
        aggs += [(F.min(c).cast("double") if numeric else none_d).alias(f"lo{i}"),
                 (F.max(c).cast("double") if numeric else none_d).alias(f"hi{i}"),
                 (F.min(c).cast(T.TimestampNTZType()) if timed else none_t).alias(f"tlo{i}"),
                 (F.max(c).cast(T.TimestampNTZType()) if timed else none_t).alias(f"thi{i}")]
    row = df.agg(*aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("dtype"),
                 F.col(f"d{i}").cast("bigint").alias("n_distinct"),
                 F.col(f"m{i}").alias("n_missing"),
                 (F.col(f"d{i}") <= 1).alias("is_constant"),
                 F.col(f"lo{i}").alias("min_value"),
                 F.col(f"hi{i}").alias("max_value"),
                 F.col(f"tlo{i}").alias("min_time"),
                 F.col(f"thi{i}").alias("max_time"))
        for i, f in enumerate(fields)]))
    return row.select(stacked.alias("s")).select("s.*")


def value_sets(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Every distinct value of the text columns with its row count.

    Returns ``column, value, n_rows``, one row per (column, value); missing
    values are left out.  One scan and one ``groupBy`` whose partial counts
    are combined before the shuffle, whatever the number of values.
    """
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
            and (columns is None or f.name in columns)]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, value string, n_rows bigint")
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), col(c).alias("value"))
                                for c in cols]))
    return (df.select(pairs.alias("p")).select("p.*").where(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_rows")))


def time_span(df: DataFrame, column: str = "_time") -> DataFrame:
    """First and last timestamp of ``column``."""
    return df.agg(F.min(col(column)).alias("first_time"), F.max(col(column)).alias("last_time"))


def head(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows after an explicit order (a top-n, not a full sort)."""
    if order_by:
        df = df.orderBy(*[col(c) for c in order_by])
    return df.limit(n)


def columns_of(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Column names and types as a DataFrame (``position, column, dtype``)."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column string, dtype string")
