"""Regression metrics and reconstruction-error statistics (each one aggregation)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattspark.operators.select import col


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: ``n, mae, mse, r2``.

    R2 is 1 - SSE / SST; for a constant label it is 1.0 when SSE is 0, else
    0.0.  All sums come from one aggregation.
    """
    y, p = col(label).cast("double"), col(prediction).cast("double")
    err = y - p
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(err)).alias("mae"),
                 F.avg(err * err).alias("mse"), F.sum(err * err).alias("sse"),
                 F.var_pop(y).alias("var_y"))
    sst = F.col("var_y") * F.col("n")
    r2 = (F.when(F.col("n") == 0, F.lit(None).cast("double"))
          .when(sst == 0, F.when(F.col("sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - F.col("sse") / sst))
    return agg.select("n", "mae", "mse", r2.alias("r2"))


def three_sigma(df: DataFrame, column: str, k: float = 3.0) -> DataFrame:
    """One row: ``mean, std, threshold`` with population std and mean + k*std."""
    return (df.agg(F.avg(col(column)).alias("mean"), F.stddev_pop(col(column)).alias("std"))
            .withColumn("threshold", F.col("mean") + F.lit(k) * F.col("std")))


def rowwise_mse(df: DataFrame, a_cols: Sequence[str], b_cols: Sequence[str],
                out: str = "reconstruction_error") -> DataFrame:
    """Per row, mean over the column pairs of (a - b)^2."""
    if len(a_cols) != len(b_cols) or not a_cols:
        raise ValueError("need equally many, and at least one, columns")
    sq = [(col(a) - col(b)) * (col(a) - col(b)) for a, b in zip(a_cols, b_cols)]
    total = sq[0]
    for s in sq[1:]:
        total = total + s
    return df.withColumn(out, total / F.lit(float(len(sq))))


def array_mse(a: str, b: str):
    """Mean squared difference of two equal-length array columns."""
    diffs = F.zip_with(F.col(a), F.col(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, x: acc + x) / F.size(F.col(a))


def max_of_two(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: the larger of max(a) and max(b) (reference-line extent)."""
    return df.agg(F.greatest(F.max(col(a)), F.max(col(b))).alias("max_value"))


def flag_anomalies(errors: DataFrame, error_col: str = "reconstruction_error",
                   k: float = 3.0) -> DataFrame:
    """Add ``threshold`` (mean + k*population std of the errors) and
    ``is_anomaly`` (error strictly above it).  The threshold is one
    aggregation; its single value is applied as a literal."""
    threshold = three_sigma(errors, error_col, k).first()["threshold"]
    thr = F.lit(threshold).cast("double")
    return errors.withColumns({"threshold": thr, "is_anomaly": F.col(error_col) > thr})
