"""Standard scaling with population standard deviation.

Fit is one aggregation producing a single row (means and deviations); the
transform reads that row once and applies it as literals, so it is plain
column arithmetic inside whole-stage codegen, with no join.  A
zero-variance column is divided by 1 (it becomes 0), matching the usual
scaler convention; MLlib's StandardScaler uses the sample deviation and is
therefore not used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattspark.operators.select import col


def fit_standard_scaler(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: ``mean_<c>``, ``scale_<c>`` (population std, 0 -> 1)."""
    aggs = []
    for c in cols:
        aggs.append(F.avg(col(c)).alias(f"mean_{c}"))
        sd = F.stddev_pop(col(c))
        aggs.append(F.when((sd == 0) | sd.isNull(), F.lit(1.0)).otherwise(sd).alias(f"scale_{c}"))
    return df.agg(*aggs)


def transform_standard(df: DataFrame, model: DataFrame, cols: Sequence[str],
                       suffix: str = "") -> DataFrame:
    """(x - mean) / scale for every column; ``suffix`` keeps the originals.

    ``model`` is the one-row result of :func:`fit_standard_scaler` (or a
    dict of its values); its row is read once.
    """
    m = model if isinstance(model, dict) else model.first().asDict()
    new = {f"{c}{suffix}": (col(c) - F.lit(m[f"mean_{c}"])) / F.lit(m[f"scale_{c}"])
           for c in cols}
    return df.withColumns(new)


def scaler_values(model: DataFrame) -> dict:
    """The one fitted row as a dict (read once, reused by transforms)."""
    return model.first().asDict()


def scaler_arrays(model, cols: Sequence[str]) -> tuple[list[float], list[float]]:
    """The fitted scaler as (means, scales) in column order."""
    m = model if isinstance(model, dict) else scaler_values(model)
    return [m[f"mean_{c}"] for c in cols], [m[f"scale_{c}"] for c in cols]
