"""Reconstruction-error anomaly detection with a dense autoencoder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattspark.operators.learn import dense, scale, split
from wattspark.operators.learn.metrics import flag_anomalies
from wattspark.operators.select import col


def holdout_last(df: DataFrame, fraction: float,
                 order_col: str = "_time") -> tuple[DataFrame, DataFrame]:
    """Split off the last ``ceil(fraction * n)`` rows by ``order_col``.

    Exact without a global sort (:func:`split.mark_smallest` on the time
    counted backwards); rows that share the time at the cut are taken by
    position, and rows without a time count as the oldest.
    """
    if fraction <= 0:
        return df, df.limit(0)
    micros = F.unix_micros(col(order_col).cast("timestamp"))
    back = F.coalesce(F.lit(1 << 59) - micros, F.lit((1 << 60) - 1))
    marked = split.mark_smallest(df, back, fraction, "__part", "last", "first")
    part = F.col("__part")
    return (marked.where(part == "first").drop("__part"),
            marked.where(part == "last").drop("__part"))


def fit_autoencoder(df: DataFrame, features: Sequence[str], hidden: Sequence[int] = (16, 8, 16), *,
                    epochs: int = 50, batch_size: int = 64, lr: float = 1e-3, seed: int = 42,
                    validation_fraction: float = 0.1, order_col: str = "_time",
                    num_partitions: int | None = None):
    """Scale (fitted on all complete rows), hold out the last rows, train
    ``features -> hidden -> features``; returns (model, loss history)."""
    features = list(features)
    cols = list(dict.fromkeys(([order_col] if order_col else []) + features))
    # the scaler, the hold-out cut and the training rows all read the data:
    # materialise it once (reliable checkpoint) instead of three computations
    data = df.select(*[col(c) for c in cols]).na.drop("any", subset=features)
    data = data.checkpoint(eager=True)
    scaler = scale.scaler_values(scale.fit_standard_scaler(data, features))
    scaled = scale.transform_standard(data, scaler, features)
    train, val = holdout_last(scaled, validation_fraction, order_col)
    model, history = dense.fit_dense(train, features, features, hidden, epochs=epochs, lr=lr,
                                     batch_size=batch_size, seed=seed,
                                     num_partitions=num_partitions,
                                     validation=val if validation_fraction > 0 else None)
    model.scaler_mean, model.scaler_scale = scale.scaler_arrays(scaler, features)
    return model, history


def score_anomalies(df: DataFrame, model: dense.DenseModel, k: float = 3.0,
                    error_col: str = "reconstruction_error") -> DataFrame:
    """Per-row reconstruction error, threshold mean + k*std, ``is_anomaly``.

    The errors are checkpointed, so the pandas UDF scores every row once.
    """
    data = df.na.drop("any", subset=model.features)
    errors = dense.reconstruction_errors(data, model, out=error_col, targets=model.features)
    # the threshold and the flags both read the errors: score once
    errors = errors.checkpoint(eager=True)
    return flag_anomalies(errors, error_col, k)
