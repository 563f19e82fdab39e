"""Dense feed-forward networks trained data-parallel on Spark.

MLlib has no multilayer-perceptron *regressor*, so the network is a small
NumPy model trained with synchronous parameter averaging:

* the training rows are checkpointed (reliable, lineage cut) and dealt in turn
  over partitions whose number follows from the row count and the batch size,
  never from the cluster, so the same rows give the same model anywhere; they
  are packed once into one row per Arrow batch, which every epoch reads, and a task
  runs up to ``PARTITIONS_PER_TASK`` partitions in turn;
* every epoch is one Spark job: the current weights and Adam moments are
  broadcast, each partition runs shuffled minibatch Adam over its own rows
  (``mapInArrow``), and returns its weights and moments in slices, with its
  row count and loss sum;
* the slices are averaged weighted by row count, one group per slice; only
  the averaged, model-sized state comes back to the driver.

With one partition this is plain minibatch Adam.  Training that synchronises
after every minibatch is :mod:`wattspark.operators.learn.sync`.  Prediction is a pandas UDF
(Arrow batches) with the weights broadcast.  A model is stored as one
Parquet row (layer sizes, activations, flat weights, scaler arrays).
"""

from __future__ import annotations

import logging
import time
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattspark.operators.select import col
from wattspark.session import checkpoint_dir

log = logging.getLogger("wattspark.dense")


@dataclass
class DenseModel:
    sizes: list[int]                 # e.g. [10, 128, 64, 1]
    activations: list[str]           # per layer: 'relu' or 'linear'
    params: np.ndarray               # flat weights and biases
    features: list[str]
    targets: list[str]
    scaler_mean: list[float] = field(default_factory=list)
    scaler_scale: list[float] = field(default_factory=list)

    def layers(self):
        return unflatten(self.params, self.sizes)


def param_count(sizes: Sequence[int]) -> int:
    return sum(a * b + b for a, b in zip(sizes[:-1], sizes[1:]))


def unflatten(flat: np.ndarray, sizes: Sequence[int]):
    out, pos = [], 0
    for a, b in zip(sizes[:-1], sizes[1:]):
        w = flat[pos:pos + a * b].reshape(a, b)
        pos += a * b
        bias = flat[pos:pos + b]
        pos += b
        out.append((w, bias))
    return out


def init_params(sizes: Sequence[int], seed: int) -> np.ndarray:
    """Uniform(-1/sqrt(fan_in), 1/sqrt(fan_in)) weights and biases."""
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in zip(sizes[:-1], sizes[1:]):
        bound = 1.0 / np.sqrt(a)
        parts.append(rng.uniform(-bound, bound, size=a * b))
        parts.append(rng.uniform(-bound, bound, size=b))
    return np.concatenate(parts)


def forward(flat: np.ndarray, sizes, activations, x: np.ndarray):
    """Forward pass; returns the output and the per-layer activations."""
    acts = [x]
    h = x
    for (w, b), act in zip(unflatten(flat, sizes), activations):
        h = h @ w + b
        if act == "relu":
            h = np.maximum(h, 0.0)
        acts.append(h)
    return h, acts


def _grad(flat, sizes, activations, x, y):
    """Mean-squared-error loss and its gradient for one minibatch."""
    out, acts = forward(flat, sizes, activations, x)
    n = x.shape[0]
    diff = out - y
    loss = float(np.mean(diff * diff))
    delta = 2.0 * diff / (n * y.shape[1])
    layers = unflatten(flat, sizes)
    grads = [None] * len(layers)
    for i in range(len(layers) - 1, -1, -1):
        if activations[i] == "relu":
            delta = delta * (acts[i + 1] > 0)
        gw = acts[i].T @ delta
        gb = delta.sum(axis=0)
        grads[i] = (gw, gb)
        if i > 0:
            delta = delta @ layers[i][0].T
    return loss, np.concatenate([np.concatenate([gw.ravel(), gb]) for gw, gb in grads])


def adam_epoch(state: np.ndarray, sizes, activations, x, y, lr: float, batch: int,
               rng: np.random.Generator, beta1=0.9, beta2=0.999, eps=1e-8):
    """One shuffled pass of minibatch Adam over (x, y).

    ``state`` = [params, m, v, t] flattened; returns (new state, loss sum).
    """
    p = param_count(sizes)
    params, m, v, t = state[:p].copy(), state[p:2 * p].copy(), state[2 * p:3 * p].copy(), state[3 * p]
    order = rng.permutation(x.shape[0])
    loss_sum = 0.0
    for start in range(0, len(order), batch):
        idx = order[start:start + batch]
        loss, g = _grad(params, sizes, activations, x[idx], y[idx])
        loss_sum += loss * len(idx)
        t += 1
        m = beta1 * m + (1 - beta1) * g
        v = beta2 * v + (1 - beta2) * g * g
        mhat = m / (1 - beta1 ** t)
        vhat = v / (1 - beta2 ** t)
        params -= lr * mhat / (np.sqrt(vhat) + eps)
    return np.concatenate([params, m, v, [t]]), loss_sum


#: Values of a state in one slice (a task averages one slice of all partitions).
SLICE = 4096
_SLICES = ("slice int, task int, n long, loss_sum double, val_n long, val_loss_sum double, "
           "part binary")


def _train_rows(df: DataFrame, features, targets, num_partitions, seed,
                validation: DataFrame | None = None) -> DataFrame:
    def arrays(d, is_val):
        return d.select(F.array(*[col(c).cast("double") for c in features]).alias("x"),
                        F.array(*[col(c).cast("double") for c in targets]).alias("y"),
                        F.lit(is_val).alias("is_val"))
    rows = arrays(df, False)
    if validation is not None:
        rows = rows.unionByName(arrays(validation, True))
    # rows are dealt in turn, so equal rows spread as evenly as any; the order
    # within a partition is a hash of content and seed
    rows = rows.repartition(num_partitions).sortWithinPartitions(
        F.xxhash64("x", "y", F.lit(seed)))
    return rows.checkpoint(eager=True)


#: Most partitions of a training set whose epochs one task runs, one after the other.
PARTITIONS_PER_TASK = 16


def _packed_rows(rows: DataFrame) -> DataFrame:
    """Training rows as one row per Arrow batch: the partition's number and the matrices and
    marks as bytes.  An epoch neither converts rows to Arrow nor sends targets that equal the
    inputs twice, and its tasks run several partitions."""
    def pack(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        for batch in batches:
            if batch.num_rows:
                x, y = list_matrix(batch.column("x")), list_matrix(batch.column("y"))
                is_val = batch.column("is_val").to_numpy(zero_copy_only=False)
                same = x.shape == y.shape and x.tobytes() == y.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pid], pa.int32()), pa.array([len(x)], pa.int32())]
                    + [pa.array([v], pa.binary()) for v in (
                        x.tobytes(), None if same else y.tobytes(), is_val.tobytes())],
                    names=["task", "n", "x", "y", "is_val"])

    return rows.mapInArrow(pack, "task int, n int, x binary, y binary, is_val binary").checkpoint(
        eager=True)


def _unpacked_rows(batches):
    """(partition, x, y, is_val) of every packed row."""
    for batch in batches:
        for task, n, *parts in zip(*(batch.column(c) for c in ("task", "n", "x", "y", "is_val")),
                                   strict=True):
            x, y, is_val = (np.frombuffer(p.as_buffer(), t) if p.is_valid else None
                            for p, t in zip(parts, (float, float, bool), strict=True))
            x = x.reshape(n.as_py(), -1)
            yield task.as_py(), x, x if y is None else y.reshape(len(x), -1), is_val


#: Fewest minibatches a partition has per epoch (the weights are averaged once
#: per epoch, so with few of them training would hardly move), and the most
#: partitions of a training set.
MIN_BATCHES = 100
MAX_PARTITIONS = 4096


def training_partitions(n_rows: int, batch_size: int, requested: int | None = None) -> int:
    """Partitions for ``n_rows``: at most ``requested``, each with at least
    ``MIN_BATCHES`` minibatches."""
    fit = max(1, min(n_rows // (batch_size * MIN_BATCHES), MAX_PARTITIONS))
    return min(fit, requested) if requested else fit


def _average(states: DataFrame, size: int) -> dict:
    """Row-count-weighted mean of the partition states, in one job.

    A group holds one slice of every partition's state (32 KB each) and adds
    them in task order; only the averaged, model-sized vector is collected.
    """
    def mean(table: pa.Table) -> pa.Table:
        table = table.sort_by("task")
        n = table.column("n").to_numpy()
        total = np.zeros(len(table.column("part")[0].as_py()) // 8)
        for rows, part in zip(n, table.column("part"), strict=True):
            if rows:
                total += np.frombuffer(part.as_py()) * rows
        add = {c: pa.array([table.column(c).to_numpy().sum()], t) for c, t in (
            ("n", pa.int64()), ("loss_sum", pa.float64()), ("val_n", pa.int64()),
            ("val_loss_sum", pa.float64()))}
        return pa.table({"slice": table.column("slice").slice(0, 1), "task": pa.array([0], pa.int32()),
                         **add, "part": pa.array([(total / max(n.sum(), 1)).tobytes()], pa.binary())})

    parts = states.groupBy("slice").applyInArrow(mean, _SLICES).collect()   # model-sized
    if not parts or not parts[0]["n"]:
        raise ValueError("no training rows")
    vec = np.empty(size)
    for r in parts:
        own = np.frombuffer(bytes(r["part"]))
        vec[r["slice"] * SLICE:r["slice"] * SLICE + len(own)] = own
    first = parts[0]
    return {"state": vec, "n": first["n"], "loss": first["loss_sum"],
            "val_n": first["val_n"], "val_loss": first["val_loss_sum"]}


def list_matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists of doubles as a matrix (no Python objects)."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _mse_sum(params, sizes, acts, x, y) -> float:
    out, _ = forward(params, sizes, acts, x)
    return float(np.sum(np.mean((out - y) ** 2, axis=1)))


def fit_dense(df: DataFrame, features: Sequence[str], targets: Sequence[str],
              hidden: Sequence[int] = (128, 64), *, epochs: int = 20, lr: float = 1e-3,
              batch_size: int = 32, seed: int = 42, num_partitions: int | None = None,
              output_activation: str = "linear",
              validation: DataFrame | None = None) -> tuple[DenseModel, DataFrame]:
    """Train a ReLU network ``features -> hidden... -> targets`` with MSE.

    Returns the model and the loss history ``epoch, loss[, val_loss]``.
    Validation rows travel with the training rows: in the job of epoch e
    each partition first scores its validation rows with the incoming
    weights (the average after epoch e-1), so the validation loss of every
    epoch costs no extra job (the last one costs one scoring pass).
    ``num_partitions`` is an upper bound, see :func:`training_partitions`.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    features, targets = list(features), list(targets)
    sizes = [len(features), *hidden, len(targets)]
    acts = ["relu"] * len(hidden) + [output_activation]
    nparts = training_partitions(df.count(), batch_size, num_partitions)
    # a task's own cost is several times that of a partition's epoch: tasks run some of them
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-nparts // PARTITIONS_PER_TASK))
    rows = _packed_rows(_train_rows(df, features, targets, nparts, seed, validation)).coalesce(tasks)
    p = param_count(sizes)
    state = np.concatenate([init_params(sizes, seed), np.zeros(2 * p), [0.0]])
    history: list[dict] = []
    # one extra pass after the last epoch only scores the validation rows
    passes = epochs + (1 if validation is not None else 0)
    for epoch in range(1, passes + 1):
        t0 = time.perf_counter()
        bstate = spark.sparkContext.broadcast(state)
        train_now = epoch <= epochs

        def run(batches, _b=bstate, _epoch=epoch, _train=train_now):
            start = _b.value
            for pid, held in groupby(_unpacked_rows(batches), itemgetter(0)):
                rng = np.random.default_rng([seed, _epoch, pid])
                cur, n, loss_sum, val_n, val_sum = start, 0, 0.0, 0, 0.0
                # stream the partition's packed batches: rows are already spread
                # at random over partitions, each batch is shuffled again
                for _, x, y, is_val in held:
                    if is_val.any():
                        val_sum += _mse_sum(start[:p], sizes, acts, x[is_val], y[is_val])
                        val_n += int(is_val.sum())
                    if _train and (~is_val).any():
                        cur, ls = adam_epoch(cur, sizes, acts, x[~is_val], y[~is_val], lr,
                                             batch_size, rng)
                        n += int((~is_val).sum())
                        loss_sum += ls
                cuts = range(0, len(cur), SLICE)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(cuts)), pa.int32())]
                    + [pa.array([v] * len(cuts), t) for v, t in (
                        (pid, pa.int32()), (n, pa.int64()), (loss_sum, pa.float64()),
                        (val_n, pa.int64()), (val_sum, pa.float64()))]
                    + [pa.array([cur[k:k + SLICE].tobytes() for k in cuts], pa.binary())],
                    names=["slice", "task", "n", "loss_sum", "val_n", "val_loss_sum", "part"])

        states = rows.mapInArrow(run, _SLICES)
        if train_now:
            res = _average(states, len(state))
            state = res["state"]
            history.append({"epoch": epoch, "loss": res["loss"] / res["n"]})
        else:
            res = states.where("slice = 0").agg(F.sum("val_n").alias("val_n"),
                                                F.sum("val_loss_sum").alias("val_loss")).first()
            res = {"val_n": int(res["val_n"] or 0), "val_loss": float(res["val_loss"] or 0.0)}
        bstate.unpersist()
        if epoch > 1 and validation is not None:
            # weights scored in this pass are the result of epoch - 1
            history[epoch - 2]["val_loss"] = (res["val_loss"] / res["val_n"]
                                              if res["val_n"] else None)
        if train_now:
            log.info("epoch %d loss %.6g rows %d (%.2fs)", epoch, history[-1]["loss"], res["n"],
                     time.perf_counter() - t0)
    model = DenseModel(sizes, acts, state[:p], features, targets)
    keys = ["epoch", "loss"] + (["val_loss"] if validation is not None else [])
    schema = "epoch int, loss double" + (", val_loss double" if validation is not None else "")
    return model, spark.createDataFrame([tuple(h.get(k) for k in keys) for h in history], schema)


def _predict_udf(spark: SparkSession, model: DenseModel, n_out: int, mode: str):
    bparams = spark.sparkContext.broadcast(model.params)
    sizes, acts = model.sizes, model.activations
    mean = np.array(model.scaler_mean or [0.0] * sizes[0])
    scale = np.array(model.scaler_scale or [1.0] * sizes[0])

    @F.pandas_udf(T.DoubleType())
    def predict_one(*cols: pd.Series) -> pd.Series:
        x = (np.column_stack([c.to_numpy(dtype=float) for c in cols[:sizes[0]]]) - mean) / scale
        out, _ = forward(bparams.value, sizes, acts, x)
        if mode == "predict":
            return pd.Series(out[:, 0])
        y = np.column_stack([c.to_numpy(dtype=float) for c in cols[sizes[0]:]])
        if mode == "reconstruct":
            y = (y - mean) / scale
        return pd.Series(np.mean((out - y) ** 2, axis=1))

    return predict_one


def predict_dense(df: DataFrame, model: DenseModel, out: str = "prediction") -> DataFrame:
    """Scaler (if stored) -> network -> first output, as a pandas UDF."""
    udf = _predict_udf(df.sparkSession, model, 1, "predict")
    return df.withColumn(out, udf(*[col(c) for c in model.features]))


def reconstruction_errors(df: DataFrame, model: DenseModel, out: str = "reconstruction_error",
                          targets: Sequence[str] | None = None) -> DataFrame:
    """Per-row mean squared error between the network output and the
    targets (for an autoencoder: its own, scaled, inputs)."""
    targets = list(targets or model.targets)
    mode = "reconstruct" if targets == model.features and model.scaler_mean else "error"
    udf = _predict_udf(df.sparkSession, model, len(targets), mode)
    return df.withColumn(out, udf(*[col(c) for c in model.features], *[col(c) for c in targets]))


_MODEL_SCHEMA = ("sizes array<int>, activations array<string>, params array<double>, "
                 "features array<string>, targets array<string>, scaler_mean array<double>, "
                 "scaler_scale array<double>")


def save_dense(spark: SparkSession, model: DenseModel, path: str) -> None:
    row = (model.sizes, model.activations, [float(v) for v in model.params], model.features,
           model.targets, [float(v) for v in model.scaler_mean],
           [float(v) for v in model.scaler_scale])
    spark.createDataFrame([row], _MODEL_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def load_dense(spark: SparkSession, path: str) -> DenseModel:
    r = spark.read.parquet(path).first()
    return DenseModel(list(r["sizes"]), list(r["activations"]), np.array(r["params"], dtype=float),
                      list(r["features"]), list(r["targets"]), list(r["scaler_mean"] or []),
                      list(r["scaler_scale"] or []))
