"""Dense networks trained with one gradient step per global minibatch.

The result is that of one process running minibatch Adam over the same batches,
whatever the number of workers:

* training rows are numbered in a total order (``order_cols``, else a seeded hash of
  their content), so a batch is a set of numbers, the same on any cluster;
* an epoch goes over chunks of ``chunk`` consecutive numbers; inside a chunk the numbers
  are shuffled by (seed, epoch, chunk) and cut into batches.  A worker holds its
  rows of one chunk only, so memory is bounded however many rows there are, and
  up to ``chunk`` rows an epoch is a full shuffle;
* an epoch is one Spark job in barrier mode: all workers run at once; for each batch every
  worker computes the gradient of its own rows, the gradients are gathered
  (``BarrierTaskContext.allGather``) and added in worker order, and every worker takes
  the same Adam step;
* the state after an epoch (weights, moments, step count) returns from one worker, so a
  lost executor costs that epoch only;
* validation rows are scored with the weights after the epoch, in the same job.

Spark answers an ``allGather`` once a second, so steps cost about a second with two or
more workers: large batches are meant for them (``workers`` defaults to one per 4,096
rows of a batch).  One worker needs no gathering and runs at NumPy speed.

Without hidden layers the gradient of a batch follows from sums over its rows, whatever
the weights.  The workers then gather the sums of many batches at once (up to
``GATHER_BYTES``), add them in worker order, and take every batch's step from its sums.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattspark.operators.learn import dense
from wattspark.operators.numbering import number_rows
from wattspark.operators.select import col
from wattspark.session import checkpoint_dir

#: Rows shuffled together (and held by all workers together), and rows of a batch per worker.
CHUNK, WORKER_ROWS = 65_536, 4_096
#: Bytes of sums a worker gathers at once for a network without hidden layers.
GATHER_BYTES = 1 << 20
_RESULT = "worker int, loss_sum double, val_sum double, val_n long, state binary"


def batch_numbers(n: int, batch: int, chunk: int, seed: int, epoch: int,
                  shuffle: bool = True) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first number of the chunk after it, the chunk's batches) of an epoch over ``n`` rows."""
    for k, first in enumerate(range(0, n, chunk)):
        size = min(chunk, n - first)
        order = (np.random.default_rng([seed, epoch, k]).permutation(size) if shuffle
                 else np.arange(size))
        yield first + size, [first + order[i:i + batch] for i in range(0, size, batch)]


def adam_step(state: np.ndarray, g: np.ndarray, lr: float, beta1: float = 0.9,
              beta2: float = 0.999, eps: float = 1e-8) -> np.ndarray:
    """[weights, m, v, t] after one step along gradient ``g``."""
    p = len(g)
    t = state[3 * p] + 1
    m = beta1 * state[p:2 * p] + (1 - beta1) * g
    v = beta2 * state[2 * p:3 * p] + (1 - beta2) * g * g
    step = lr * (m / (1 - beta1 ** t)) / (np.sqrt(v / (1 - beta2 ** t)) + eps)
    return np.concatenate([state[:p] - step, m, v, [t]])


def batch_sums(x: np.ndarray, y: np.ndarray, origin: np.ndarray) -> np.ndarray:
    """Flat sums over rows, from which :func:`sums_grad` has the gradient at any weights:
    those of d'd, d'e and ee, where d is (x, 1) and e is y, both less ``origin``."""
    d = np.c_[x - origin[:x.shape[1]], np.ones(len(x))]
    e = y - origin[x.shape[1]:]
    return np.concatenate([(d.T @ d).ravel(), (d.T @ e).ravel(), [float((e * e).sum())]])


def sums_grad(flat: np.ndarray, sizes, sums: np.ndarray, origin: np.ndarray) -> tuple[float, np.ndarray]:
    """``dense._grad`` of one linear layer from the sums of a batch."""
    k, out = sizes
    dd = sums[:(k + 1) ** 2].reshape(k + 1, k + 1)
    de = sums[(k + 1) ** 2:-1].reshape(k + 1, out)
    n = dd[k, k] * out
    w = flat.reshape(k + 1, out).copy()
    w[k] += origin[:k] @ w[:k] - origin[k:]
    r = dd @ w - de                                # sums of d times the residual
    g = 2.0 * r / n
    g[:k] += np.outer(origin[:k], g[k])
    return float(((w * (r - de)).sum() + sums[-1]) / n), g.ravel()


def _rows_by_number(batches: Iterator[pa.RecordBatch]):
    """Function (upper) -> (numbers, x, y) of the next rows with numbers under ``upper``."""
    held: list[tuple] = []

    def take(upper: int):
        parts = []
        while True:
            if not held:
                batch = next(batches, None)
                if batch is None:
                    break
                if batch.num_rows:
                    held.append((batch.column("pos").to_numpy(), dense.list_matrix(batch.column("x")),
                                 dense.list_matrix(batch.column("y"))))
                continue
            pos, x, y = held.pop()
            cut = int(np.searchsorted(pos, upper))
            parts.append((pos[:cut], x[:cut], y[:cut]))
            if cut < len(pos):
                held.append((pos[cut:], x[cut:], y[cut:]))
                break
        return [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else None

    return take


def fit_dense_sync(df: DataFrame, features: Sequence[str], targets: Sequence[str],
                   hidden: Sequence[int] = (128, 64), *, epochs: int = 20, lr: float = 1e-3,
                   batch_size: int = 32, seed: int = 42, workers: int | None = None,
                   shuffle: bool = True, chunk: int = CHUNK, order_cols: Sequence[str] = (),
                   initial: Sequence[float] | None = None, output_activation: str = "linear",
                   validation: DataFrame | None = None) -> tuple[dense.DenseModel, DataFrame]:
    """Train as :func:`dense.fit_dense` does, with a step per global minibatch of
    ``batch_size`` rows.  ``initial`` gives the starting weights (default: seeded).

    Returns the model and the loss history ``epoch, loss[, val_loss]``; the loss of an
    epoch is the mean over its batches' rows before each step.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    features, targets = list(features), list(targets)
    sizes = [len(features), *hidden, len(targets)]
    acts = ["relu"] * len(hidden) + [output_activation]
    p = dense.param_count(sizes)
    chunk = max(batch_size, chunk // batch_size * batch_size)     # whole batches but the last

    def arrays(d: DataFrame, *more) -> DataFrame:
        return d.select(F.array(*[col(c).cast("double") for c in features]).alias("x"),
                        F.array(*[col(c).cast("double") for c in targets]).alias("y"), *more)

    keys = [col(c).alias(f"__o{k}") for k, c in enumerate(order_cols)]
    order = ([F.col(f"__o{k}") for k in range(len(keys))] if keys else
             [F.xxhash64("x", "y", F.lit(seed))]) + [F.col("x"), F.col("y")]
    rows = number_rows(arrays(df, *keys), order).select("pos", "x", "y")
    linear = not hidden and output_activation == "linear"
    ends = [F.avg(F.col(c)[k]) for c, width in (("x", sizes[0]), ("y", sizes[-1]))
            for k in range(width)] if linear else []
    n, *origin = rows.agg(F.count(F.lit(1)), *ends).first()
    if not n:
        raise ValueError("no training rows")
    origin = np.nan_to_num(np.array(origin, float))
    slots = spark.sparkContext.defaultParallelism       # a barrier job needs all workers at once
    count = max(1, min(slots, workers or batch_size // WORKER_ROWS))
    rows = rows.withColumn("is_val", F.lit(False))
    if validation is not None:     # after the last training number, in any order
        rows = rows.unionByName(arrays(validation).select(
            F.lit(1 << 62).alias("pos"), "x", "y", F.lit(True).alias("is_val")))
    deal = F.when(F.col("is_val"), F.xxhash64("x")).otherwise(F.col("pos"))
    rows = (rows.withColumn("__deal", deal).repartition(count, "__deal")
            .sortWithinPartitions("pos").select("pos", "x", "y").checkpoint(eager=True))

    start = np.asarray(initial, float) if initial is not None else dense.init_params(sizes, seed)
    state = np.concatenate([start, np.zeros(2 * p), [0.0]])
    history = []
    for epoch in range(1, epochs + 1):
        held = spark.sparkContext.broadcast(state)     # model-sized

        def run(batches, _held=held, _epoch=epoch):
            if count > 1:
                from pyspark import BarrierTaskContext

                ctx = BarrierTaskContext.get()
                me = ctx.partitionId()
            else:
                ctx, me = None, 0
            take, cur, loss_sum = _rows_by_number(batches), _held.value, 0.0
            sums: list[np.ndarray] = []
            lengths: list[int] = []

            def gathered(own: np.ndarray) -> np.ndarray:
                if ctx is None:
                    return own
                parts = ctx.allGather(base64.b64encode(own.tobytes()).decode())
                return np.sum([np.frombuffer(base64.b64decode(s)) for s in parts], axis=0)

            def step_by_sums():
                nonlocal cur, loss_sum
                if sums:
                    for total, size in zip(gathered(np.concatenate(sums)).reshape(len(sums), -1), lengths):
                        loss, g = sums_grad(cur[:p], sizes, total, origin)
                        loss_sum += loss * size
                        cur = adam_step(cur, g, lr)
                sums.clear()
                lengths.clear()

            for upper, chunk_batches in batch_numbers(n, batch_size, chunk, seed, _epoch, shuffle):
                own = take(upper)
                if own is None:
                    own = (np.zeros(0, np.int64), np.zeros((0, sizes[0])), np.zeros((0, sizes[-1])))
                pos, x, y = own
                for numbers in chunk_batches:
                    at = np.searchsorted(pos, numbers)
                    at = at[np.flatnonzero((at < len(pos))
                                           & (pos[np.minimum(at, len(pos) - 1)] == numbers))
                            ] if len(pos) else at[:0]
                    if linear and ctx is not None:
                        sums.append(batch_sums(x[at], y[at], origin))
                        lengths.append(len(numbers))
                        if len(sums) * sums[0].nbytes >= GATHER_BYTES:
                            step_by_sums()
                        continue
                    share = np.zeros(p + 1)
                    if len(at):
                        loss, g = dense._grad(cur[:p], sizes, acts, x[at], y[at])
                        share = np.append(g, loss) * (len(at) / len(numbers))
                    share = gathered(share)
                    loss_sum += share[p] * len(numbers)
                    cur = adam_step(cur, share[:p], lr)
            step_by_sums()
            val_sum, val_n = 0.0, 0
            while (own := take((1 << 62) + 1)) is not None and len(own[0]):
                val_sum += dense._mse_sum(cur[:p], sizes, acts, own[1], own[2])
                val_n += len(own[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array([me], pa.int32()), pa.array([loss_sum]), pa.array([val_sum]),
                 pa.array([val_n], pa.int64()),
                 pa.array([cur.tobytes() if me == 0 else None], pa.binary())],
                names=["worker", "loss_sum", "val_sum", "val_n", "state"])

        out = rows.mapInArrow(run, _RESULT, barrier=count > 1).collect()     # one row per worker
        held.unpersist()
        state = next(np.frombuffer(bytes(r["state"])) for r in out if r["worker"] == 0)
        val_n = sum(r["val_n"] for r in out)
        history.append((epoch, out[0]["loss_sum"] / n,
                        sum(r["val_sum"] for r in out) / val_n if val_n else None))
    model = dense.DenseModel(sizes, acts, state[:p].copy(), features, targets)
    losses = spark.createDataFrame(history, "epoch int, loss double, val_loss double")
    return model, losses if validation is not None else losses.drop("val_loss")
