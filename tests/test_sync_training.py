"""Synchronous training equals one NumPy process over the same batches."""

import numpy as np
import pytest

from wattspark.operators.learn import dense, sync


def one_process(x, y, sizes, acts, start, epochs, lr, batch, chunk, seed, shuffle=True):
    p = dense.param_count(sizes)
    w, m, v, t, losses = start.copy(), np.zeros(p), np.zeros(p), 0, []
    for epoch in range(1, epochs + 1):
        total = 0.0
        for _, batches in sync.batch_numbers(len(x), batch, chunk, seed, epoch, shuffle):
            for rows in batches:
                loss, g = dense._grad(w, sizes, acts, x[rows], y[rows])
                total += loss * len(rows)
                t += 1
                m = 0.9 * m + 0.1 * g
                v = 0.999 * v + 0.001 * g * g
                w = w - lr * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        losses.append(total / len(x))
    return w, losses


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(700, 4))
    y = np.c_[np.sin(x[:, 0]) + x[:, 1] * x[:, 2], x[:, 3] ** 2]
    rows = [(int(i), *map(float, a), *map(float, b)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "i long, a double, b double, c double, d double, y double, z double")
    return df.repartition(16), x, y


@pytest.mark.parametrize("workers", [1, 4])
def test_weights_equal_one_process(spark, table, workers):
    df, x, y = table
    sizes, acts = [4, 16, 8, 2], ["relu", "relu", "linear"]
    args = dict(epochs=2, lr=5e-3, batch_size=128, seed=3, shuffle=True, chunk=384)
    model, history = sync.fit_dense_sync(df, list("abcd"), ["y", "z"], (16, 8), workers=workers,
                                         order_cols=["i"], **args)
    w, losses = one_process(x, y, sizes, acts, dense.init_params(sizes, 3), 2, 5e-3, 128, 384, 3)
    assert np.abs(model.params - w).max() < 1e-8
    assert [r.loss for r in history.orderBy("epoch").collect()] == pytest.approx(losses, abs=1e-10)


def test_small_batches_learn_and_score_validation(spark, table):
    df, x, y = table
    train, val = df.where("i < 600"), df.where("i >= 600")
    model, history = sync.fit_dense_sync(train, list("abcd"), ["y"], (32, 16), epochs=30, lr=5e-3,
                                         batch_size=32, validation=val)
    last = history.orderBy("epoch").collect()[-1]
    out, _ = dense.forward(model.params, model.sizes, model.activations, x[600:])
    assert last.val_loss == pytest.approx(float(((out[:, 0] - y[600:, 0]) ** 2).mean()))
    assert last.loss < 0.1 * y[:600, 0].var()
    with pytest.raises(ValueError):
        sync.fit_dense_sync(train.where("i < 0"), list("abcd"), ["y"])


def test_every_number_is_in_one_batch_of_an_epoch():
    for n, batch, chunk in ((100, 32, 64), (64, 64, 64), (5, 32, 64)):
        seen = [sorted(np.concatenate([r for _, b in sync.batch_numbers(n, batch, chunk, 1, e) for r in b]))
                for e in (1, 2)]
        assert seen[0] == seen[1] == list(range(n))


@pytest.mark.parametrize("gather_bytes", [1 << 20, 6000])
def test_linear_workers_gather_the_sums_of_many_batches(spark, table, monkeypatch, gather_bytes):
    """The steps of one process, with far fewer gatherings (each takes a second) than steps."""
    import time

    df, x, y = table
    x = x + [1e4, 0, 0, -3e3]
    df = df.selectExpr("i", "a + 1e4 as a", "b", "c", "d - 3e3 as d", "y", "z")
    monkeypatch.setattr(sync, "GATHER_BYTES", gather_bytes)
    args = dict(epochs=2, lr=5e-3, batch_size=8, seed=3, shuffle=True, chunk=64, initial=[0.0] * 10)
    began = time.time()
    model, history = sync.fit_dense_sync(df, list("abcd"), ["y", "z"], (), workers=2, order_cols=["i"], **args)
    assert time.time() - began < 60          # 176 steps, a second each before
    w, losses = one_process(x, y, [4, 2], ["linear"], np.zeros(10), 2, 5e-3, 8, 64, 3)
    assert np.abs(model.params - w).max() < 1e-7
    assert [r.loss for r in history.orderBy("epoch").collect()] == pytest.approx(losses, rel=1e-9)
