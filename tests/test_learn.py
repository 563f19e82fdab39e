import numpy as np
from pyspark.sql import functions as F

from wattspark.operators.learn import anomaly, dense, forest, metrics, scale, split


def _linear(spark, n=2000, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 0.5 * x[:, 2] + rng.normal(scale=0.05, size=n)
    rows = [(i, float(a), float(b), float(c), float(t)) for i, (a, b, c), t in zip(range(n), x, y)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double")


def test_split_is_deterministic_and_partition_invariant(spark):
    df = _linear(spark)
    s1 = split.train_test_split(df, 0.2, 42, key_cols=["id"])
    s2 = split.train_test_split(df.repartition(7), 0.2, 42, key_cols=["id"])
    a = {r.id for r in s1.where("split = 'test'").collect()}
    b = {r.id for r in s2.where("split = 'test'").collect()}
    assert a == b and 0.15 < len(a) / 2000 < 0.25


def test_scaler_population_std_and_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, k double")
    m = scale.fit_standard_scaler(df, ["x", "k"])
    out = scale.transform_standard(df, m, ["x", "k"]).collect()
    assert [r.x for r in out] == [-1.0, 1.0] and [r.k for r in out] == [0.0, 0.0]


def test_regression_metrics_match_numpy(spark):
    y = np.array([1.0, 2.0, 4.0, 8.0])
    p = np.array([1.5, 2.0, 3.0, 9.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    r = metrics.regression_metrics(df, "y", "p").first()
    assert np.isclose(r.mae, np.mean(np.abs(y - p)))
    assert np.isclose(r.mse, np.mean((y - p) ** 2))
    assert np.isclose(r.r2, 1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))
    const = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "y double, p double")
    assert metrics.regression_metrics(const, "y", "p").first().r2 == 1.0


def test_three_sigma_flags(spark):
    errs = [0.1] * 50 + [5.0]
    df = spark.createDataFrame([(float(e),) for e in errs], "reconstruction_error double")
    out = metrics.flag_anomalies(df).collect()
    thr = np.mean(errs) + 3 * np.std(errs)
    assert np.isclose(out[0].threshold, thr)
    assert sum(r.is_anomaly for r in out) == 1


def test_forest_fit_predict_roundtrip(spark, tmp_dir):
    df = _linear(spark, 600)
    model = forest.fit_random_forest(df, ["a", "b", "c"], "y", num_trees=10, max_depth=6)
    scored = forest.predict(model, df)
    r2 = metrics.regression_metrics(scored, "y", "prediction").first().r2
    assert r2 > 0.8
    forest.save_model(model, tmp_dir + "/rf")
    again = forest.predict(forest.load_model(tmp_dir + "/rf"), df, "p2")
    assert again.join(scored.select("id", "prediction"), "id").where("p2 != prediction").count() == 0
    imp = forest.feature_importances(spark, model, ["a", "b", "c"]).collect()
    assert abs(sum(r.importance for r in imp) - 1.0) < 1e-9


def test_dense_trainer_learns_linear_target(spark, tmp_dir):
    df = _linear(spark, 3000, seed=1)
    model, hist = dense.fit_dense(df, ["a", "b", "c"], ["y"], (32, 16), epochs=15, lr=3e-3,
                                  batch_size=32, num_partitions=4)
    losses = [r.loss for r in hist.orderBy("epoch").collect()]
    assert losses[-1] < losses[0] / 10
    scored = dense.predict_dense(df, model)
    assert metrics.regression_metrics(scored, "y", "prediction").first().r2 > 0.95
    dense.save_dense(spark, model, tmp_dir + "/mlp")
    loaded = dense.load_dense(spark, tmp_dir + "/mlp")
    a = [r.prediction for r in dense.predict_dense(df.limit(20), loaded).collect()]
    b = [r.prediction for r in scored.limit(20).collect()]
    assert np.allclose(a, b)


def test_gradient_matches_finite_differences():
    rng = np.random.default_rng(3)
    sizes, acts = [3, 4, 2], ["relu", "linear"]
    params = dense.init_params(sizes, 0)
    x, y = rng.normal(size=(5, 3)), rng.normal(size=(5, 2))
    _, g = dense._grad(params, sizes, acts, x, y)
    eps = 1e-6
    for i in range(0, len(params), 5):
        p1, p2 = params.copy(), params.copy()
        p1[i] += eps
        p2[i] -= eps
        num = (dense._grad(p1, sizes, acts, x, y)[0] - dense._grad(p2, sizes, acts, x, y)[0]) / (2 * eps)
        assert abs(num - g[i]) < 1e-5


def test_autoencoder_scores_outlier_highest(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(800, 1))
    x = np.hstack([base, 2 * base, -base]) + rng.normal(scale=0.01, size=(800, 3))
    x[-1] = [5.0, -5.0, 5.0]
    import datetime as dt
    t0 = dt.datetime(2025, 1, 1)
    rows = [(t0 + dt.timedelta(minutes=i), *map(float, r)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "_time timestamp, a double, b double, c double")
    model, hist = anomaly.fit_autoencoder(df, ["a", "b", "c"], (8, 2, 8), epochs=20,
                                          batch_size=32, lr=3e-3, num_partitions=2)
    assert hist.where("val_loss is not null").count() == 20
    flagged = anomaly.score_anomalies(df, model)
    top = flagged.orderBy(F.desc("reconstruction_error")).first()
    assert top.a == 5.0 and top.is_anomaly


def test_exact_split_count_and_ties(spark):
    import math as _m

    df = _linear(spark, 1003)
    out = split.train_test_split(df, 0.2, 42, key_cols=["id"], exact=True)
    assert out.where("split = 'test'").count() == _m.ceil(0.2 * 1003)
    again = split.train_test_split(df.repartition(5), 0.2, 42, key_cols=["id"], exact=True)
    a = {r.id for r in out.where("split = 'test'").collect()}
    b = {r.id for r in again.where("split = 'test'").collect()}
    assert a == b
    # many equal keys: the boundary group is split by quota, count stays exact
    dup = spark.range(0, 997).select(F.lit("same").alias("k"), F.col("id"))
    d = split.train_test_split(dup.repartition(4), 0.3, 1, key_cols=["k"], exact=True)
    assert d.where("split = 'test'").count() == _m.ceil(0.3 * 997)
    assert d.count() == 997
