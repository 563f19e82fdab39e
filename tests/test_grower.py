"""Unlimited trees: every split against a brute-force tree, large nodes, scoring by shuffle."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspark.operators.learn import forest, grower, metrics

FEATURES = ["a", "b", "c"]


def brute_tree(x, y, w, depth=None):
    """(feature, threshold, value, left, right) of the exact tree, by trying every split."""
    value = np.average(y, weights=w)
    if y.min() == y.max() or depth == 0:
        return (None, None, value, None, None)
    best = (-np.inf, None, None)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for lo, hi in zip(values, values[1:]):
            left = x[:, f] <= lo
            score = sum((w[s] * y[s]).sum() ** 2 / w[s].sum() for s in (left, ~left))
            if score > best[0]:
                best = (score, f, (lo + hi) / 2)
    if best[1] is None:
        return (None, None, value, None, None)
    left = x[:, best[1]] <= best[2]
    below = None if depth is None else depth - 1
    return (best[1], best[2], value, brute_tree(x[left], y[left], w[left], below),
            brute_tree(x[~left], y[~left], w[~left], below))


def as_nested(rows, part, node):
    r = rows[part, node]
    if r["feature"] is None:
        return (None, None, r["value"], None, None)
    return (r["feature"], r["threshold"], r["value"], as_nested(rows, r["left_part"], r["left_node"]),
            as_nested(rows, r["right_part"], r["right_node"]))


def same(a, b):
    assert a[0] == b[0] and (a[1] is None or abs(a[1] - b[1]) < 1e-12) and abs(a[2] - b[2]) < 1e-9
    for k in (3, 4):
        if a[k] is not None:
            same(a[k], b[k])


def data(n, seed, levels=40):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, levels, (n, 3)).astype(float)
    return x, (3 * x[:, 0] + (x[:, 1] > 20) * 50 + rng.integers(0, 9, n)).astype(float)


def table(spark, x, y):
    return spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)],
                                 "a double, b double, c double, y double").repartition(4)


def nodes_of(model, tree=0):
    return {(r["part"], r["node"]): r.asDict() for r in model.nodes.filter(F.col("tree") == tree).collect()}


@pytest.mark.parametrize("depth", [None, 3])
def test_every_split_equals_the_brute_force_tree(spark, depth):
    x, y = data(150, 1)
    w = np.ones(len(y))
    df = table(spark, x, y)
    model = grower.fit_grown_forest(df, FEATURES, "y", num_trees=2, bootstrap=False, max_depth=depth)
    want = brute_tree(x, y, w, depth)
    for tree in (0, 1):
        same(as_nested(nodes_of(model, tree), 0, 0), want)
    weights = np.random.default_rng(2).integers(1, 4, len(y)).astype(float)
    t = grower.grow_exact(x, y, weights, depth)

    def nested(i):
        if t["feature"][i] < 0:
            return (None, None, t["value"][i], None, None)
        return (t["feature"][i], t["threshold"][i], t["value"][i], nested(t["left"][i]), nested(t["right"][i]))

    same(nested(0), brute_tree(x, y, weights, depth))


def test_training_residual_is_zero_on_distinct_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(800, 3))
    y = rng.normal(size=800) * 100
    df = table(spark, x, y)
    for finish in (100_000, 120):      # one group per tree, and large nodes by histograms first
        model = grower.fit_grown_forest(df, FEATURES, "y", num_trees=2, bootstrap=False, finish_rows=finish, bins=16)
        assert (model.nodes.filter("part = -1").count() > 0) == (finish == 120)
        scored = grower.predict_grown(df, model)
        assert scored.agg(F.max(F.abs(F.col("y") - F.col("prediction")))).first()[0] < 1e-9
        leaves = model.nodes.filter("feature is null").groupBy("tree").count().collect()
        assert [r["count"] for r in leaves] == [800, 800]


def test_rows_with_equal_features_get_their_mean_and_hot_points_are_leaves(spark):
    x, y = data(600, 4, levels=6)
    x[:250] = 2.0                       # a hot point: large, and not to be split
    df = table(spark, x, y)
    mean = df.groupBy(*FEATURES).agg(F.avg("y").alias("m"))
    for finish in (100_000, 60):
        model = grower.fit_grown_forest(df, FEATURES, "y", num_trees=1, bootstrap=False, finish_rows=finish, bins=4)
        far = grower.predict_grown(df, model).join(mean, FEATURES).agg(
            F.max(F.abs(F.col("m") - F.col("prediction")))).first()[0]
        assert far < 1e-9
    holes = spark.createDataFrame([(1.0, None, 2.0, 1.0), (1.0, 1.0, 2.0, 1.0)],
                                  "a double, b double, c double, y double")
    got = grower.predict_grown(holes, model).orderBy("b").collect()
    assert got[0].prediction is None and got[1].prediction is not None
    with pytest.raises(ValueError):
        grower.fit_grown_forest(df.filter("a < -1"), FEATURES, "y")


def test_scoring_by_shuffle_equals_scoring_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(grower, "FINISH_ROWS", 200)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 3))
    df = table(spark, x, np.sin(x[:, 0]) * 10 + x[:, 1])
    for finish in (100_000, 150):
        model = grower.fit_grown_forest(df, FEATURES, "y", num_trees=5, finish_rows=finish, bins=16, tree_group=2)
        a = grower.predict_grown(df, model)
        b = grower.predict_grown(df, model, broadcast_nodes=0)
        key = [*FEATURES, "y"]
        both = a.join(b.withColumnRenamed("prediction", "other"), key)
        assert both.count() == 900
        assert both.agg(F.max(F.abs(F.col("prediction") - F.col("other")))).first()[0] < 1e-9


def test_bootstrap_forest_generalises_and_is_the_same_on_any_partitioning(spark, tmp_dir):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 3))
    y = 3 * x[:, 0] - 2 * x[:, 1] + rng.normal(scale=0.3, size=1500)
    df = table(spark, x, y)
    train, test = df.filter("a < 1"), df.filter("a < 1").sample(0.2, 1)
    fresh = table(spark, x + 0.01, y)
    model = forest.fit_random_forest(train, FEATURES, "y", max_depth=None, num_trees=30)
    again = forest.fit_random_forest(train.repartition(9), FEATURES, "y", max_depth=None, num_trees=30)
    keep = ["tree", "part", "node", "feature", "threshold", "value"]
    assert sorted(map(str, model.nodes.select(keep).collect())) == sorted(map(str, again.nodes.select(keep).collect()))
    r2 = metrics.regression_metrics(forest.predict(model, fresh.filter("a < 1")), "y", "prediction").first().r2
    assert r2 > 0.93
    weights = model.nodes.filter("part = 0 and node = 0").agg(F.avg("weight"), F.countDistinct("weight")).first()
    assert abs(weights[0] / train.count() - 1) < 0.05 and weights[1] > 10
    imp = {r.feature: r.importance for r in forest.feature_importances(spark, model, FEATURES).collect()}
    assert abs(sum(imp.values()) - 1) < 1e-9 and imp["a"] > imp["b"] > 5 * imp["c"]
    forest.save_model(model, f"{tmp_dir}/forest")
    loaded = forest.load_model(f"{tmp_dir}/forest")
    a, b = (forest.predict(m, test, "p").agg(F.sum("p")).first()[0] for m in (model, loaded))
    assert a == pytest.approx(b)


def test_a_group_finishes_a_bounded_number_of_rows_whatever_is_asked(spark, monkeypatch):
    """One part with an eighth of any table grew with it; scoring copied every part per share."""
    monkeypatch.setattr(grower, "FINISH_ROWS", 200)
    df = spark.range(1500).selectExpr("cast(id as double) as a", "cast(id % 7 as double) as b",
                                      "cast(id % 3 as double) as c", "cast(id * 5 % 1499 as double) as y")
    model = grower.fit_grown_forest(df, FEATURES, "y", num_trees=1, bootstrap=False, finish_rows=10_000)
    roots = model.nodes.where(f"part <> {grower.TOP} and node = 0")
    assert roots.agg(F.max("weight")).first()[0] <= 200
    scored = grower.predict_grown(df, model, broadcast_nodes=0)
    assert scored.count() == 1500 and not scored.where("abs(prediction - y) > 1e-9 or prediction is null").count()


def test_training_rows_are_dealt_over_bounded_partitions(spark, monkeypatch):
    """MLlib holds and reads a partition's rows times the number of trees."""
    df = spark.range(4000).selectExpr("cast(id as double) as a", "id * 2.0 as y").coalesce(1).checkpoint()
    assert forest._spread(df, 100, 1) is df
    monkeypatch.setattr(forest, "PARTITION_BYTES", 868 * 500)
    out = forest._spread(df, 100, 1)
    assert out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] <= 510
    assert out.count() == 4000 and not out.exceptAll(df).count()


def test_rows_are_grouped_by_node_in_one_pass_over_them():
    rng = np.random.default_rng(5)

    class Counted(np.ndarray):
        passes = 0

        def __eq__(self, other):
            Counted.passes += 1
            return super().__eq__(other)

    at, keep = rng.integers(0, 300, 5000), rng.random(5000) < 0.7
    got = dict(grower._rows_by_node(at.view(Counted), keep))
    assert Counted.passes == 0
    want = {n: np.flatnonzero((at == n) & keep) for n in range(300)}
    assert got.keys() == {n for n, r in want.items() if len(r)}
    assert all((got[n] == want[n]).all() for n in got)
    assert not list(grower._rows_by_node(at[:0], keep[:0]))
