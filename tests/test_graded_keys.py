"""A model that answers a constant must turn the catalog's learning keys red."""

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from wattspark.catalog import queries
from wattspark.operators.learn import dense, forest


@pytest.mark.parametrize("key, module, name", [
    ("rf_energy", forest, "predict"), ("rf_vm_power", forest, "predict"), ("batch_score", forest, "predict"),
    ("mlp_vm_power", dense, "predict_dense")])
def test_constant_model_fails(spark, monkeypatch, key, module, name):
    monkeypatch.setattr(queries, "FOREST_DEPTH", 2)
    monkeypatch.setattr(module, name, lambda a, b: (a if hasattr(a, "columns") else b).withColumn(
        "prediction", F.lit(80.0)))
    rows = queries.queries()[key](spark, SF001).select("fits").distinct().collect()
    assert [r.fits for r in rows] == [False]


def test_untrained_network_fails(spark, monkeypatch):
    real = dense.fit_dense
    monkeypatch.setattr(dense, "fit_dense", lambda *a, **k: real(*a, **{**k, "lr": 0.0}))
    assert {r.fell for r in queries.queries()["loss_history"](spark, SF001).collect()} == {False}


def test_flat_importances_fail(spark, monkeypatch):
    monkeypatch.setattr(forest, "feature_importances", lambda s, m, f: s.createDataFrame(
        [(c, 1 / len(f)) for c in f], "feature string, importance double"))
    got = queries.queries()["feature_importance"](spark, SF001).filter("used").count()
    assert got == 3     # the oracle says two
