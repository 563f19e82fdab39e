"""End-to-end workflows: selection -> processing -> dataset -> model -> metrics.

Each workflow is the composition of the library's plans; the only values
brought to the driver are model-sized (trees, weights, scaler) or one-row
metrics.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattspark.operators.learn import anomaly, dense, forest, metrics, scale, split
from wattspark.operators.learn.sync import fit_dense_sync as sync_fit
from wattspark.plans import datasets, preprocess, selection
from wattspark.session import path_exists
from wattspark.sources import sinks
from wattspark.schemas import (
    ANOMALY_FEATURES, DEFAULT_VM_NAME_FILTER, ENERGY_FEATURES, ENERGY_TARGET, VM_FEATURES, VM_TARGET,
)


@dataclass
class WorkflowResult:
    dataset: DataFrame
    splits: DataFrame
    model: object
    scored: DataFrame
    metrics: DataFrame
    history: DataFrame | None = None


def _store(output: str | None, splits: DataFrame, result_metrics: DataFrame, run_id: str,
           save) -> None:
    """Write a run's splits, model and metrics under ``output`` (if given):
    ``splits`` and ``model`` are replaced, ``metrics`` gets one more row."""
    if not output:
        return
    base = output.rstrip("/")
    sinks.write_splits(splits, f"{base}/splits")
    save(f"{base}/model")
    sinks.append_metrics(result_metrics.select(F.lit(run_id).alias("run_id"), "*"),
                         f"{base}/metrics")


def _plugin_long(tel: DataFrame, plugin: str, start, stop, vm_name_filter: str, inventory,
                 field=None):
    return selection.run_plugin(tel, plugin, start, stop, field=field,
                                vm_name_filter=vm_name_filter,
                                inventory=inventory).drop("export_name")


def energy_workflow(tel: DataFrame, start: datetime, stop: datetime, *,
                    vm_name_filter: str = DEFAULT_VM_NAME_FILTER, interval: str = "1min",
                    features=ENERGY_FEATURES, target: str = ENERGY_TARGET,
                    test_size: float = 0.2, seed: int = 42, num_trees: int = 100,
                    max_depth: int | None = None, split_key=None, output: str | None = None,
                    run_id: str = "energy") -> WorkflowResult:
    """Kepler + k8s selection -> processing -> energy dataset -> split ->
    random forest (``max_depth=None``: unlimited trees) -> test predictions ->
    MAE / MSE / R2.  ``output`` names a folder that receives the splits, the model and the metrics."""
    inv = selection.lookup_inventory(tel, start, stop, vm_name_filter)   # once, shared
    kep = preprocess.prep_kepler(_plugin_long(tel, "kepler", start, stop, vm_name_filter, inv))
    k8s = preprocess.prep_k8s(_plugin_long(tel, "k8s", start, stop, vm_name_filter, inv))
    data = datasets.energy_dataset(k8s, kep, interval)
    splits = split.train_test_split(data, test_size, seed, key_cols=split_key).checkpoint(eager=True)
    train = splits.where(F.col("split") == "train")
    test = splits.where(F.col("split") == "test")
    # the splits are already a reliable checkpoint: no second one for the forest
    model = forest.fit_random_forest(train, features, target, num_trees=num_trees, seed=seed,
                                     max_depth=max_depth, checkpoint=False)
    scored = forest.predict(model, test)
    m = metrics.regression_metrics(scored, target, "prediction")
    m = m.withColumn("n_train", F.lit(train.count()).cast("bigint"))
    _store(output, splits, m, run_id, lambda path: forest.save_model(model, path))
    return WorkflowResult(data, splits, model, scored, m)


def vm_power_workflow(tel: DataFrame, start: datetime, stop: datetime, *,
                      vm_name_filter: str = DEFAULT_VM_NAME_FILTER, interval: str = "1min",
                      features=VM_FEATURES, target: str = VM_TARGET, test_size: float = 0.2,
                      seed: int = 42, epochs: int = 20, lr: float = 1e-3, batch_size: int = 32,
                      hidden=(128, 64), num_partitions: int | None = None,
                      sync: bool = False, split_key=None, output: str | None = None,
                      run_id: str = "vm_power") -> WorkflowResult:
    """Proxmox + scaphandre selection -> processing -> VM power dataset ->
    split -> scaler fitted on train -> MLP -> test predictions -> metrics.
    ``sync`` takes a step per global minibatch (:mod:`sync`) instead of
    averaging per epoch.  ``output`` names a folder that receives the splits,
    the model and the metrics."""
    inv = selection.lookup_inventory(tel, start, stop, vm_name_filter)   # once, shared
    prox = preprocess.prep_proxmox(_plugin_long(tel, "proxmox", start, stop, vm_name_filter, inv))
    vm = preprocess.prep_scaphandre_vm(_plugin_long(tel, "scaphandre", start, stop, vm_name_filter,
                                                    inv))
    data = datasets.vm_power_dataset(prox, vm, interval)
    splits = split.train_test_split(data, test_size, seed, key_cols=split_key).checkpoint(eager=True)
    train = splits.where(F.col("split") == "train")
    test = splits.where(F.col("split") == "test")
    scaler = scale.scaler_values(scale.fit_standard_scaler(train, features))  # one row
    scaled = scale.transform_standard(train, scaler, features)
    args = dict(epochs=epochs, lr=lr, batch_size=batch_size, seed=seed)
    if sync:
        model, history = sync_fit(scaled, features, [target], hidden, workers=num_partitions, **args)
    else:
        model, history = dense.fit_dense(scaled, features, [target], hidden,
                                         num_partitions=num_partitions, **args)
    model.scaler_mean, model.scaler_scale = scale.scaler_arrays(scaler, features)
    scored = dense.predict_dense(test, model)
    m = metrics.regression_metrics(scored, target, "prediction")
    m = m.withColumn("n_train", F.lit(train.count()).cast("bigint"))
    _store(output, splits, m, run_id,
           lambda path: dense.save_dense(tel.sparkSession, model, path))
    return WorkflowResult(data, splits, model, scored, m, history)


def anomaly_workflow(vm_dataset: DataFrame, *, features=ANOMALY_FEATURES, epochs: int = 50,
                     batch_size: int = 64, lr: float = 1e-3, seed: int = 42,
                     validation_fraction: float = 0.1, k: float = 3.0,
                     num_partitions: int | None = None):
    """VM power dataset -> autoencoder -> reconstruction errors -> flags.

    The dataset is materialised once and shared by training and scoring.
    Returns (flagged rows, model, loss history).
    """
    vm_dataset = vm_dataset.checkpoint(eager=True)
    model, history = anomaly.fit_autoencoder(vm_dataset, features, epochs=epochs,
                                             batch_size=batch_size, lr=lr, seed=seed,
                                             validation_fraction=validation_fraction,
                                             num_partitions=num_partitions)
    flagged = anomaly.score_anomalies(vm_dataset, model, k)
    return flagged, model, history


def batch_score(model_path: str, df: DataFrame) -> DataFrame:
    """Score any DataFrame with a stored model (the served-model use).

    Forests and networks add ``prediction``; a network whose targets are its
    features adds ``reconstruction_error``, ``threshold`` and ``is_anomaly``."""
    path, spark = model_path.rstrip("/"), df.sparkSession
    if any(path_exists(spark, f"{path}/{mark}") for mark in ("forest", "metadata")):
        return forest.predict(forest.load_model(path), df)
    model = dense.load_dense(spark, path)
    if model.targets == model.features:
        return anomaly.score_anomalies(df, model)
    return dense.predict_dense(df, model)
