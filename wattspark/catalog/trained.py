"""Registered queries whose model numbers SQL can state.

Linear networks are trained by the synchronous trainer (the oracle repeats every Adam step
from the batches' moments), trees without depth limit and bootstrap predict the mean of their
training rows with equal features, and a planted label gives known importances.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wattspark.catalog import queries as base
from wattspark.catalog.queries import register
from wattspark.operators.learn import anomaly, dense, forest, grower, sync
from wattspark.operators.learn import scale as lscale
from wattspark.plans import datasets, runs, workflows
from wattspark.schemas import ENERGY_FEATURES, ENERGY_TARGET, VM_FEATURES, VM_TARGET
from wattspark.session import scratch_path
from wattspark.sources import exports, sinks

LINEAR_FEATURES = ["cpuload", "mem_used_percentage", "uptime_hours"]
CODED_FEATURES = ["cpuload", "scaph_process_cpu_usage_percentage"]
BATCH, EPOCHS, RATE = 1024, 3, 0.05


def _linear(data, features, targets, workers):
    """A network without hidden layer on scaled columns, from zero weights, batches in the
    order of the rows' content.  Columns are not centred: the gradients of biases of centred
    columns are rounding noise, which Adam's division by their size would carry into the result."""
    every = list(dict.fromkeys([*features, *targets]))
    scaler = lscale.scaler_values(lscale.fit_standard_scaler(data, every))
    scaler = {k: 0.0 if k.startswith("mean_") else v for k, v in scaler.items()}
    scaled = lscale.transform_standard(data, scaler, every, suffix="_z")
    model, history = sync.fit_dense_sync(
        scaled, [f"{c}_z" for c in features], [f"{c}_z" for c in targets], (), epochs=EPOCHS, lr=RATE,
        batch_size=BATCH, workers=workers, shuffle=False, order_cols=["_time", "vm_id", *every],
        initial=[0.0] * ((len(features) + 1) * len(targets)))
    model.features, model.targets = list(features), list(targets)
    model.scaler_mean, model.scaler_scale = lscale.scaler_arrays(scaler, features)
    return model, history


@register("sync_training")
def q_sync_training(spark, sf_dir):
    """A step per global minibatch, with one worker and with two in barrier mode:
    weights and the loss of every epoch."""
    data = base.vm_power(spark, sf_dir).checkpoint(eager=True)
    out = None
    for workers in (1, 2):
        model, history = _linear(data, LINEAR_FEATURES, [VM_TARGET], workers)
        weights = spark.createDataFrame(
            [(name, EPOCHS, float(v)) for name, v in zip([*LINEAR_FEATURES, "bias"], model.params)],
            "name string, epoch int, value double")
        rows = weights.unionByName(history.select(F.lit("loss").alias("name"), "epoch",
                                                  F.col("loss").alias("value")))
        rows = rows.withColumn("workers", F.lit(workers))
        out = rows if out is None else out.unionByName(rows)
    return base.rnd(out, ["value"])


@register("batch_score_dense")
def q_batch_score_dense(spark, sf_dir):
    """A stored network (weights and scaler) applied to the whole VM dataset."""
    data = base.vm_power(spark, sf_dir).checkpoint(eager=True)
    model, _ = _linear(data, LINEAR_FEATURES, [VM_TARGET], 1)
    path = scratch_path(spark, "model-linear")
    dense.save_dense(spark, model, path)
    scored = workflows.batch_score(path, data)
    return base.rnd(base.ntz(scored.select("_time", "vm_id", "prediction")), ["prediction"])


@register("anomaly_errors")
def q_anomaly_errors(spark, sf_dir):
    """An autoencoder, stored, loaded and applied: reconstruction error,
    threshold and flag of every row."""
    data = base.vm_power(spark, sf_dir).checkpoint(eager=True)
    model, _ = _linear(data, CODED_FEATURES, CODED_FEATURES, 1)
    path = scratch_path(spark, "model-coder")
    dense.save_dense(spark, model, path)
    scored = workflows.batch_score(path, data)
    return base.rnd(base.ntz(scored.select("_time", "vm_id", "reconstruction_error", "threshold",
                                           "is_anomaly")), ["reconstruction_error", "threshold"])


@register("forest_unlimited")
def q_forest_unlimited(spark, sf_dir):
    """Trees grown until their leaves are pure, without bootstrap, on the energy
    train split: true and predicted power of its rows."""
    df = base.rnd(base.energy_split(spark, sf_dir), ENERGY_FEATURES, 4)
    train = df.where(F.col("split") == "train").checkpoint(eager=True)
    model = grower.fit_grown_forest(train, ENERGY_FEATURES, ENERGY_TARGET, num_trees=2,
                                    bootstrap=False)
    scored = forest.true_vs_predicted(forest.predict(model, train), ENERGY_TARGET, base.SPLIT_KEY)
    return base.rnd(base.ntz(scored), ["y_true", "y_pred"])


@register("forest_unlimited_scored")
def q_forest_unlimited_scored(spark, sf_dir):
    """An unlimited tree on scaled features, large nodes split by histograms,
    stored, loaded by the batch scorer and applied to its training rows."""
    df = base.rnd(base.vm_power(spark, sf_dir), VM_FEATURES, 4)
    df = df.checkpoint(eager=True)
    scaler = lscale.scaler_values(lscale.fit_standard_scaler(df, VM_FEATURES))
    scaled = lscale.transform_standard(df, scaler, VM_FEATURES)
    model = grower.fit_grown_forest(scaled, VM_FEATURES, VM_TARGET, num_trees=1, bootstrap=False,
                                    finish_rows=max(100, df.count() // 8))
    path = scratch_path(spark, "model-grown")
    forest.save_model(model, path)
    scored = forest.true_vs_predicted(workflows.batch_score(path, scaled), VM_TARGET,
                                      base.VM_SPLIT_KEY)
    return base.rnd(base.ntz(scored), ["y_true", "y_pred"])


@register("importance_planted")
def q_importance_planted(spark, sf_dir):
    """M7: importances where the label follows one feature and the other is constant."""
    df = base.energy(spark, sf_dir).withColumns(
        {"constant": F.lit(7.0), "planted": 2 * F.col("cpu_millicores") + 1})
    model = forest.fit_random_forest(df, ["cpu_millicores", "constant"], "planted", max_depth=None,
                                     num_trees=10)
    return base.rnd(forest.feature_importances(spark, model, ["cpu_millicores", "constant"]),
                    ["importance"])


@register("vm_power_dataset_1min")
def q_vm_power_dataset_1min(spark, sf_dir):
    """W7 at the one-minute interval, scrapes moved as in ``energy_dataset_1min``."""
    prox, vm = (base._PREP[s](base._closer(base.long(spark, sf_dir, s)))
                for s in ("proxmox", "scaphandre_vm"))
    return base.ntz(datasets.vm_power_dataset(prox, vm, interval="1min"))


@register("processed_two_outputs")
def q_processed_two_outputs(spark, sf_dir):
    """A folder of host and VM exports processed into two tables, read back."""
    path, out = scratch_path(spark, "exports-two"), scratch_path(spark, "processed-two")
    for source in ("scaphandre_host", "scaphandre_vm"):
        exports.write_exports(base.long(spark, sf_dir, source), path, source)
    runs.process_exports(spark, path, "scaphandre", out)
    host, vm = (sinks.read_table(spark, f"{out}/{k}") for k in ("host", "vm"))
    return base.ntz(
        host.select(F.lit("host").alias("route"), "_time", "url",
                    F.col("scaph_host_power_microwatts").alias("microwatts"))
        .unionByName(vm.select(F.lit("vm").alias("route"), "_time", "url", F.col(
            "scaph_process_power_consumption_microwatts").alias("microwatts"))))


@register("scan_paths")
def q_scan_paths(spark, sf_dir):
    """An explicit list of export files in two folders, combined."""
    rows = base.long(spark, sf_dir, "pdu")
    paths = []
    for part, name in enumerate(("even", "odd")):
        path = scratch_path(spark, f"exports-{name}")
        exports.write_exports(rows.where(F.hour("_time") % 2 == part), path, "pdu", run_id=name)
        paths.append(f"{path}/export=*_{name}/part-*")
    df = exports.read_exports(spark, "", "pdu", paths=exports.existing(spark, paths))
    return base.ntz(df.drop("_file", "_start", "_stop"))
