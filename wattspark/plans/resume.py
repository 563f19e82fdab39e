"""Runs that resume after the last finished stage.

A stage's folder is named by a fingerprint of everything its result follows from: its name, its
parameters, the source text of its function, the fingerprints of the stages before it
and the files it reads.  A stage writes its table or model there and is committed by a marker
written last; a run that finds the marker reads the result instead of computing it.
"""

from __future__ import annotations

import hashlib
import inspect
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspark.operators.learn import forest, metrics, split
from wattspark.plans import datasets, preprocess, selection
from wattspark.schemas import DEFAULT_VM_NAME_FILTER, ENERGY_FEATURES, ENERGY_TARGET
from wattspark.session import path_exists

DONE = "_DONE"


def input_fingerprint(df: DataFrame) -> str:
    """Names, lengths and times of the files a DataFrame reads, and its columns."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    facts = [str(df.schema.simpleString())]
    for name in sorted(df.inputFiles()):
        p = jvm.org.apache.hadoop.fs.Path(name)
        s = p.getFileSystem(conf).getFileStatus(p)
        facts.append(f"{name}|{s.getLen()}|{s.getModificationTime()}")
    return hashlib.sha256("\n".join(facts).encode()).hexdigest()


@dataclass
class Run:
    """The stages of a run below ``folder``; ``executed`` and ``reused`` name them in order."""

    spark: SparkSession
    folder: str
    executed: list[str] = field(default_factory=list)
    reused: list[str] = field(default_factory=list)

    def _path(self, name: str, facts: dict, fn: Callable) -> tuple[str, str]:
        text = json.dumps({"name": name, "code": inspect.getsource(fn), **facts}, sort_keys=True, default=str)
        mark = hashlib.sha256(text.encode()).hexdigest()[:24]
        return mark, f"{self.folder.rstrip('/')}/{name}-{mark}"

    def _commit(self, path: str, name: str) -> None:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{DONE}")
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(p, True).close()
        self.executed.append(name)

    def table(self, name: str, fn: Callable[..., DataFrame], after: tuple[str, ...] = (), **params):
        """(fingerprint, DataFrame) of a stage that returns a table."""
        mark, path = self._path(name, {"after": after, "params": params}, fn)
        if path_exists(self.spark, f"{path}/{DONE}"):
            self.reused.append(name)
        else:
            fn().write.mode("overwrite").parquet(f"{path}/table")
            self._commit(path, name)
        return mark, self.spark.read.parquet(f"{path}/table")

    def model(self, name: str, fn: Callable, after: tuple[str, ...] = (), **params):
        """(fingerprint, model) of a stage that fits a forest."""
        mark, path = self._path(name, {"after": after, "params": params}, fn)
        if path_exists(self.spark, f"{path}/{DONE}"):
            self.reused.append(name)
        else:
            forest.save_model(fn(), f"{path}/model")
            self._commit(path, name)
        return mark, forest.load_model(f"{path}/model")


def energy_run(tel: DataFrame, start: datetime, stop: datetime, folder: str, *,
               vm_name_filter: str = DEFAULT_VM_NAME_FILTER, interval: str = "1min",
               test_size: float = 0.2, seed: int = 42, num_trees: int = 100,
               max_depth: int | None = None, split_key=None) -> tuple[DataFrame, Run]:
    """The energy workflow in six committed stages: kepler, k8s, dataset, splits, model, metrics.

    Returns the metrics row and the run, which tells the executed stages.  Killed after any
    stage, the same call goes on from there; with other parameters, files or code it repeats
    just the stages that depend on them."""
    spark = tel.sparkSession
    run, source = Run(spark, folder), input_fingerprint(tel)
    window = {"start": start, "stop": stop, "filter": vm_name_filter}

    def long(plugin: str) -> DataFrame:
        inventory = selection.lookup_inventory(tel, start, stop, vm_name_filter)
        return selection.run_plugin(tel, plugin, start, stop, vm_name_filter=vm_name_filter,
                                    inventory=inventory).drop("export_name")

    def kepler_stage():
        return preprocess.prep_kepler(long("kepler"))

    def k8s_stage():
        return preprocess.prep_k8s(long("k8s"))

    a, kepler = run.table("kepler", kepler_stage, (source,), **window)
    b, k8s = run.table("k8s", k8s_stage, (source,), **window)

    def dataset_stage():
        return datasets.energy_dataset(k8s, kepler, interval)

    c, data = run.table("dataset", dataset_stage, (a, b), interval=interval)

    def splits_stage():
        return split.train_test_split(data, test_size, seed, key_cols=split_key)

    d, splits = run.table("splits", splits_stage, (c,), test_size=test_size, seed=seed, key=split_key)
    train, test = (splits.where(F.col("split") == k) for k in ("train", "test"))

    def model_stage():
        return forest.fit_random_forest(train, ENERGY_FEATURES, ENERGY_TARGET, num_trees=num_trees,
                                        seed=seed, max_depth=max_depth, checkpoint=False)

    e, model = run.model("model", model_stage, (d,), trees=num_trees, depth=max_depth, seed=seed)

    def metrics_stage():
        return metrics.regression_metrics(forest.predict(model, test), ENERGY_TARGET, "prediction")

    _, result = run.table("metrics", metrics_stage, (d, e))
    return result, run
