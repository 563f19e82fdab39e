"""Datasets from processed tables that are stored in buckets of their entities.

Both tables of a dataset are bucketed by the join keys without time: (container, namespace,
pod), or the VM.  Buckets satisfy the time-aligned grouping and join, which have the same keys
and the time bucket, so rebuilding a dataset at any interval shuffles nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattspark.plans import datasets
from wattspark.schemas import ENERGY_JOIN_KEYS, VM_JOIN_KEYS
from wattspark.sources import sinks

#: Entity keys of each dataset's two tables.
BUCKET_KEYS = {"energy": [k for k in ENERGY_JOIN_KEYS if k != "_time"],
               "vm_power": [k for k in VM_JOIN_KEYS if k != "_time"]}
_CONF = {"spark.sql.requireAllClusterKeysForCoPartition": "false",
         "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def store_tables(kind: str, left: DataFrame, right: DataFrame, folder: str, name: str,
                 buckets: int = 64) -> None:
    """Store the two processed tables of a dataset as ``<name>_left`` and ``<name>_right``."""
    for side, df in (("left", left), ("right", right)):
        sinks.write_bucketed(df, f"{name}_{side}", BUCKET_KEYS[kind], buckets, f"{folder.rstrip('/')}/{side}")


def stored_dataset(spark: SparkSession, kind: str, name: str, output: str,
                   interval: str = "1min") -> DataFrame:
    """Build a dataset from its stored tables into ``output`` without an exchange.

    The settings that let buckets of part of the keys serve a join are those of this
    write alone."""
    build = {"energy": datasets.energy_dataset, "vm_power": datasets.vm_power_dataset}[kind]
    old = {k: spark.conf.get(k, None) for k in _CONF}
    try:
        for k, v in _CONF.items():
            spark.conf.set(k, v)
        out = build(spark.table(f"{name}_left"), spark.table(f"{name}_right"), interval)
        out.write.mode("overwrite").parquet(output)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    return spark.read.parquet(output)
