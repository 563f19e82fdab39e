"""Directory-level runs: a folder of exports in, processed tables out.

These are the everyday entry points of a telemetry user: process every
export of one source found in a folder into a processed table (two tables
for scaphandre, host and VM), and build a training dataset from two
processed tables.  Each run is one Spark plan per output table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattspark.plans import datasets, preprocess
from wattspark.sources import exports, sinks

_PREP = {
    "k8s": preprocess.prep_k8s,
    "kepler": preprocess.prep_kepler,
    "pdu": preprocess.prep_pdu,
    "proxmox": preprocess.prep_proxmox,
}


def process_exports(spark: SparkSession, directory: str, source: str,
                    output: str | None = None, *, fmt: str = "parquet",
                    sort: bool = False, one_header: bool = False, **options):
    """Scan every export of ``source`` in ``directory`` and process it.

    ``source`` is one of k8s, kepler, pdu, proxmox or scaphandre; the last
    returns (host, vm) tables, routed by file prefix.  With ``output`` the
    result is written there (``<output>/host`` and ``<output>/vm`` for
    scaphandre), rows ordered by time inside each file.  ``one_header``: all
    files of a source share one header, so their text is read once.
    """
    if source == "scaphandre":
        host_long, vm_long = exports.read_routed(spark, directory, one_header=one_header)
        host = preprocess.prep_scaphandre_host(host_long, sort=sort, **options)
        vm = preprocess.prep_scaphandre_vm(vm_long, sort=sort, **options)
        if output:
            sinks.write_table(host, f"{output.rstrip('/')}/host", fmt=fmt, sort_within="_time")
            sinks.write_table(vm, f"{output.rstrip('/')}/vm", fmt=fmt, sort_within="_time")
        return host, vm
    if source not in _PREP:
        raise ValueError(f"unknown source {source!r}")
    long = exports.read_exports(spark, directory, source, one_header=one_header)
    wide = _PREP[source](long, sort=sort, **options)
    if output:
        sinks.write_table(wide, output, fmt=fmt, sort_within="_time")
    return wide


def build_dataset(spark: SparkSession, kind: str, left_path: str, right_path: str,
                  output: str | None = None, *, interval: str = "1min",
                  fmt: str = "parquet", **options) -> DataFrame:
    """Build a dataset from two processed tables (types preserved by Parquet).

    ``kind='energy'``: k8s table + Kepler table; ``kind='vm_power'``: Proxmox
    table + scaphandre VM table.
    """
    left = sinks.read_table(spark, left_path, fmt)
    right = sinks.read_table(spark, right_path, fmt)
    if kind == "energy":
        out = datasets.energy_dataset(left, right, interval, **options)
    elif kind == "vm_power":
        out = datasets.vm_power_dataset(left, right, interval, **options)
    else:
        raise ValueError("kind must be 'energy' or 'vm_power'")
    if output:
        sinks.write_table(out, output, fmt=fmt)
    return out
