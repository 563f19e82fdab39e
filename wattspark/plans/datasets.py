"""Training datasets: time-aligned joins of two processed sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattspark.functions import units
from wattspark.functions.timeops import floor_time
from wattspark.operators.aggregate import group_aggregate
from wattspark.operators.joins import skew_split_join
from wattspark.operators.select import contains
from wattspark.schemas import (
    ENERGY_JOIN_KEYS, ENERGY_K8S_COLUMNS, ENERGY_KEPLER_COLUMNS, ENERGY_OUTPUT,
    VM_JOIN_KEYS, VM_PROXMOX_COLUMNS, VM_SCAPH_AGG,
)


def align_time(df: DataFrame, interval: str = "1min", col: str = "_time") -> DataFrame:
    """Floor ``col`` to ``interval`` keeping its timestamp type."""
    ntz = isinstance(df.schema[col].dataType, T.TimestampNTZType)
    return df.withColumn(col, floor_time(F.col(col), interval, ntz=ntz))


def kepler_energy(kepler_wide: DataFrame, interval: str = "1min") -> DataFrame:
    """Joules summed per (time bucket, container, namespace, pod)."""
    kep = align_time(kepler_wide, interval)
    return group_aggregate(kep, ENERGY_JOIN_KEYS, {"kepler_container_joules_total": "sum"})


def _join(left: DataFrame, right: DataFrame, keys, skew: str) -> DataFrame:
    """``skew='aqe'``: one shuffle join, AQE splits skewed partitions at run
    time; ``skew='split'``: hot keys isolated explicitly (skew_split_join)."""
    if skew == "split":
        return skew_split_join(left, right, keys, "inner")
    if skew != "aqe":
        raise ValueError("skew must be 'aqe' or 'split'")
    return left.join(right, on=keys, how="inner")


def energy_join(k8s_wide: DataFrame, kepler_wide: DataFrame,
                interval: str = "1min", skew: str = "aqe") -> DataFrame:
    """Complete k8s rows inner-joined to the bucketed Kepler energy (fan-out
    kept: every k8s row of a bucket gets the bucket's energy)."""
    k8s = align_time(k8s_wide, interval).select(*ENERGY_K8S_COLUMNS).na.drop("any")
    kep = kepler_energy(kepler_wide, interval).select(*ENERGY_KEPLER_COLUMNS).na.drop("any")
    return _join(k8s, kep, ENERGY_JOIN_KEYS, skew)


def energy_dataset(k8s_wide: DataFrame, kepler_wide: DataFrame,
                   interval: str = "1min", skew: str = "aqe") -> DataFrame:
    """Container energy dataset.

    1. floor both sides' ``_time`` to ``interval``;
    2. sum Kepler joules per (time, container, namespace, pod), collapsing
       container ids (an all-missing group sums to 0.0);
    3. inner-join the complete k8s rows to it.  The k8s side is *not*
       aggregated: every scrape (and node) in a bucket receives the bucket's
       energy, so rows fan out;
    4. derive cpu_millicores, memory_usage_mb, logsfs_usage_percent (0 when
       capacity is not positive) and container_power_watts (joules / 60 s,
       fixed whatever ``interval`` is), then drop rows with a missing value.

    Plan: one aggregation exchange on the Kepler side, one shuffle join on
    the four keys (AQE turns it into a broadcast join when the aggregated
    side is measured small, and splits a hot key's partition otherwise).
    ``skew='split'`` isolates hot keys explicitly instead.
    """
    return energy_features(energy_join(k8s_wide, kepler_wide, interval, skew))


def energy_features(joined: DataFrame) -> DataFrame:
    """The dataset's columns from joined k8s and Kepler columns; incomplete rows are dropped."""
    out = joined.select(
        *ENERGY_JOIN_KEYS,
        units.nanocores_to_millicores("cpu_usage_nanocores").alias("cpu_millicores"),
        units.bytes_to_mib("memory_usage_bytes").alias("memory_usage_mb"),
        units.guarded_percent("logsfs_used_bytes", "logsfs_capacity_bytes")
        .alias("logsfs_usage_percent"),
        units.joules_to_watts("kepler_container_joules_total").alias("container_power_watts"),
    )
    return out.select(*ENERGY_OUTPUT).na.drop("any")


def scaphandre_vm_aggregate(scaph_vm_wide: DataFrame, interval: str = "1min",
                            vm_name_marker: str = "k8s") -> DataFrame:
    """Scaphandre VM metrics per (time bucket, vm_id): means and 0.0-default sums."""
    scaph = align_time(contains(scaph_vm_wide, "vm_name", vm_name_marker), interval)
    return group_aggregate(scaph, VM_JOIN_KEYS, VM_SCAPH_AGG)


def vm_power_join(proxmox_wide: DataFrame, scaph_vm_wide: DataFrame, interval: str = "1min",
                  vm_name_marker: str = "k8s", skew: str = "aqe") -> DataFrame:
    """Complete Proxmox rows inner-joined to the aggregated scaphandre rows."""
    prox = align_time(contains(proxmox_wide, "vm_name", vm_name_marker), interval)
    prox = prox.select(*VM_PROXMOX_COLUMNS).na.drop("any")
    scaph = scaphandre_vm_aggregate(scaph_vm_wide, interval, vm_name_marker)
    return _join(prox, scaph, VM_JOIN_KEYS, skew)


def vm_power_dataset(proxmox_wide: DataFrame, scaph_vm_wide: DataFrame,
                     interval: str = "1min", vm_name_marker: str = "k8s",
                     skew: str = "aqe") -> DataFrame:
    """VM power dataset.

    Keeps VMs whose name contains ``vm_name_marker`` (case-sensitive, a
    missing name never matches) on both sides, floors time, aggregates the
    scaphandre side per (time, vm_id) (mean of CPU and memory, 0.0-default
    sums of disk and power), inner-joins the complete Proxmox rows (not
    aggregated, so rows fan out), adds uptime_hours and vm_power_watts and
    drops rows with a missing value.
    """
    joined = vm_power_join(proxmox_wide, scaph_vm_wide, interval, vm_name_marker, skew)
    extra = {
        "uptime_hours": units.seconds_to_hours("uptime"),
        "vm_power_watts": units.microwatts_to_watts("scaph_process_power_consumption_microwatts"),
    }
    cols = set(joined.columns)
    if "mem_used_percentage" not in cols:
        extra["mem_used_percentage"] = units.ratio_percent("mem_used", "mem_total")
    if "swap_used_percentage" not in cols and {"swap_used", "swap_total"} <= cols:
        extra["swap_used_percentage"] = units.ratio_percent("swap_used", "swap_total")
    return joined.withColumns(extra).na.drop("any")
