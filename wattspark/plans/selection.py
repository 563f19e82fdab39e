"""Telemetry selection: the bucket query, inventory lookup and plugin runs.

The long telemetry table holds every plugin (column ``plugin``).  A
selection is a filter chain on it; when the table is stored partitioned by
``plugin`` (and a date column) the plugin and time predicates prune files at
the scan, and the remaining predicates are evaluated right after it.  The
per-inventory-id loop of the original tool becomes one semi-join (equality
ids) or one regex theta join on distinct URLs, both a single Spark job.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattspark.functions.timeops import parse_range
from wattspark.operators.joins import (
    broadcast_if_small, materialize_small, regex_match_join, semi_join_values,
)
from wattspark.operators.select import (
    col, distinct_pairs, distinct_trimmed, export_name, filter_time_range,
)
from wattspark.schemas import (
    ALL_PLUGINS, DEFAULT_CLUSTER_FILTER, DEFAULT_VM_NAME_FILTER, HOST_POWER_FIELD,
)

SERVER = "inventory-server-id"
EXPORT = "export_name"

# plugins whose series carry no vm_name; the vm_name filter is skipped
_NO_VM_NAME = {"pdu", "k8s", "kepler"}
_DEFAULT_CLUSTER_PLUGINS = {"k8s", "kepler"}


@dataclass(frozen=True)
class TelemetrySpec:
    """What one bucket query selects."""

    plugin: str
    start: datetime
    stop: datetime
    field: str | None = None
    inventory_id: str | None = None
    vm_name_filter: str | None = None
    url_match: str | None = None

    @classmethod
    def from_range(cls, plugin: str, range_spec: str, now: datetime | None = None, **kw):
        start, stop = parse_range(range_spec, now)
        return cls(plugin, start, stop, **kw)


def _where_col(df: DataFrame, name: str, cond):
    # a tag the rows do not have never matches
    return df.where(cond) if name in df.columns else df.where(F.lit(False))


def select_telemetry(tel: DataFrame, spec: TelemetrySpec) -> DataFrame:
    """Rows of ``tel`` the bucket query for ``spec`` returns.

    On the partitioned store (a ``date`` partition column) the date bounds
    are added so the scan lists only the matching directories.
    """
    if "date" in tel.columns:
        from wattspark.sources.telemetry import prune

        df = prune(tel, spec.plugin, spec.start, spec.stop)
    else:
        df = tel.where(F.col("plugin") == spec.plugin)
        df = filter_time_range(df, spec.start, spec.stop)
    if spec.field:
        df = df.where(F.col("_field") == spec.field)
    if spec.vm_name_filter and spec.plugin not in _NO_VM_NAME:
        df = _where_col(df, "vm_name", col("vm_name").rlike(spec.vm_name_filter))
    if spec.inventory_id and spec.plugin != "scaphandre":
        df = _where_col(df, SERVER, col(SERVER) == spec.inventory_id)
    elif not spec.inventory_id and spec.plugin in _DEFAULT_CLUSTER_PLUGINS:
        df = _where_col(df, SERVER, col(SERVER).rlike(DEFAULT_CLUSTER_FILTER))
    if spec.url_match and spec.field:
        df = _where_col(df, "url", col("url").rlike(spec.url_match))
    return df


def _proxmox_vms(tel: DataFrame, start: datetime, stop: datetime, vm_name_filter: str) -> DataFrame:
    """Proxmox rows of the matching VMs in the range; on the store only the
    days of the range are listed."""
    if "date" in tel.columns:
        from wattspark.sources.telemetry import prune

        df = prune(tel, "proxmox", start, stop)
    else:
        df = filter_time_range(tel.where(F.col("plugin") == "proxmox"), start, stop)
    return _where_col(df, "vm_name", col("vm_name").rlike(vm_name_filter))


def inventory_ids(tel: DataFrame, start: datetime, stop: datetime,
                  vm_name_filter: str = DEFAULT_VM_NAME_FILTER, sort: bool = True) -> DataFrame:
    """Distinct trimmed, non-blank server ids of the matching Proxmox VMs."""
    df = _proxmox_vms(tel, start, stop, vm_name_filter)
    return distinct_trimmed(df, SERVER, alias=SERVER, sort=sort)


def host_vm_pairs(tel: DataFrame, start: datetime, stop: datetime,
                  vm_name_filter: str = DEFAULT_VM_NAME_FILTER) -> DataFrame:
    """Distinct (server, vm_name) pairs of the matching Proxmox VMs."""
    df = _proxmox_vms(tel, start, stop, vm_name_filter)
    return distinct_pairs(df, SERVER, "vm_name")


def lookup_inventory(tel: DataFrame, start: datetime, stop: datetime,
                     vm_name_filter: str = DEFAULT_VM_NAME_FILTER) -> tuple[DataFrame, int]:
    """Inventory ids materialised once (checkpoint) with their count."""
    return materialize_small(inventory_ids(tel, start, stop, vm_name_filter, sort=False))


def run_plugin(tel: DataFrame, plugin: str, start: datetime, stop: datetime, *,
               field: str | None = None,
               vm_name_filter: str = DEFAULT_VM_NAME_FILTER,
               inventory: tuple[DataFrame, int] | None = None) -> DataFrame:
    """Everything one plugin run exports, with its ``export_name``.

    1. look up the inventory ids (Proxmox VMs matching ``vm_name_filter``);
       with none, nothing is selected for any plugin (existence gate);
    2. PDU, and scaphandre with a field: one selection per id, expressed as
       a single join in one plan:
       PDU by an equi-join with the distinct ids (with a field also
       ``url =~ /id/``, as in every selection by field and id), scaphandre
       host power by
       ``url =~ /id/`` (regex theta join on distinct URLs); a row matching
       several ids is exported once per id;
    3. otherwise one selection with the vm_name filter (k8s/Kepler default
       to servers matching the cluster name).

    ``inventory`` passes an already materialised (ids, count) so several
    runs share one lookup.
    """
    ids, n_ids = inventory or lookup_inventory(tel, start, stop, vm_name_filter)
    if (plugin == "scaphandre" and field) or plugin == "pdu":
        base = select_telemetry(tel, TelemetrySpec(plugin, start, stop, field=field))
        if plugin == "pdu":
            if SERVER not in base.columns:
                out = base.where(F.lit(False)).withColumn(EXPORT, F.lit(None).cast("string"))
            else:
                ids_named = broadcast_if_small(ids.select(col(SERVER).alias("__id")), n_ids)
                out = base.join(ids_named, col(SERVER) == F.col("__id"), "inner")
                if field:
                    out = _where_col(out, "url", F.expr("url rlike __id"))
                out = out.withColumn(EXPORT, F.col("__id")).drop("__id")
        else:
            out = regex_match_join(base, ids.select(col(SERVER).alias(EXPORT)), "url", EXPORT)
    else:
        spec = TelemetrySpec(plugin, start, stop, field=field, vm_name_filter=vm_name_filter)
        out = select_telemetry(tel, spec)
        name = DEFAULT_CLUSTER_FILTER if plugin in _DEFAULT_CLUSTER_PLUGINS \
            else export_name(None, vm_name_filter)
        out = out.withColumn(EXPORT, F.lit(name))
    # existence gate: the id set is already materialised and counted, so the
    # gate is a constant Catalyst folds (no join needed)
    return out if n_ids > 0 else out.where(F.lit(False))


def select_all_plugins(tel: DataFrame, start: datetime, stop: datetime, *,
                       vm_name_filter: str = DEFAULT_VM_NAME_FILTER) -> DataFrame:
    """The 'all' run: every plugin, scaphandre twice (VM pass, host pass).

    The inventory lookup runs once and is shared; the rest is one plan: the
    union of the per-plugin runs, tagged with ``run_plugin`` and ``pass``.
    """
    inventory = lookup_inventory(tel, start, stop, vm_name_filter)
    parts = []
    for plg in ALL_PLUGINS:
        passes = [("vm", None), ("host", HOST_POWER_FIELD)] if plg == "scaphandre" else [("main", None)]
        for pass_name, field in passes:
            df = run_plugin(tel, plg, start, stop, field=field, vm_name_filter=vm_name_filter,
                            inventory=inventory)
            parts.append(df.withColumn("run_plugin", F.lit(plg)).withColumn("pass", F.lit(pass_name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def semi_join_inventory(tel: DataFrame, ids: DataFrame, column: str = SERVER) -> DataFrame:
    """Rows whose ``column`` is one of the inventory ids."""
    return semi_join_values(tel, ids, column, SERVER)
