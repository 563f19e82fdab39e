"""Source descriptions: raw column layouts, declared field lists, index keys.

The long-format telemetry has one row per (series tags, ``_time``, ``_field``,
``_value``).  Each plugin ("source") adds its own tag columns.  The wide
(processed) table of a source has one row per index key and one double column
per declared field, so every pivot has a static schema known at plan time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These names must equal the reference's for results to match
# (plugin names, file prefixes, declared metric fields, index keys, dropped
# bookkeeping columns, and the dataset column lists).
# ---------------------------------------------------------------------------

ALL_PLUGINS = ["proxmox", "pdu", "scaphandre", "k8s", "kepler"]

K8S_FIELDS = [
    "available_bytes", "capacity_bytes", "cpu_usage_core_nanoseconds", "cpu_usage_nanocores",
    "fs_available_bytes", "fs_capacity_bytes", "fs_used_bytes", "logsfs_available_bytes",
    "logsfs_capacity_bytes", "logsfs_used_bytes", "memory_available_bytes",
    "memory_major_page_faults", "memory_page_faults", "memory_rss_bytes", "memory_usage_bytes",
    "memory_working_set_bytes", "network_rx_bytes", "network_rx_errors", "network_tx_bytes",
    "network_tx_errors", "rootfs_available_bytes", "rootfs_capacity_bytes", "rootfs_used_bytes",
    "runtime_image_fs_available_bytes", "runtime_image_fs_capacity_bytes",
    "runtime_image_fs_used_bytes", "rx_bytes", "rx_errors", "tx_bytes", "tx_errors", "used_bytes",
]
KEPLER_FIELDS = ["kepler_container_joules_total", "kepler_container_microwatts_consumption_total"]
PDU_FIELDS = [
    "activePower", "apparentPower", "cumulatedEnergy", "current", "currentTHD", "partialEnergy",
    "peakFactor", "powerFactor", "reactivePower",
]
PROXMOX_FIELDS = [
    "cpuload", "disk_free", "disk_total", "disk_used", "disk_used_percentage", "mem_free",
    "mem_total", "mem_used", "mem_used_percentage", "status", "swap_free", "swap_total",
    "swap_used", "swap_used_percentage", "uptime",
]
SCAPH_HOST_FIELDS = ["scaph_host_power_microwatts"]
SCAPH_VM_FIELDS = [
    "scaph_process_cpu_usage_percentage", "scaph_process_disk_read_bytes",
    "scaph_process_disk_total_read_bytes", "scaph_process_disk_total_write_bytes",
    "scaph_process_disk_write_bytes", "scaph_process_memory_bytes",
    "scaph_process_memory_virtual_bytes", "scaph_process_power_consumption_microwatts",
]

K8S_DROP = [
    "result", "table", "_start", "_stop", "_measurement",
    "inventory-cluster-id", "inventory-rack-id", "inventory-server-id", "plugin",
]

# Energy dataset (container power) column lists.
ENERGY_K8S_COLUMNS = [
    "_time", "container_name", "namespace", "pod_name",
    "cpu_usage_nanocores", "memory_usage_bytes", "logsfs_used_bytes", "logsfs_capacity_bytes",
]
ENERGY_KEPLER_COLUMNS = ["_time", "container_name", "namespace", "pod_name",
                         "kepler_container_joules_total"]
ENERGY_JOIN_KEYS = ["_time", "container_name", "namespace", "pod_name"]
ENERGY_OUTPUT = [
    "_time", "container_name", "namespace", "pod_name",
    "cpu_millicores", "memory_usage_mb", "logsfs_usage_percent", "container_power_watts",
]

# VM power dataset column lists.
VM_PROXMOX_COLUMNS = [
    "_time", "vm_id", "cpuload", "disk_free", "disk_total", "disk_used", "disk_used_percentage",
    "mem_free", "mem_total", "mem_used", "mem_used_percentage",
    "swap_free", "swap_total", "swap_used", "swap_used_percentage",
    "uptime", "disk_free_gb", "disk_total_gb", "disk_used_gb", "disk_usage_percent",
]
VM_SCAPH_AGG = {
    "scaph_process_cpu_usage_percentage": "mean",
    "scaph_process_disk_read_bytes": "sum",
    "scaph_process_disk_total_read_bytes": "sum",
    "scaph_process_disk_total_write_bytes": "sum",
    "scaph_process_disk_write_bytes": "sum",
    "scaph_process_memory_bytes": "mean",
    "scaph_process_memory_virtual_bytes": "mean",
    "scaph_process_power_consumption_microwatts": "sum",
}
VM_JOIN_KEYS = ["_time", "vm_id"]

# Model inputs.
ENERGY_FEATURES = ["cpu_millicores", "memory_usage_mb", "logsfs_usage_percent"]
ENERGY_TARGET = "container_power_watts"
VM_FEATURES = [
    "cpuload", "mem_used_percentage", "swap_used_percentage", "disk_used_percentage",
    "uptime_hours", "scaph_process_cpu_usage_percentage", "scaph_process_memory_bytes",
    "scaph_process_memory_virtual_bytes", "scaph_process_disk_total_read_bytes",
    "scaph_process_disk_total_write_bytes",
]
VM_TARGET = "vm_power_watts"
ANOMALY_FEATURES = [
    "cpuload", "mem_used_percentage", "mem_total", "mem_used", "disk_used_percentage",
    "disk_total", "disk_used", "uptime", "scaph_process_cpu_usage_percentage",
    "scaph_process_memory_bytes", "scaph_process_memory_virtual_bytes",
    "scaph_process_disk_read_bytes", "scaph_process_disk_write_bytes",
    "scaph_process_power_consumption_microwatts",
]

# Names the exports and their default selection use.
DEFAULT_VM_NAME_FILTER = "^neuronet-"
DEFAULT_CLUSTER_FILTER = "Neuronet"
HOST_POWER_FIELD = "scaph_host_power_microwatts"
SCAPH_HOST_PREFIX = "scaphandre_flux"
SCAPH_VM_PREFIX = "scaphandre_neuronet"


@dataclass(frozen=True)
class Source:
    """One telemetry source: file prefix, tag columns, index keys, fields."""

    name: str
    plugin: str
    prefix: str
    tags: list[str]
    index: list[str]
    fields: list[str]
    value_is_text: bool = False
    drop: list[str] = field(default_factory=list)
    require_not_null: list[str] = field(default_factory=list)
    id_columns: dict[str, T.DataType] = field(default_factory=dict)


SOURCES: dict[str, Source] = {
    "k8s": Source(
        "k8s", "k8s", "k8s",
        tags=["container_name", "inventory-cluster-id", "inventory-rack-id",
              "inventory-server-id", "namespace", "node_name", "pod_name"],
        index=["_time", "container_name", "namespace", "node_name", "pod_name"],
        fields=K8S_FIELDS, drop=K8S_DROP, require_not_null=["container_name", "pod_name"]),
    "kepler": Source(
        "kepler", "kepler", "kepler",
        tags=["container_id", "container_name", "inventory-cluster-id", "inventory-rack-id",
              "inventory-server-id", "namespace", "pod_name", "url"],
        index=["_time", "container_id", "container_name", "namespace", "pod_name"],
        fields=KEPLER_FIELDS),
    "pdu": Source(
        "pdu", "pdu", "pdu",
        tags=["inventory-rack-id", "inventory-server-id", "placement", "url"],
        index=["_time", "inventory-server-id", "placement", "url"],
        fields=PDU_FIELDS),
    "proxmox": Source(
        "proxmox", "proxmox", "proxmox",
        tags=["inventory-cluster-id", "inventory-rack-id", "inventory-server-id", "node_fqdn",
              "status", "vm_id", "vm_name"],
        index=["_time", "inventory-server-id", "vm_id", "vm_name"],
        fields=PROXMOX_FIELDS, value_is_text=True, id_columns={"vm_id": T.LongType()}),
    "scaphandre_host": Source(
        "scaphandre_host", "scaphandre", SCAPH_HOST_PREFIX,
        tags=["granularity", "inventory-cluster-id", "inventory-rack-id", "url"],
        index=["_time", "url"],
        fields=SCAPH_HOST_FIELDS),
    "scaphandre_vm": Source(
        "scaphandre_vm", "scaphandre", SCAPH_VM_PREFIX,
        tags=["cmdline", "exe", "granularity", "inventory-cluster-id", "inventory-rack-id",
              "system_type", "url", "uuid", "vm_id", "vm_name"],
        index=["_time", "url", "uuid", "vm_id", "vm_name"],
        fields=SCAPH_VM_FIELDS, id_columns={"vm_id": T.LongType()}),
}


def raw_schema(source: Source) -> T.StructType:
    """Explicit StructType of a raw export of ``source`` (no inference pass):
    bookkeeping columns, then ``_value``/``_field``/``_measurement``, then the
    sorted tag columns with ``plugin`` in sorted position."""
    value_type = T.StringType() if source.value_is_text else T.DoubleType()
    cols: list[T.StructField] = []
    cols += [
        T.StructField("result", T.StringType(), True),
        T.StructField("table", T.IntegerType(), True),
        T.StructField("_start", T.TimestampType(), True),
        T.StructField("_stop", T.TimestampType(), True),
        T.StructField("_time", T.TimestampType(), True),
        T.StructField("_value", value_type, True),
        T.StructField("_field", T.StringType(), True),
        T.StructField("_measurement", T.StringType(), True),
    ]
    for tag in sorted(source.tags + ["plugin"]):
        cols.append(T.StructField(tag, source.id_columns.get(tag, T.StringType()), True))
    return T.StructType(cols)


def wide_columns(source: Source) -> list[str]:
    """Column order of the wide table: index keys then declared fields."""
    return list(source.index) + list(source.fields)
