"""Stand-in telemetry built from the driver's ``events`` table.

The bench and correctness runs have no telemetry bucket, only generic
tables.  ``events(event_id, ts, user_id, event_type, value, props)`` is a
long event stream, so every event is read as one *scrape* of one entity:
``user_id`` names the container / VM / host, ``ts`` is the scrape time, and
the event's ``value`` is spread over the source's metric fields.  The result
has exactly the long schema of a raw export of that source (bookkeeping
columns, ``_time``, ``_field``, ``_value``, ``_measurement``, tags,
``_file``) and nothing else: no pivot, join, aggregation or cleaning is done
here; that is the library's job on these rows.

Each source is described once as SQL expressions over the columns
``event_id, ts, user_id, event_type, value`` and ``v = round(value * 100)``,
written in the subset both Spark SQL and DuckDB accept, so the oracle SQL
rebuilds the very same rows.  Values are integer-valued doubles wherever
they are later summed or averaged, so totals do not depend on summation
order.  A few rows are deliberately missing or malformed (null tags, text
values, zero capacities) to exercise the missing-value rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattspark.schemas import DEFAULT_CLUSTER_FILTER, DEFAULT_VM_NAME_FILTER, SOURCES

_S = "CAST({} AS STRING)"
# names the default selections match: the VM-name filter's literal prefix and
# the cluster pattern (fixed values, defined in wattspark.schemas)
_VM_PREFIX = DEFAULT_VM_NAME_FILTER.lstrip("^")
_CLUSTER = DEFAULT_CLUSTER_FILTER


def _s(expr: str) -> str:
    return _S.format(expr)


_CTR = f"'ctr-' || {_s('user_id')}"
_POD = f"'pod-' || {_s('user_id')}"
_NS = f"'ns-' || {_s('user_id % 3')}"
_SRV_K8S = (f"CASE WHEN user_id % 5 = 0 THEN 'edge-srv' || {_s('user_id % 4')} "
            f"ELSE '{_CLUSTER}-srv' || {_s('user_id % 4')} END")
_HOST = f"'host' || {_s('user_id % 12')}"
_VM_NAME = (f"CASE WHEN user_id % 50 = 7 THEN NULL "
            f"WHEN user_id % 3 = 0 THEN '{_VM_PREFIX}k8s-w' || {_s('user_id')} "
            f"WHEN user_id % 3 = 1 THEN '{_VM_PREFIX}vm' || {_s('user_id')} "
            f"ELSE '{_VM_PREFIX.capitalize()}K8S-m' || {_s('user_id')} END")
_HOST_URL = f"'http://host' || {_s('user_id % 12')} || '.example:8080/metrics'"


@dataclass(frozen=True)
class StandIn:
    source: str            # key of wattspark.schemas.SOURCES
    time: str              # 'raw' (event time) or 'hour' (hour of the event)
    measurement: str
    tags: dict[str, str]   # tag -> SQL expression
    fields: dict[str, str]  # metric field -> SQL expression (double)


STANDINS: dict[str, StandIn] = {
    "k8s": StandIn(
        "k8s", "raw", "kubernetes_pod_container",
        tags={
            "container_name": f"CASE WHEN event_id % 97 = 0 THEN NULL ELSE {_CTR} END",
            "inventory-cluster-id": "'cluster-a'",
            "inventory-rack-id": f"'r' || {_s('user_id % 4')}",
            "inventory-server-id": _SRV_K8S,
            "namespace": _NS,
            "node_name": f"'node-' || {_s('event_id % 2')}",
            "pod_name": _POD,
        },
        fields={
            "cpu_usage_nanocores": "v * 10000",
            "memory_usage_bytes": "v * 65536",
            "logsfs_used_bytes": "v * 1000",
            "logsfs_capacity_bytes": "CASE WHEN event_type = 'error' THEN 0 ELSE 100000000 END",
            "network_rx_bytes": "CASE WHEN event_type = 'click' THEN v * 10 END",
            "memory_rss_bytes": "CASE WHEN event_type IN ('view', 'purchase') THEN v * 1024 END",
        }),
    "kepler": StandIn(
        "kepler", "raw", "kepler",
        tags={
            "container_id": f"'cid-' || {_s('user_id')} || '-' || {_s('event_id % 2')}",
            "container_name": _CTR,
            "inventory-cluster-id": "'cluster-a'",
            "inventory-rack-id": f"'r' || {_s('user_id % 4')}",
            "inventory-server-id": _SRV_K8S,
            "namespace": _NS,
            "pod_name": _POD,
            "url": f"'http://kepler-' || {_s('user_id % 4')} || ':9102/metrics'",
        },
        fields={
            "kepler_container_joules_total":
                "CASE WHEN event_type IN ('view', 'click') THEN v * 6 "
                "WHEN event_type = 'purchase' AND event_id % 7 <> 0 THEN v * 6 END",
            "kepler_container_microwatts_consumption_total":
                "CASE WHEN event_type IN ('purchase', 'view', 'click') THEN v * 100000 END",
        }),
    "pdu": StandIn(
        "pdu", "hour", "pdu",
        tags={
            "inventory-rack-id": f"'r' || {_s('user_id % 4')}",
            "inventory-server-id": _HOST,
            "placement": "CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END",
            "url": f"CASE WHEN user_id % 8 < 4 THEN 'http://' || {_HOST} || '.example/pdu' "
                   f"ELSE 'http://pdu-' || {_s('user_id % 24')} || '.example/api' END",
        },
        fields={
            "activePower": "v * 10",
            "apparentPower": "v * 11",
            "cumulatedEnergy": "CAST(event_id AS DOUBLE) * 1000",
            "current": "v",
            "powerFactor": "CASE WHEN event_type = 'error' THEN NULL ELSE 90 END",
        }),
    "proxmox": StandIn(
        "proxmox", "raw", "proxmox",
        tags={
            "inventory-cluster-id": "'cluster-a'",
            "inventory-rack-id": f"'r' || {_s('user_id % 4')}",
            "inventory-server-id": _HOST,
            "node_fqdn": f"{_HOST} || '.example'",
            "status": "'running'",
            "vm_id": "user_id",
            "vm_name": _VM_NAME,
        },
        fields={
            "cpuload": "v / 100",
            "disk_free": "CASE WHEN event_type = 'error' THEN v * 1000 ELSE 100000000000 - v * 1000000 END",
            "disk_total": "CASE WHEN event_type = 'error' THEN 0 ELSE 100000000000 END",
            "disk_used": "v * 1000000",
            "disk_used_percentage": "v / 1000",
            "mem_free": "8589934592 - v * 100000",
            "mem_total": "8589934592",
            "mem_used": "v * 100000",
            "mem_used_percentage": "v / 560",
            "swap_free": "1073741824 - v * 1000",
            "swap_total": "1073741824",
            "swap_used": "v * 1000",
            "swap_used_percentage": "v / 10000",
            "uptime": "CAST(event_id + 3600 * (user_id % 48) AS DOUBLE)",
        }),
    "scaphandre_host": StandIn(
        "scaphandre_host", "hour", "energy_measurements",
        tags={
            "granularity": "'host+process'",
            "inventory-cluster-id": "'cluster-b'",
            "inventory-rack-id": f"'r' || {_s('user_id % 4')}",
            "url": _HOST_URL,
        },
        fields={"scaph_host_power_microwatts": "v * 1000"}),
    "scaphandre_vm": StandIn(
        "scaphandre_vm", "raw", "energy_measurements",
        tags={
            "cmdline": f"'/usr/bin/kvm -id ' || {_s('user_id')}",
            "exe": "'qemu-system-x86_64'",
            "granularity": "'host+process'",
            "inventory-cluster-id": "'cluster-b'",
            "inventory-rack-id": f"'r' || {_s('user_id % 4')}",
            "system_type": "'vm'",
            "url": _HOST_URL,
            "uuid": f"'uuid-' || {_s('user_id')}",
            "vm_id": "user_id",
            "vm_name": _VM_NAME,
        },
        fields={
            "scaph_process_cpu_usage_percentage": "v",
            "scaph_process_disk_read_bytes": "CASE WHEN event_type = 'signup' THEN NULL ELSE v * 100 END",
            "scaph_process_disk_total_read_bytes": "v * 1000",
            "scaph_process_disk_total_write_bytes": "v * 2000",
            "scaph_process_disk_write_bytes": "v * 50",
            "scaph_process_memory_bytes": "v * 4096",
            "scaph_process_memory_virtual_bytes": "v * 16384",
            "scaph_process_power_consumption_microwatts": "v * 1000",
        }),
}

# Proxmox exports carry text values; a few are malformed on purpose.
_PROXMOX_TEXT_OVERRIDES = {
    "status": "'running'",
    "cpuload": f"CASE WHEN event_id % 89 = 0 THEN {_s('v')} || 'd' ELSE {_s('v / 100')} END",
}


def _value_sql(si: StandIn, name: str, expr: str) -> str:
    if si.source == "proxmox":
        return _PROXMOX_TEXT_OVERRIDES.get(name, _s(f"CAST({expr} AS DOUBLE)"))
    return f"CAST({expr} AS DOUBLE)"


def _status_row(si: StandIn) -> list[tuple[str, str]]:
    # Proxmox also exports a text-valued 'status' metric
    return [("status", "'running'")] if si.source == "proxmox" else []


#: Events of one task of a dealt stand-in: an event becomes up to 15 wide long rows.
EVENTS_PER_TASK = 65_536


def standin_long(spark: SparkSession, sf_dir: str, source: str,
                 with_file: bool = True, dealt: bool = False) -> DataFrame:
    """Long telemetry rows of ``source`` derived from ``events``.  ``dealt``: the events
    are dealt over tasks by ranges of time before they are spread to long rows, so that a
    task that sorts its rows holds few of them, of few days (input shaping only)."""
    si = STANDINS[source]
    src = SOURCES[source]
    ev = (spark.read.parquet(f"{sf_dir}/events.parquet")
          .select("event_id", "ts", "user_id", "event_type", "value"))
    tasks = -(-ev.count() // EVENTS_PER_TASK) if dealt else 1
    if tasks > 1:
        ev = ev.repartitionByRange(tasks, "ts", "event_id")
    ev = ev.withColumn("v", F.expr("round(value * 100)"))
    if si.time == "raw":
        tcol = F.col("ts")
    else:
        tcol = F.date_trunc("hour", F.col("ts").cast(T.TimestampType())).cast(T.TimestampNTZType())
    pairs = [F.struct(F.lit(n).alias("_field"), F.expr(_value_sql(si, n, e)).alias("_value"))
             for n, e in list(si.fields.items()) + _status_row(si)]
    tag_cols = []
    for tag in sorted(si.tags):
        dtype = src.id_columns.get(tag, T.StringType())
        tag_cols.append(F.expr(si.tags[tag]).cast(dtype).alias(tag))
    cols = [
        F.lit("_result").alias("result"),
        F.col("user_id").cast("int").alias("table"),
        F.lit(None).cast(T.TimestampNTZType()).alias("_start"),
        F.lit(None).cast(T.TimestampNTZType()).alias("_stop"),
        tcol.alias("_time"),
        F.explode(F.array(*pairs)).alias("__kv"),
        F.lit(si.measurement).alias("_measurement"),
        F.lit(src.plugin).alias("plugin"),
        *tag_cols,
    ]
    if with_file:
        cols.append(F.concat(F.lit(src.prefix + "_"), F.date_format("ts", "yyyyMMdd"),
                             F.lit(".csv")).alias("_file"))
    df = ev.select(*cols)
    order = ["result", "table", "_start", "_stop", "_time", "_value", "_field", "_measurement",
             *sorted(list(si.tags) + ["plugin"])]
    if with_file:
        order.append("_file")
    return df.select(*[F.col(f"__kv.{c}") if c in ("_field", "_value") else F.col(f"`{c}`")
                       for c in order])


def overlapping_exports(long: DataFrame, source: str) -> DataFrame:
    """The same rows as exports that overlap: rows of the first hour of a
    day are also in the previous day's export file (input shaping only)."""
    src = SOURCES[source]
    prev = F.date_format(F.date_sub(F.col("_time").cast("date"), 1), "yyyyMMdd")
    extra = (long.where(F.hour(F.col("_time").cast(T.TimestampType())) < 1)
             .withColumn("_file", F.concat(F.lit(src.prefix + "_"), prev, F.lit(".csv"))))
    return long.unionByName(extra)


def overlapping_exports_sql(source: str) -> str:
    """DuckDB form of :func:`overlapping_exports` (with a ``_file`` column)."""
    prefix = SOURCES[source].prefix
    base = standin_sql(source, with_file=True)
    return (f"(SELECT * FROM {base} b UNION ALL "
            f"SELECT * REPLACE ('{prefix}_' || strftime(CAST(_time AS DATE) - INTERVAL 1 DAY, '%Y%m%d')"
            f" || '.csv' AS _file) FROM {base} c WHERE hour(_time) < 1)")


def standin_sql(source: str, events: str = "events", with_file: bool = False) -> str:
    """DuckDB SQL yielding the same long rows (``_file`` when asked)."""
    si = STANDINS[source]
    src = SOURCES[source]
    time_sql = "ts" if si.time == "raw" else "date_trunc('hour', ts)"
    tag_sql = []
    for tag in sorted(list(si.tags) + ["plugin"]):
        if tag == "plugin":
            tag_sql.append(f"'{src.plugin}' AS plugin")
        else:
            cast = "BIGINT" if tag in src.id_columns else "VARCHAR"
            tag_sql.append(f'CAST({si.tags[tag]} AS {cast}) AS "{tag}"')
    base = (f"(SELECT event_id, ts, user_id, event_type, value, round(value * 100) AS v "
            f"FROM {events})")
    parts = []
    for name, expr in list(si.fields.items()) + _status_row(si):
        val = _value_sql(si, name, expr).replace("AS STRING", "AS VARCHAR")
        parts.append(
            f"SELECT '_result' AS result, CAST(user_id AS INTEGER) AS \"table\", "
            f"CAST(NULL AS TIMESTAMP) AS _start, CAST(NULL AS TIMESTAMP) AS _stop, "
            f"{time_sql} AS _time, {val} AS _value, '{name}' AS _field, "
            f"'{si.measurement}' AS _measurement, "
            + ", ".join(tag_sql).replace("AS STRING", "AS VARCHAR")
            + (f", '{src.prefix}_' || strftime(ts, '%Y%m%d') || '.csv' AS _file" if with_file else "")
            + f" FROM {base} e")
    return "(" + " UNION ALL ".join(parts) + ")"


def telemetry_table(spark: SparkSession, sf_dir: str,
                    sources: list[str] | None = None, dealt: bool = False) -> DataFrame:
    """All stand-in sources in one long table (the shared bucket), in the
    store's value form (see :func:`wattspark.sources.telemetry.normalize_values`)."""
    from wattspark.sources.telemetry import normalize_values

    out = None
    for s in sources or list(STANDINS):
        df = normalize_values(standin_long(spark, sf_dir, s, with_file=False, dealt=dealt))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out
