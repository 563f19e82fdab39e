"""Registered queries: library plans run over stand-ins of the driver tables.

Every query reads the driver's parquet tables (through
:mod:`wattspark.sources.standins`, or ``events`` directly) so its work grows
with them, and runs the library's own operators on the whole input.  The
final ``select`` of a query only names the columns that are compared with the
DuckDB oracle; where a value is a sum of non-integers (so its last bits depend
on summation order) it is rounded on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattspark.functions import units
from wattspark.functions.missing import to_numeric
from wattspark.functions.timeops import floor_time, parse_range, parse_time
from wattspark.operators import aggregate, profile, select, setops
from wattspark.operators.joins import regex_match_join
from wattspark.operators.learn import anomaly, dense, forest
from wattspark.operators.learn import metrics as lmetrics
from wattspark.operators.learn import scale as lscale
from wattspark.operators.learn import split as lsplit
from wattspark.operators.pivot import pivot_mean
from wattspark.plans import datasets, preprocess, selection, workflows
from wattspark.schemas import (
    ANOMALY_FEATURES, DEFAULT_VM_NAME_FILTER, ENERGY_FEATURES, ENERGY_TARGET, K8S_DROP, SOURCES,
    VM_FEATURES, VM_TARGET,
)
from wattspark.session import scratch_path
from wattspark.sources import exports, sinks, telemetry
from wattspark.sources.standins import overlapping_exports, standin_long, telemetry_table
from wattspark.streaming import telemetry_stream as tstream

#: Alignment interval of the dataset queries: the stand-in entities scrape
#: about twice a day, so daily buckets give joins with real fan-out.
DATASET_INTERVAL = "1D"
#: Selection window of the telemetry queries (the events span January 2024).
RANGE = "start: 2024-01-03T00:00:00Z, stop: 2024-01-28T00:00:00Z"
START, STOP = parse_range(RANGE)
VM_FILTER = DEFAULT_VM_NAME_FILTER
SEED = 42
TEST_FRACTION = 0.2
SPLIT_KEY = ["_time", "container_name", "namespace", "pod_name"]

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        _REGISTRY[name] = fn
        return fn
    return deco


def queries() -> dict[str, Query]:
    from wattspark.catalog import layout, trained, upkeep  # noqa: F401  they register their queries

    return dict(_REGISTRY)


# --------------------------------------------------------------------------
# shared building blocks
# --------------------------------------------------------------------------

def long(spark, sf_dir, source, dealt=False) -> DataFrame:
    return standin_long(spark, sf_dir, source, dealt=dealt)


_PREP = {
    "k8s": preprocess.prep_k8s, "kepler": preprocess.prep_kepler,
    "pdu": preprocess.prep_pdu, "proxmox": preprocess.prep_proxmox,
    "scaphandre_host": preprocess.prep_scaphandre_host,
    "scaphandre_vm": preprocess.prep_scaphandre_vm,
}


def wide(spark, sf_dir, source) -> DataFrame:
    return _PREP[source](long(spark, sf_dir, source))


def tel(spark, sf_dir, dealt=False) -> DataFrame:
    return telemetry_table(spark, sf_dir, dealt=dealt)


def ntz(df: DataFrame) -> DataFrame:
    """Timestamp columns as timestamp_ntz (the oracle's timestamp type)."""
    return df.select(*[
        select.col(f.name).cast(T.TimestampNTZType()).alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else select.col(f.name)
        for f in df.schema.fields])


def rnd(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    cols = set(cols)
    return df.select(*[F.round(select.col(c), digits).alias(c) if c in cols else select.col(c)
                       for c in df.columns])


def numeric_value(df: DataFrame, keep) -> DataFrame:
    """Selected long rows with ``_value`` parsed to a number."""
    v = F.col("_value")
    v = to_numeric(v) if isinstance(df.schema["_value"].dataType, T.StringType) else v
    return ntz(df.select(*[select.col(c) for c in keep], v.alias("_value")))


def energy(spark, sf_dir) -> DataFrame:
    return datasets.energy_dataset(wide(spark, sf_dir, "k8s"), wide(spark, sf_dir, "kepler"),
                                   interval=DATASET_INTERVAL)


def vm_power(spark, sf_dir) -> DataFrame:
    return datasets.vm_power_dataset(wide(spark, sf_dir, "proxmox"),
                                     wide(spark, sf_dir, "scaphandre_vm"),
                                     interval=DATASET_INTERVAL)


def energy_split(spark, sf_dir) -> DataFrame:
    return lsplit.train_test_split(energy(spark, sf_dir), test_size=TEST_FRACTION, seed=SEED,
                                   key_cols=SPLIT_KEY)


def inventory(spark, sf_dir) -> DataFrame:
    return selection.inventory_ids(tel(spark, sf_dir), START, STOP, VM_FILTER)


# --------------------------------------------------------------------------
# 2.1 scans / sources / sinks
# --------------------------------------------------------------------------

@register("scan_long")
def q_scan_long(spark, sf_dir):
    """k8s exports written as CSV files, then scanned with the declared
    schema (``k8s*`` files of one header, missing tokens -> null)."""
    path = scratch_path(spark, "exports-k8s")
    exports.write_exports(long(spark, sf_dir, "k8s"), path, "k8s")
    df = exports.read_exports(spark, path, "k8s", one_header=True)
    return ntz(df.drop("_file", "_start", "_stop"))


def _scan_back(spark, sf_dir, source):
    path = scratch_path(spark, f"exports-{source}")
    exports.write_exports(long(spark, sf_dir, source), path, source)
    return ntz(exports.read_exports(spark, path, source).drop("_file", "_start", "_stop"))


@register("scan_long_kepler")
def q_scan_long_kepler(spark, sf_dir):
    """Kepler exports written as CSV files and scanned by header."""
    return _scan_back(spark, sf_dir, "kepler")


@register("scan_long_pdu")
def q_scan_long_pdu(spark, sf_dir):
    """S3: PDU exports written as CSV files and scanned by header."""
    return _scan_back(spark, sf_dir, "pdu")


@register("scan_long_proxmox")
def q_scan_long_proxmox(spark, sf_dir):
    """Text-valued Proxmox exports written as CSV files and scanned by
    header; the text as a number where it is one, else as it is."""
    df = _scan_back(spark, sf_dir, "proxmox").withColumn("number", to_numeric("_value"))
    text = F.when(F.col("number").isNull(), F.col("_value"))
    return df.withColumn("value_text", text).drop("_value")


@register("scan_routed")
def q_scan_routed(spark, sf_dir):
    """Host and VM scaphandre exports in one folder, routed by prefix."""
    path = scratch_path(spark, "exports-scaph")
    exports.write_exports(long(spark, sf_dir, "scaphandre_host"), path, "scaphandre_host")
    exports.write_exports(long(spark, sf_dir, "scaphandre_vm"), path, "scaphandre_vm")
    host, vm = exports.read_routed(spark, path)
    keep = ["_time", "_field", "_value", "url"]
    return ntz(host.select(F.lit("host").alias("route"), *keep)
               .unionByName(vm.select(F.lit("vm").alias("route"), *keep)))


@register("scan_multi_table_csv")
def q_scan_multi_table_csv(spark, sf_dir):
    """Concatenated exports (empty first column, a header repeated per
    series table) read back with header lines dropped."""
    path = scratch_path(spark, "exports-concat")
    exports.write_exports(long(spark, sf_dir, "scaphandre_host"), path, "scaphandre_host",
                          leading_blank=True, header_per="table")
    df = exports.read_exports(spark, path, "scaphandre_host")
    return ntz(df.select("table", "_time", "_field", "_value", "url"))


@register("telemetry_select")
def q_telemetry_select(spark, sf_dir):
    """Bucket selection (plugin, absolute range, vm_name regex)."""
    spec = selection.TelemetrySpec.from_range("scaphandre", RANGE, vm_name_filter=VM_FILTER)
    df = selection.select_telemetry(tel(spark, sf_dir), spec)
    return numeric_value(df, ["_time", "_field", "url", "vm_id", "vm_name"])


@register("telemetry_store_select")
def q_telemetry_store_select(spark, sf_dir):
    """S6 over the partitioned store: the telemetry is written partitioned
    by plugin and date, then the same selection prunes partitions."""
    path = scratch_path(spark, "telemetry-store")
    telemetry.write_telemetry(tel(spark, sf_dir, dealt=True), path)
    spec = selection.TelemetrySpec.from_range("scaphandre", RANGE, vm_name_filter=VM_FILTER)
    df = selection.select_telemetry(telemetry.read_telemetry(spark, path), spec)
    return numeric_value(df, ["_time", "_field", "url", "vm_id", "vm_name"])


@register("export_partitioned")
def q_export_partitioned(spark, sf_dir):
    """Per-inventory PDU exports written, then read back per export."""
    path = scratch_path(spark, "exports-pdu")
    df = selection.run_plugin(tel(spark, sf_dir), "pdu", START, STOP, vm_name_filter=VM_FILTER)
    exports.write_exports(df, path, "pdu", name_col="export_name", run_id="run1")
    back = exports.read_exports(spark, path, "pdu")
    return ntz(back.select(F.col("_file").alias("export"), "_time", "inventory-server-id",
                           "placement", "url", "_field", "_value"))


@register("processed_roundtrip")
def q_processed_roundtrip(spark, sf_dir):
    """Processed k8s table written as Parquet and read back."""
    path = scratch_path(spark, "processed-k8s")
    sinks.write_table(wide(spark, sf_dir, "k8s"), path, sort_within="_time")
    return sinks.read_table(spark, path)


@register("split_sink")
def q_split_sink(spark, sf_dir):
    """Splits written partitioned by split, test split read back."""
    path = scratch_path(spark, "splits-energy")
    sinks.write_splits(energy_split(spark, sf_dir), path)
    return sinks.read_split(spark, path, "test")


# --------------------------------------------------------------------------
# 2.2 filters
# --------------------------------------------------------------------------

@register("filter_eq")
def q_filter_eq(spark, sf_dir):
    """plugin and field equality on the shared telemetry table."""
    df = select.filter_eq(tel(spark, sf_dir), "plugin", "pdu")
    df = select.filter_eq(df, "_field", "activePower")
    return numeric_value(df, ["_time", "inventory-server-id", "url"])


@register("filter_regex")
def q_filter_regex(spark, sf_dir):
    """vm_name regular expression (partial match, missing never matches)."""
    df = select.filter_eq(tel(spark, sf_dir), "plugin", "proxmox")
    df = select.filter_regex(df, "vm_name", VM_FILTER)
    return numeric_value(df, ["_time", "vm_id", "vm_name", "_field"])


@register("filter_time_range")
def q_filter_time_range(spark, sf_dir):
    """start-inclusive, stop-exclusive time range."""
    df = select.filter_time_range(long(spark, sf_dir, "k8s"), START, STOP)
    return numeric_value(df, ["_time", "container_name", "pod_name", "_field"])


@register("filter_not_null")
def q_filter_not_null(spark, sf_dir):
    """F8: drop rows with a missing container or pod name."""
    df = select.not_null(long(spark, sf_dir, "k8s"), ["container_name", "pod_name"])
    return numeric_value(df, ["_time", "container_name", "pod_name", "_field"])


@register("filter_contains")
def q_filter_contains(spark, sf_dir):
    """case-sensitive substring on vm_name."""
    df = select.contains(wide(spark, sf_dir, "proxmox"), "vm_name", "k8s")
    return ntz(df.select("_time", "vm_id", "vm_name", "cpuload", "mem_used"))


@register("filter_icontains")
def q_filter_icontains(spark, sf_dir):
    """case-insensitive substring on vm_name."""
    df = select.contains(wide(spark, sf_dir, "proxmox"), "vm_name", "k8s", case_sensitive=False)
    return ntz(df.select("_time", "vm_id", "vm_name", "cpuload", "mem_used"))


@register("dropna_any")
def q_dropna_any(spark, sf_dir):
    """drop wide rows with any missing cell."""
    src = SOURCES["scaphandre_vm"]
    df = pivot_mean(long(spark, sf_dir, "scaphandre_vm"), src.index, src.fields)
    return ntz(select.dropna_any(df))


@register("dropna_subset")
def q_dropna_subset(spark, sf_dir):
    """drop rows missing a value in a column subset."""
    cols = ["cpu_usage_nanocores", "network_rx_bytes"]
    df = select.dropna_subset(wide(spark, sf_dir, "k8s"), cols)
    return ntz(df.select(*SOURCES["k8s"].index, *cols))


@register("exists_gate")
def q_exists_gate(spark, sf_dir):
    """PDU rows pass only when the inventory set is not empty."""
    df = select.exists_gate(select.filter_eq(tel(spark, sf_dir), "plugin", "pdu"),
                            inventory(spark, sf_dir))
    return numeric_value(df, ["_time", "inventory-server-id", "_field"])


# --------------------------------------------------------------------------
# 2.3 projections
# --------------------------------------------------------------------------

@register("drop_columns")
def q_drop_columns(spark, sf_dir):
    """Drop bookkeeping and inventory columns (absent names ignored)."""
    df = select.drop_columns(long(spark, sf_dir, "k8s"), K8S_DROP + ["_file", "not_a_column"])
    return ntz(df)


@register("select_columns")
def q_select_columns(spark, sf_dir):
    """Keep-list projection of the model columns."""
    return select.select_columns(energy(spark, sf_dir), ENERGY_FEATURES + [ENERGY_TARGET])


@register("guarded_columns")
def q_guarded_columns(spark, sf_dir):
    """Disk GiB columns added because their inputs exist."""
    src = SOURCES["proxmox"]
    df = pivot_mean(long(spark, sf_dir, "proxmox"), src.index, src.fields)
    df = preprocess.add_disk_columns(df)
    return ntz(df.select("_time", "vm_id", "disk_free_gb", "disk_total_gb", "disk_used_gb"))


# --------------------------------------------------------------------------
# 2.4 joins
# --------------------------------------------------------------------------

@register("join_energy")
def q_join_energy(spark, sf_dir):
    """Complete k8s rows joined to bucketed Kepler energy (fan-out kept)."""
    return ntz(datasets.energy_join(wide(spark, sf_dir, "k8s"), wide(spark, sf_dir, "kepler"),
                                    DATASET_INTERVAL))


@register("join_vm_power")
def q_join_vm_power(spark, sf_dir):
    """Complete Proxmox rows joined to aggregated scaphandre VM rows."""
    df = datasets.vm_power_join(wide(spark, sf_dir, "proxmox"),
                                wide(spark, sf_dir, "scaphandre_vm"), DATASET_INTERVAL)
    return ntz(df)


@register("join_left_meta")
def q_join_left_meta(spark, sf_dir):
    """PDU wide rows left-joined to (server, url) metadata (url_x/url_y)."""
    return ntz(preprocess.prep_pdu(long(spark, sf_dir, "pdu"), meta="faithful"))


@register("semi_join_inventory")
def q_semi_join_inventory(spark, sf_dir):
    """PDU rows of the inventory servers, one semi-join."""
    t = tel(spark, sf_dir)
    df = selection.semi_join_inventory(select.filter_eq(t, "plugin", "pdu"),
                                       inventory(spark, sf_dir))
    return numeric_value(df, ["_time", "inventory-server-id", "url", "_field"])


@register("theta_join_regex")
def q_theta_join_regex(spark, sf_dir):
    """Host power rows whose url matches an inventory id as a regex."""
    host = long(spark, sf_dir, "scaphandre_host")
    ids = inventory(spark, sf_dir).select(F.col("`inventory-server-id`").alias("inventory_id"))
    df = regex_match_join(host, ids, "url", "inventory_id")
    return numeric_value(df, ["_time", "url", "inventory_id"])


# --------------------------------------------------------------------------
# 2.5 aggregations
# --------------------------------------------------------------------------

@register("pivot_mean")
def q_pivot_mean(spark, sf_dir):
    """A3: PDU long -> wide, mean of duplicates within each hour."""
    return ntz(preprocess.prep_pdu(long(spark, sf_dir, "pdu"), meta="none"))


@register("pivot_discover")
def q_pivot_discover(spark, sf_dir):
    """A1 as a dynamic pivot: every metric with a value becomes a column
    (``fields='discover'``), declared or not."""
    return ntz(preprocess.prep_k8s(long(spark, sf_dir, "k8s"), fields="discover"))


@register("pivot_mean_coerced")
def q_pivot_mean_coerced(spark, sf_dir):
    """A4: Proxmox text values coerced to numbers, then pivoted."""
    src = SOURCES["proxmox"]
    return ntz(pivot_mean(long(spark, sf_dir, "proxmox"), src.index, src.fields))


@register("pivot_overlapping_exports")
def q_pivot_overlapping_exports(spark, sf_dir):
    """U1/A1 per export: k8s exports overlap by an hour; each export is
    pivoted on its own, so an overlapped key stays twice."""
    long_df = overlapping_exports(long(spark, sf_dir, "k8s"), "k8s")
    return ntz(preprocess.prep_k8s(long_df))


@register("distinct_overlapping_exports")
def q_distinct_overlapping_exports(spark, sf_dir):
    """W5/A7 per export: overlapping host-power exports pivoted per export,
    then complete rows de-duplicated, so overlapped rows appear once."""
    long_df = overlapping_exports(long(spark, sf_dir, "scaphandre_host"), "scaphandre_host")
    return ntz(preprocess.prep_scaphandre_host(long_df))


@register("distinct_rows")
def q_distinct_rows(spark, sf_dir):
    """Whole-row distinct of host power rows (time, value, url)."""
    df = long(spark, sf_dir, "scaphandre_host").select("_time", "_value", "url")
    return ntz(aggregate.distinct_rows(df))


@register("distinct_inventory")
def q_distinct_inventory(spark, sf_dir):
    """Sorted distinct trimmed inventory ids of matching Proxmox VMs."""
    return inventory(spark, sf_dir)


@register("distinct_pairs")
def q_distinct_pairs(spark, sf_dir):
    """Distinct (server, vm_name) pairs."""
    return selection.host_vm_pairs(tel(spark, sf_dir), START, STOP, VM_FILTER)


@register("group_sum_zero")
def q_group_sum_zero(spark, sf_dir):
    """Kepler joules summed per bucket and container (all-missing -> 0.0)."""
    return ntz(datasets.kepler_energy(wide(spark, sf_dir, "kepler"), DATASET_INTERVAL))


@register("group_mixed_agg")
def q_group_mixed_agg(spark, sf_dir):
    """Scaphandre VM means and 0.0-default sums per (bucket, vm_id)."""
    return ntz(datasets.scaphandre_vm_aggregate(wide(spark, sf_dir, "scaphandre_vm"),
                                                DATASET_INTERVAL))


@register("profile_shape")
def q_profile_shape(spark, sf_dir):
    """Rows and columns of every processed table."""
    return profile.shape({s: wide(spark, sf_dir, s) for s in _PREP})


@register("profile_nulls")
def q_profile_nulls(spark, sf_dir):
    """Missing count per column of the processed Proxmox table."""
    return profile.null_counts(wide(spark, sf_dir, "proxmox"))


@register("profile_columns")
def q_profile_columns(spark, sf_dir):
    """Per-column distinct/missing/constant/min/max of the energy dataset."""
    return profile.column_profile(energy(spark, sf_dir), exact=True)


@register("profile_value_sets")
def q_profile_value_sets(spark, sf_dir):
    """A15 value sets: every value of the text columns of the processed k8s
    table (over 50 pods and containers) with its row count."""
    return profile.value_sets(wide(spark, sf_dir, "k8s"))


@register("threshold_3sigma")
def q_threshold_3sigma(spark, sf_dir):
    """Mean + 3 population standard deviations of container power."""
    out = lmetrics.three_sigma(energy(spark, sf_dir), ENERGY_TARGET)
    return rnd(out, out.columns)


@register("rowwise_mse")
def q_rowwise_mse(spark, sf_dir):
    """Per-row mean squared deviation of the features from their means."""
    df = energy(spark, sf_dir).checkpoint(eager=True)   # read for the means and the rows
    means = df.agg(*[F.avg(c).alias(f"m_{c}") for c in ENERGY_FEATURES]).first()  # one row
    with_means = df.withColumns({f"m_{c}": F.lit(means[f"m_{c}"]) for c in ENERGY_FEATURES})
    out = lmetrics.rowwise_mse(with_means, ENERGY_FEATURES, [f"m_{c}" for c in ENERGY_FEATURES],
                               "row_mse")
    return rnd(out.select(*SPLIT_KEY, "row_mse"), ["row_mse"], 3)


@register("max_of_two")
def q_max_of_two(spark, sf_dir):
    """The larger of two column maxima."""
    return lmetrics.max_of_two(energy(spark, sf_dir), ENERGY_TARGET, "cpu_millicores")


# --------------------------------------------------------------------------
# 2.7 sorts / limits, 2.8 sets
# --------------------------------------------------------------------------

@register("sort_time")
def q_sort_time(spark, sf_dir):
    """O1: processed host power ordered by time."""
    return ntz(preprocess.prep_scaphandre_host(long(spark, sf_dir, "scaphandre_host"), sort=True))


@register("limit_head")
def q_limit_head(spark, sf_dir):
    """O3: first five rows after an explicit order."""
    return ntz(profile.head(wide(spark, sf_dir, "scaphandre_host"), 5, ["_time", "url"]))


@register("union_by_name")
def q_union_by_name(spark, sf_dir):
    """Processed k8s and Kepler rows in one table by column name."""
    return ntz(setops.union_by_name([wide(spark, sf_dir, "k8s"), wide(spark, sf_dir, "kepler")]))


@register("select_all_plugins")
def q_select_all_plugins(spark, sf_dir):
    """The 'all' run over the five plugins (scaphandre twice)."""
    df = selection.select_all_plugins(tel(spark, sf_dir), START, STOP, vm_name_filter=VM_FILTER)
    return numeric_value(df, ["run_plugin", "pass", "export_name", "_time", "_field"])


@register("run_plugin_field")
def q_run_plugin_field(spark, sf_dir):
    """A PDU run with a field: rows of an id whose url also matches the id."""
    df = selection.run_plugin(tel(spark, sf_dir), "pdu", START, STOP, field="activePower",
                              vm_name_filter=VM_FILTER)
    return numeric_value(df, ["export_name", "_time", "inventory-server-id", "url", "_field"])


@register("run_plugin")
def q_run_plugin(spark, sf_dir):
    """One plugin run (PDU): inventory lookup, gate, per-id selection."""
    df = selection.run_plugin(tel(spark, sf_dir), "pdu", START, STOP, vm_name_filter=VM_FILTER)
    return numeric_value(df, ["export_name", "_time", "inventory-server-id", "url", "_field"])


# --------------------------------------------------------------------------
# 2.9 scalar functions
# --------------------------------------------------------------------------

@register("parse_time")
def q_parse_time(spark, sf_dir):
    """ISO-8601 text -> timestamp; unparseable text -> missing."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return ntz(ev.select("event_id", parse_time(text).alias("parsed"),
                         parse_time(F.col("props")).alias("parsed_props")))


@register("to_numeric_coerce")
def q_to_numeric_coerce(spark, sf_dir):
    """Proxmox text values -> numbers ('running', '12.0d' -> missing)."""
    df = long(spark, sf_dir, "proxmox")
    return ntz(df.select("_time", "vm_id", "_field", to_numeric("_value").alias("value")))


@register("time_floor")
def q_time_floor(spark, sf_dir):
    """Timestamps floored to 1 and 15 minutes, 1 hour and 1 day."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return ev.select("event_id",
                     floor_time("ts", "1min", ntz=True).alias("t1m"),
                     floor_time("ts", "15min", ntz=True).alias("t15m"),
                     floor_time("ts", "1h", ntz=True).alias("t1h"),
                     floor_time("ts", "1D", ntz=True).alias("t1d"))


@register("unit_conversions")
def q_unit_conversions(spark, sf_dir):
    """Nanocores->millicores, bytes->MiB, joules->watts."""
    df = datasets.energy_join(wide(spark, sf_dir, "k8s"), wide(spark, sf_dir, "kepler"),
                              DATASET_INTERVAL)
    return ntz(df.select(
        *SPLIT_KEY,
        units.nanocores_to_millicores("cpu_usage_nanocores").alias("cpu_millicores"),
        units.bytes_to_mib("memory_usage_bytes").alias("memory_usage_mb"),
        units.joules_to_watts("kepler_container_joules_total").alias("container_power_watts")))


@register("ieee_percent")
def q_ieee_percent(spark, sf_dir):
    """100*(1 - free/total) with IEEE division (-inf and missing kept)."""
    df = wide(spark, sf_dir, "proxmox")
    return ntz(df.select("_time", "vm_id", "disk_free", "disk_total", "disk_usage_percent"))


@register("guarded_percent")
def q_guarded_percent(spark, sf_dir):
    """used/capacity*100 when capacity > 0, else 0."""
    df = select.dropna_subset(wide(spark, sf_dir, "k8s"),
                              ["logsfs_used_bytes", "logsfs_capacity_bytes"])
    return ntz(df.select(*SOURCES["k8s"].index,
                         units.guarded_percent("logsfs_used_bytes", "logsfs_capacity_bytes")
                         .alias("logsfs_usage_percent")))


@register("export_name")
def q_export_name(spark, sf_dir):
    """Export names: the inventory id, else the filter regex stem."""
    ids = inventory(spark, sf_dir)
    return ids.select("`inventory-server-id`",
                      select.export_name_col("inventory-server-id", VM_FILTER).alias("export_name"),
                      select.export_name_col(None, VM_FILTER).alias("filter_export_name"))


@register("stream_window_pivot")
def q_stream_window_pivot(spark, sf_dir):
    """Streaming re-aim of the pivot: k8s exports land as Parquet files, a
    file stream with a watermark pivots them per hour window and key; the
    result table is read back."""
    base = scratch_path(spark, "stream-k8s")
    src = long(spark, sf_dir, "k8s").drop("_file")
    src.write.parquet(f"{base}/in")
    stream = tstream.read_long_stream(spark, f"{base}/in", src.schema, max_files_per_trigger=4)
    out = tstream.source_windowed_pivot(stream, "k8s", window="1 hour", watermark="2 hours")
    # a finite drain: complete mode, so the windows still open at the end are written
    tstream.run_to_table(out, f"{base}/out", f"{base}/ckpt", output_mode="complete")
    return ntz(spark.read.parquet(f"{base}/out"))


# --------------------------------------------------------------------------
# 2.12 learning (SQL-checkable parts)
# --------------------------------------------------------------------------

@register("train_test_split")
def q_train_test_split(spark, sf_dir):
    """M1: deterministic hash split (20 % test, seed 42) keyed on the bucket."""
    return ntz(energy_split(spark, sf_dir))


@register("train_test_split_exact")
def q_train_test_split_exact(spark, sf_dir):
    """M1, exact mode: exactly ceil(20 % of n) test rows, the smallest key
    hashes; the key adds the formatted features so equal keys mean equal rows."""
    df = energy(spark, sf_dir)
    fmt = {f"k_{c}": F.format_string("%.4f", F.col(c)) for c in
           ("cpu_millicores", "memory_usage_mb", "logsfs_usage_percent")}
    keyed = df.withColumns(fmt)
    out = lsplit.train_test_split(keyed, test_size=TEST_FRACTION, seed=SEED,
                                  key_cols=SPLIT_KEY + list(fmt), exact=True)
    return ntz(out.drop(*fmt))


@register("standard_scale")
def q_standard_scale(spark, sf_dir):
    """M2: standard scaling fitted on the train split (population std)."""
    df = energy_split(spark, sf_dir).checkpoint(eager=True)   # fitted on, then scaled
    model = lscale.fit_standard_scaler(df.where(F.col("split") == "train"), ENERGY_FEATURES)
    out = lscale.transform_standard(df, model, ENERGY_FEATURES)
    return rnd(ntz(out.select(*SPLIT_KEY, "split", *ENERGY_FEATURES)), ENERGY_FEATURES)


@register("regression_metrics")
def q_regression_metrics(spark, sf_dir):
    """M6: MAE / MSE / R2 of the train-mean predictor on the test split."""
    df = energy_split(spark, sf_dir).checkpoint(eager=True)   # mean of train, then test
    mean = df.where(F.col("split") == "train").agg(F.avg(ENERGY_TARGET)).first()[0]  # one value
    test = df.where(F.col("split") == "test").withColumn("prediction", F.lit(mean))
    out = lmetrics.regression_metrics(test, ENERGY_TARGET, "prediction")
    return rnd(out, ["mae", "mse", "r2"])


# --------------------------------------------------------------------------
# 2.13 per-source processing and datasets
# --------------------------------------------------------------------------

def _prep_query(source, doc):
    def q(spark, sf_dir):
        return ntz(wide(spark, sf_dir, source))
    q.__doc__ = doc
    return q


for _src, _doc in [
    ("k8s", "W1: k8s processing (drop, not-null, pivot)."),
    ("kepler", "W2: Kepler processing (pivot)."),
    ("pdu", "W3: PDU processing (pivot, metadata join)."),
    ("proxmox", "W4: Proxmox processing (coerce, pivot, disk columns)."),
    ("scaphandre_host", "W5: scaphandre host processing (pivot, dropna, distinct)."),
    ("scaphandre_vm", "W5: scaphandre VM processing (pivot, dropna, distinct)."),
]:
    register(f"prep_{_src}")(_prep_query(_src, _doc))


@register("energy_dataset")
def q_energy_dataset(spark, sf_dir):
    """Container energy dataset from the processed k8s and Kepler tables."""
    return ntz(energy(spark, sf_dir))


@register("energy_dataset_1min")
def q_energy_dataset_1min(spark, sf_dir):
    """W6 at the one-minute interval, over scrapes moved to the minutes of
    their hour's first quarter so that the two sources meet."""
    k8s, kepler = (_PREP[s](_closer(long(spark, sf_dir, s))) for s in ("k8s", "kepler"))
    return ntz(datasets.energy_dataset(k8s, kepler, interval="1min"))


def _closer(df: DataFrame) -> DataFrame:
    """The same scrapes at finer times (input shaping only): day start plus the
    hour as minutes and the second, so entities are seen in common minutes."""
    day = F.date_trunc("day", F.col("_time").cast(T.TimestampType()))
    fine = (F.unix_micros(day) + F.hour(F.col("_time").cast(T.TimestampType())) * 60_000_000
            + F.second(F.col("_time").cast(T.TimestampType())).cast("long") * 1_000_000)
    return df.withColumn("_time", F.timestamp_micros(fine).cast(T.TimestampNTZType()))


@register("energy_dataset_skew_split")
def q_energy_dataset_skew_split(spark, sf_dir):
    """W6 with hot keys isolated explicitly (skew_split_join) instead of
    relying on AQE's skew-join splitting."""
    return ntz(datasets.energy_dataset(wide(spark, sf_dir, "k8s"), wide(spark, sf_dir, "kepler"),
                                       interval=DATASET_INTERVAL, skew="split"))


@register("vm_power_dataset_skew_split")
def q_vm_power_dataset_skew_split(spark, sf_dir):
    """W7 with hot keys isolated explicitly."""
    return ntz(datasets.vm_power_dataset(wide(spark, sf_dir, "proxmox"),
                                         wide(spark, sf_dir, "scaphandre_vm"),
                                         interval=DATASET_INTERVAL, skew="split"))


@register("vm_power_dataset")
def q_vm_power_dataset(spark, sf_dir):
    """VM power dataset from the processed Proxmox and scaphandre tables."""
    return ntz(vm_power(spark, sf_dir))


@register("metrics_log")
def q_metrics_log(spark, sf_dir):
    """Metrics rows (run id, mae, mse, r2) appended to a metrics log
    by two runs (train-mean predictor on two split seeds), read back."""
    path = scratch_path(spark, "metrics-log")
    data = energy(spark, sf_dir).checkpoint(eager=True)   # shared by both runs
    for run_id, seed in (("run-42", 42), ("run-7", 7)):
        df = lsplit.train_test_split(data, test_size=TEST_FRACTION, seed=seed, key_cols=SPLIT_KEY)
        mean = df.where(F.col("split") == "train").agg(F.avg(ENERGY_TARGET)).first()[0]
        test = df.where(F.col("split") == "test").withColumn("prediction", F.lit(mean))
        m = lmetrics.regression_metrics(test, ENERGY_TARGET, "prediction")
        sinks.append_metrics(rnd(m, ["mae", "mse", "r2"]).select(F.lit(run_id).alias("run_id"), "*"),
                             path)
    return sinks.read_table(spark, path)


# --------------------------------------------------------------------------
# 2.12 learning (keys, true values and properties of the models; their
# quality is tested in tests/)
# --------------------------------------------------------------------------

VM_SPLIT_KEY = ["_time", "vm_id"]
#: Depth of the catalog's forests; tests measure what it costs against 30.
FOREST_DEPTH = 10


#: Labels that follow two of the features (the stand-in's own targets follow none): the
#: forests and networks of the catalog must find them.
PLANTED = {ENERGY_TARGET: "cpu_millicores + 10 * logsfs_usage_percent",
           VM_TARGET: "cpuload + 5 * mem_used_percentage"}


def planted(df: DataFrame, target: str) -> DataFrame:
    return df.withColumn(target, F.expr(PLANTED[target]))


def _graded(scored, train, test, target, keys, share):
    """Key, true value, the test error of the train-mean predictor, and whether the model's
    test error is at most ``share`` of it (a model that answers a constant fails)."""
    mean = train.agg(F.avg(target)).first()[0]
    e = F.col(target) - F.col("prediction")
    b = F.col(target) - F.lit(mean)
    own, blind = (scored.filter(F.col("split") == "test") if "split" in scored.columns else scored).agg(
        F.avg(e * e), F.avg(b * b)).first()
    out = scored.select(*keys, F.col(target).alias("y_true"), F.lit(blind).alias("mean_mse"),
                        F.lit(own <= share * blind).alias("fits"))
    return rnd(ntz(out), ["y_true", "mean_mse"])


def _finite(c):
    c = select.col(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def vm_split(spark, sf_dir) -> DataFrame:
    df = planted(vm_power(spark, sf_dir), VM_TARGET)
    return lsplit.train_test_split(df, test_size=TEST_FRACTION, seed=SEED,
                                   key_cols=VM_SPLIT_KEY).checkpoint(eager=True)


def _energy_forest(spark, sf_dir, num_trees=100):
    df = planted(energy_split(spark, sf_dir), ENERGY_TARGET).checkpoint(eager=True)
    model = forest.fit_random_forest(df.where(F.col("split") == "train"), ENERGY_FEATURES,
                                     ENERGY_TARGET, num_trees=num_trees, seed=SEED,
                                     max_depth=FOREST_DEPTH)
    return df, model


@register("rf_energy")
def q_rf_energy(spark, sf_dir):
    """Random forest (100 trees, seed 42) on the energy train
    split with a planted label; its error on the test split."""
    df, model = _energy_forest(spark, sf_dir)
    train, test = (df.where(F.col("split") == k) for k in ("train", "test"))
    return _graded(forest.predict(model, test), train, test, ENERGY_TARGET, SPLIT_KEY, 0.1)


@register("rf_vm_power")
def q_rf_vm_power(spark, sf_dir):
    """M4: VM power forest on features scaled with the train-split scaler."""
    df = vm_split(spark, sf_dir)
    train = df.where(F.col("split") == "train")
    scaler = lscale.scaler_values(lscale.fit_standard_scaler(train, VM_FEATURES))  # one row
    scaled = lscale.transform_standard(df, scaler, VM_FEATURES)
    model = forest.fit_random_forest(scaled.where(F.col("split") == "train"), VM_FEATURES,
                                     VM_TARGET, num_trees=100, seed=SEED,
                                     max_depth=FOREST_DEPTH)
    test = scaled.where(F.col("split") == "test")
    return _graded(forest.predict(model, test), train, test, VM_TARGET, VM_SPLIT_KEY, 0.2)


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    """M7: feature importances of the energy forest: all together 1, and which
    features the planted label uses."""
    _, model = _energy_forest(spark, sf_dir)
    imp = forest.feature_importances(spark, model, ENERGY_FEATURES)
    total = imp.agg(F.round(F.sum("importance"), 6)).first()[0]
    return imp.select("feature", (F.col("importance") >= 0.1).alias("used"),
                      F.lit(total).alias("total"))


def _vm_mlp(spark, sf_dir, epochs=20):
    df = vm_split(spark, sf_dir)
    train = df.where(F.col("split") == "train")
    scaler = lscale.scaler_values(lscale.fit_standard_scaler(train, VM_FEATURES))  # one row
    model, history = dense.fit_dense(lscale.transform_standard(train, scaler, VM_FEATURES),
                                     VM_FEATURES, [VM_TARGET], (128, 64), epochs=epochs, lr=1e-3,
                                     batch_size=32, seed=SEED)
    model.scaler_mean, model.scaler_scale = lscale.scaler_arrays(scaler, VM_FEATURES)
    return df, model, history


@register("mlp_vm_power")
def q_mlp_vm_power(spark, sf_dir):
    """M8/M9: MLP 128-64-1 (Adam 1e-3, batch 32, 20 epochs) trained
    data-parallel on a planted label; its error on the test split."""
    df, model, _ = _vm_mlp(spark, sf_dir)
    train, test = (df.where(F.col("split") == k) for k in ("train", "test"))
    return _graded(dense.predict_dense(test, model), train, test, VM_TARGET, VM_SPLIT_KEY, 0.5)


@register("loss_history")
def q_loss_history(spark, sf_dir):
    """Mean training loss per epoch of the VM power MLP, and whether it
    fell below half of the label's variance and half of the first epoch's loss."""
    df, _, history = _vm_mlp(spark, sf_dir)
    losses = [r.loss for r in history.orderBy("epoch").collect()]   # one per epoch
    blind = df.where(F.col("split") == "train").agg(F.var_pop(VM_TARGET)).first()[0]
    return history.select("epoch", _finite("loss").alias("finite"),
                          F.lit(losses[-1] < min(losses[0], blind) / 2).alias("fell"))


def _autoencoder(spark, sf_dir, data=None):
    data = data if data is not None else vm_power(spark, sf_dir)
    return anomaly.fit_autoencoder(data, ANOMALY_FEATURES, (16, 8, 16),
                                   epochs=50, batch_size=64, lr=1e-3, seed=SEED,
                                   validation_fraction=0.1)


@register("autoencoder_train")
def q_autoencoder_train(spark, sf_dir):
    """Autoencoder 14-16-8-16-14 (50 epochs, batch 64), last 10 % of
    rows by time held out; training and validation loss per epoch."""
    _, history = _autoencoder(spark, sf_dir)
    losses = [r.loss for r in history.orderBy("epoch").collect()]   # one per epoch
    return history.select("epoch", _finite("loss").alias("finite"),
                          _finite("val_loss").alias("val_finite"),
                          F.lit(losses[-1] < 0.9 * losses[0]).alias("fell"))


@register("anomaly_flags")
def q_anomaly_flags(spark, sf_dir):
    """Reconstruction error, mean + 3 std threshold, flags."""
    data = vm_power(spark, sf_dir).checkpoint(eager=True)   # shared by fit and scoring
    model, _ = _autoencoder(spark, sf_dir, data)
    return _checked_flags(anomaly.score_anomalies(data, model))


def _checked_flags(flagged):
    """Key, and whether the flag is error > mean + 3 std, recomputed here."""
    e = F.col("reconstruction_error")
    cut = flagged.agg(F.avg(e) + 3 * F.stddev_pop(e)).first()[0]
    near = F.abs(F.col("threshold") - cut) <= 1e-9 * abs(cut)
    return ntz(flagged.select("_time", "vm_id", (near & (
        F.col("is_anomaly") == (e > F.col("threshold")))).alias("flag_ok")))


@register("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """A random forest stored, loaded, and re-scored."""
    df, model = _energy_forest(spark, sf_dir)
    path = scratch_path(spark, "model-rf")
    forest.save_model(model, path)
    loaded = forest.load_model(path)
    test = df.where(F.col("split") == "test")
    a = forest.predict(model, test, "p_saved")
    b = forest.predict(loaded, a, "p_loaded")
    return ntz(b.select(*SPLIT_KEY, (F.col("p_saved") == F.col("p_loaded")).alias("same")))


@register("dense_model_roundtrip")
def q_dense_model_roundtrip(spark, sf_dir):
    """The VM power MLP (weights + scaler) stored as one Parquet row,
    loaded, and re-scored on the test split."""
    df, model, _ = _vm_mlp(spark, sf_dir)
    path = scratch_path(spark, "model-mlp")
    dense.save_dense(spark, model, path)
    loaded = dense.load_dense(spark, path)
    test = df.where(F.col("split") == "test")
    a = dense.predict_dense(test, model, "p_saved")
    b = dense.predict_dense(a, loaded, "p_loaded")
    return ntz(b.select(*VM_SPLIT_KEY, (F.col("p_saved") == F.col("p_loaded")).alias("same")))


@register("energy_workflow")
def q_energy_workflow(spark, sf_dir):
    """Select (Kepler, k8s) -> process -> dataset -> split -> forest ->
    MAE / MSE / R2 on the test split; splits, model and metrics are stored
    and read back."""
    path = scratch_path(spark, "energy-run")
    workflows.energy_workflow(tel(spark, sf_dir), START, STOP, vm_name_filter=VM_FILTER,
                                    interval=DATASET_INTERVAL, split_key=SPLIT_KEY,
                                    max_depth=FOREST_DEPTH, output=path)
    return _stored_run(spark, path)


def _stored_run(spark, path):
    """A stored run read back: rows per split and the last metrics row."""
    train = sinks.read_split(spark, f"{path}/splits", "train").count()
    m = sinks.read_table(spark, f"{path}/metrics")
    return m.select("run_id", "n", "n_train", (F.col("n_train") == train).alias("splits_agree"),
                    (_finite("mae") & _finite("mse") & (F.col("r2") <= 1)).alias("metrics_ok"))


@register("vm_power_workflow")
def q_vm_power_workflow(spark, sf_dir):
    """Select (Proxmox, scaphandre) -> process -> dataset -> split ->
    scaler -> MLP -> MAE / MSE / R2 on the test split; splits, model and
    metrics are stored and read back."""
    path = scratch_path(spark, "vm-run")
    workflows.vm_power_workflow(tel(spark, sf_dir), START, STOP, vm_name_filter=VM_FILTER,
                                      interval=DATASET_INTERVAL, split_key=VM_SPLIT_KEY,
                                      output=path)
    return _stored_run(spark, path)


@register("anomaly_workflow")
def q_anomaly_workflow(spark, sf_dir):
    """VM dataset -> scaler -> autoencoder -> errors -> anomaly flags."""
    flagged, _, _ = workflows.anomaly_workflow(vm_power(spark, sf_dir))
    return _checked_flags(flagged)


@register("batch_score")
def q_batch_score(spark, sf_dir):
    """A stored forest applied to the whole energy dataset; its error on
    the rows it was not trained on."""
    df, model = _energy_forest(spark, sf_dir)
    path = scratch_path(spark, "model-served")
    forest.save_model(model, path)
    train, test = (df.where(F.col("split") == k) for k in ("train", "test"))
    return _graded(workflows.batch_score(path, df), train, test, ENERGY_TARGET, SPLIT_KEY, 0.1)
