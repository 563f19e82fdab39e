"""DuckDB SQL oracles for the registered queries.

Each oracle rebuilds the stand-in telemetry from ``events`` with the same
expressions (:func:`wattspark.sources.standins.standin_sql`) and then states
the operator's semantics directly in SQL, independently of the Spark code.
"""

from __future__ import annotations

from wattspark.catalog import trained_sql
from wattspark.schemas import (
    DEFAULT_CLUSTER_FILTER, DEFAULT_VM_NAME_FILTER, ENERGY_FEATURES, K8S_DROP, SOURCES,
    VM_PROXMOX_COLUMNS, VM_SCAPH_AGG,
)
from wattspark.sources.standins import STANDINS, overlapping_exports_sql, standin_sql

DAY = "day"
START = "TIMESTAMP '2024-01-03 00:00:00'"
STOP = "TIMESTAMP '2024-01-28 00:00:00'"
VM_FILTER = DEFAULT_VM_NAME_FILTER
CLUSTER = DEFAULT_CLUSTER_FILTER
SEED = 42
TEST_CUT = 2000  # of 10000 buckets

_TEXT_NUM = "TRY_CAST(trim(_value) AS DOUBLE)"


def q(name: str) -> str:
    return f'"{name}"'


def cols(names) -> str:
    return ", ".join(q(c) for c in names)


def L(source: str) -> str:
    return standin_sql(source)


def telemetry_sql() -> str:
    parts = [f"SELECT * REPLACE (CAST(_value AS VARCHAR) AS _value) FROM {L(s)} x"
             for s in STANDINS]
    return "(" + " UNION ALL BY NAME ".join(parts) + ")"


def num(expr: str = "_value") -> str:
    return f"TRY_CAST(trim({expr}) AS DOUBLE)"


def pivot_sql(source: str, fields: list[str] | None = None, long_sql: str | None = None,
              index: list[str] | None = None, per_file: bool = False) -> str:
    """Pivot (mean per key and field); ``per_file`` groups by export too
    (the file column is not part of the output)."""
    src = SOURCES[source]
    fields = fields or src.fields
    index = index or src.index
    if per_file:
        inner = pivot_sql(source, fields, long_sql, ["_file"] + list(index))
        return f"(SELECT {cols(index)}, {cols(fields)} FROM {inner} pf)"
    long_sql = long_sql or L(source)
    val = _TEXT_NUM if src.value_is_text else "_value"
    aggs = ", ".join(f"avg(__val) FILTER (WHERE _field = '{f}') AS {q(f)}" for f in fields)
    declared = ", ".join(f"'{f}'" for f in src.fields)
    keys_ok = " AND ".join(f"{q(c)} IS NOT NULL" for c in index)
    return (f"(SELECT {cols(index)}, {aggs} FROM (SELECT *, {val} AS __val FROM {long_sql} l) p "
            f"WHERE __val IS NOT NULL AND NOT isnan(__val) AND _field IN ({declared}) "
            f"AND {keys_ok} GROUP BY {cols(index)})")


def notnull_all(names) -> str:
    return " AND ".join(f"{q(c)} IS NOT NULL" for c in names)


def notmissing_all(names, doubles) -> str:
    parts = []
    for c in names:
        parts.append(f"{q(c)} IS NOT NULL" + (f" AND NOT isnan({q(c)})" if c in doubles else ""))
    return " AND ".join(parts)


# --------------------------------------------------------------------------
# processed tables
# --------------------------------------------------------------------------

def wide_k8s() -> str:
    return pivot_sql("k8s")


def wide_kepler(long_sql: str | None = None) -> str:
    return pivot_sql("kepler", long_sql=long_sql)


def selected(source: str) -> str:
    """Rows of a source that the default selection of its plugin keeps."""
    cond = f"_time >= {START} AND _time < {STOP}"
    if source in ("k8s", "kepler"):
        cond += f" AND regexp_matches(\"inventory-server-id\", '{CLUSTER}')"
    else:
        cond += f" AND regexp_matches(vm_name, '{VM_FILTER}')"
    return f"(SELECT * FROM {L(source)} raw WHERE {cond})"


def closer(source: str) -> str:
    """The stand-in rows at finer times, as the 1-minute query shapes them."""
    return (f"(SELECT * REPLACE (date_trunc('day', _time) + to_minutes(CAST(hour(_time) AS INTEGER)) "
            f"+ to_seconds(CAST(second(_time) AS INTEGER)) AS _time) FROM {L(source)} raw)")


def wide_pdu_faithful() -> str:
    # the stand-in has one export file per day (of the scrape hour); the
    # metadata join pairs a wide row with the URLs of its own export
    w = pivot_sql("pdu")
    f = SOURCES["pdu"].fields
    return f"""(SELECT w._time, w."inventory-server-id", w.placement, w.url AS url_x,
        {', '.join('w.' + q(x) for x in f)}, m.url AS url_y
      FROM {w} w LEFT JOIN (SELECT DISTINCT strftime(_time, '%Y%m%d') AS f, "inventory-server-id", url
                            FROM {L('pdu')} r) m
        ON w."inventory-server-id" = m."inventory-server-id"
       AND strftime(w._time, '%Y%m%d') = m.f)"""


def disk_cols(prefix: str = "") -> str:
    p = prefix
    return f"""{p}disk_free / 1073741824 AS disk_free_gb,
        {p}disk_total / 1073741824 AS disk_total_gb,
        ({p}disk_total - {p}disk_free) / 1073741824 AS disk_used_gb,
        100 * (1 - CASE WHEN {p}disk_free IS NULL OR {p}disk_total IS NULL THEN NULL
                        WHEN {p}disk_total <> 0 THEN {p}disk_free / {p}disk_total
                        WHEN {p}disk_free > 0 THEN 'inf'::DOUBLE
                        WHEN {p}disk_free < 0 THEN '-inf'::DOUBLE END) AS disk_usage_percent"""


def wide_proxmox(long_sql: str | None = None) -> str:
    return f"(SELECT w.*, {disk_cols('w.')} FROM {pivot_sql('proxmox', long_sql=long_sql)} w)"


def wide_scaph(source: str, long_sql: str | None = None) -> str:
    src = SOURCES[source]
    allc = src.index + src.fields
    return (f"(SELECT DISTINCT * FROM {pivot_sql(source, long_sql=long_sql)} w "
            f"WHERE {notmissing_all(allc, set(src.fields))})")


def energy_join_sql(interval: str = DAY, rows=None) -> str:
    """``rows`` gives the long rows of a source (default: all stand-in rows)."""
    rows = rows or L
    k8s = pivot_sql("k8s", ["cpu_usage_nanocores", "memory_usage_bytes", "logsfs_used_bytes",
                            "logsfs_capacity_bytes"], long_sql=rows("k8s"))
    return f"""(
  SELECT k._time, k.container_name, k.namespace, k.pod_name, k.cpu_usage_nanocores,
         k.memory_usage_bytes, k.logsfs_used_bytes, k.logsfs_capacity_bytes,
         e.kepler_container_joules_total
  FROM (SELECT date_trunc('{interval}', _time) AS _time, container_name, namespace, pod_name,
               cpu_usage_nanocores, memory_usage_bytes, logsfs_used_bytes, logsfs_capacity_bytes
        FROM {k8s} w
        WHERE cpu_usage_nanocores IS NOT NULL AND memory_usage_bytes IS NOT NULL
          AND logsfs_used_bytes IS NOT NULL AND logsfs_capacity_bytes IS NOT NULL) k
  JOIN {kepler_energy_sql(interval, rows)} e
    ON k._time = e._time AND k.container_name = e.container_name
   AND k.namespace = e.namespace AND k.pod_name = e.pod_name)"""


def kepler_energy_sql(interval: str = DAY, rows=None) -> str:
    rows = rows or L
    return f"""(SELECT date_trunc('{interval}', _time) AS _time, container_name, namespace, pod_name,
         coalesce(sum(kepler_container_joules_total), 0.0) AS kepler_container_joules_total
  FROM {wide_kepler(rows("kepler"))} w
  WHERE container_name IS NOT NULL AND namespace IS NOT NULL AND pod_name IS NOT NULL
  GROUP BY 1, 2, 3, 4)"""


def energy_sql(interval: str = DAY, rows=None) -> str:
    return f"""(SELECT _time, container_name, namespace, pod_name,
       cpu_usage_nanocores / 1e6 AS cpu_millicores,
       memory_usage_bytes / 1048576 AS memory_usage_mb,
       CASE WHEN logsfs_capacity_bytes > 0
            THEN logsfs_used_bytes / logsfs_capacity_bytes * 100 ELSE 0.0 END
         AS logsfs_usage_percent,
       kepler_container_joules_total / 60 AS container_power_watts
  FROM {energy_join_sql(interval, rows)} j)"""


def scaph_agg_sql(interval: str = DAY, rows=None) -> str:
    rows = rows or L
    aggs = []
    for c, how in VM_SCAPH_AGG.items():
        aggs.append(f"avg({q(c)}) AS {q(c)}" if how == "mean"
                    else f"coalesce(sum({q(c)}), 0.0) AS {q(c)}")
    return f"""(SELECT date_trunc('{interval}', _time) AS _time, vm_id, {', '.join(aggs)}
  FROM {wide_scaph('scaphandre_vm', rows('scaphandre_vm'))} w
  WHERE contains(vm_name, 'k8s') AND vm_id IS NOT NULL
  GROUP BY 1, 2)"""


def vm_join_sql(interval: str = DAY, rows=None) -> str:
    rows = rows or L
    pc = [c for c in VM_PROXMOX_COLUMNS if c not in ("_time",)]
    doubles = set(VM_PROXMOX_COLUMNS) - {"_time", "vm_id"}
    prox_ok = " AND ".join(f"p.{q(c)} IS NOT NULL" + (f" AND NOT isnan(p.{q(c)})" if c in doubles else "")
                           for c in VM_PROXMOX_COLUMNS)
    return f"""(SELECT p.*, {', '.join('s.' + q(c) for c in VM_SCAPH_AGG)}
  FROM (SELECT date_trunc('{interval}', _time) AS _time, {cols(pc)}
        FROM {wide_proxmox(rows('proxmox'))} w WHERE contains(vm_name, 'k8s')) p
  JOIN {scaph_agg_sql(interval, rows)} s ON p._time = s._time AND p.vm_id = s.vm_id
  WHERE {prox_ok})"""


def vm_dataset_sql(interval: str = DAY, rows=None) -> str:
    allc = VM_PROXMOX_COLUMNS + list(VM_SCAPH_AGG) + ["uptime_hours", "vm_power_watts"]
    doubles = set(allc) - {"_time", "vm_id"}
    return f"""(SELECT * FROM (SELECT j.*, uptime / 3600 AS uptime_hours,
         scaph_process_power_consumption_microwatts / 1e6 AS vm_power_watts
  FROM {vm_join_sql(interval, rows)} j) d WHERE {notmissing_all(allc, doubles)})"""


def inventory_sql() -> str:
    return f"""(SELECT DISTINCT trim("inventory-server-id") AS "inventory-server-id"
  FROM {telemetry_sql()} t
  WHERE plugin = 'proxmox' AND _time >= {START} AND _time < {STOP}
    AND regexp_matches(vm_name, '{VM_FILTER}')
    AND trim("inventory-server-id") <> '')"""


def vm_split_sql(rows=None, seed: int = SEED) -> str:
    key = "concat_ws('|', CAST(_time AS VARCHAR), CAST(vm_id AS VARCHAR))"
    bucket = f"(('0x' || substr(md5({key} || '|{seed}'), 1, 8))::BIGINT % 10000)"
    return (f"(SELECT v.*, CASE WHEN {bucket} < {TEST_CUT} THEN 'test' ELSE 'train' END AS split "
            f"FROM {vm_dataset_sql(rows=rows)} v)")


def stored_run_sql(run_id: str, splits: str) -> str:
    return (f"SELECT '{run_id}' AS run_id, CAST(count(*) FILTER (WHERE split = 'test') AS BIGINT) AS n, "
            f"CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS n_train, "
            f"true AS splits_agree, true AS metrics_ok FROM {splits} s")


def split_sql(interval: str = DAY, seed: int = SEED, rows=None) -> str:
    key = "concat_ws('|', CAST(_time AS VARCHAR), container_name, namespace, pod_name)"
    bucket = f"(('0x' || substr(md5({key} || '|{seed}'), 1, 8))::BIGINT % 10000)"
    return (f"(SELECT e.*, CASE WHEN {bucket} < {TEST_CUT} THEN 'test' ELSE 'train' END AS split "
            f"FROM {energy_sql(interval, rows)} e)")


# --------------------------------------------------------------------------
# oracle per query
# --------------------------------------------------------------------------

def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    for source in ("kepler", "pdu", "proxmox"):
        tags = sorted(SOURCES[source].tags + ["plugin"])
        o[f"scan_long_{source}"] = (f"SELECT result, \"table\", _time, _value, _field, _measurement, "
                                    f"{cols(tags)} FROM {L(source)} x")
    o["scan_long_proxmox"] = (f"SELECT * EXCLUDE (_value), {num()} AS number, CASE WHEN {num()} IS NULL "
                              f"THEN _value END AS value_text FROM ({o['scan_long_proxmox']}) y")
    k8s_tags = sorted(SOURCES["k8s"].tags + ["plugin"])
    o["scan_long"] = (f"SELECT result, \"table\", _time, _value, _field, _measurement, "
                      f"{cols(k8s_tags)} FROM {L('k8s')} x")
    o["scan_routed"] = (f"SELECT 'host' AS route, _time, _field, _value, url FROM {L('scaphandre_host')} a "
                        f"UNION ALL SELECT 'vm', _time, _field, _value, url FROM {L('scaphandre_vm')} b")
    o["scan_multi_table_csv"] = (f"SELECT \"table\", _time, _field, _value, url "
                                 f"FROM {L('scaphandre_host')} x")
    o["telemetry_select"] = (f"SELECT _time, _field, url, vm_id, vm_name, {num()} AS _value "
                             f"FROM {telemetry_sql()} t WHERE plugin = 'scaphandre' "
                             f"AND _time >= {START} AND _time < {STOP} "
                             f"AND regexp_matches(vm_name, '{VM_FILTER}')")
    o["telemetry_store_select"] = o["telemetry_select"]
    o["export_partitioned"] = (f"SELECT 'pdu_' || i.\"inventory-server-id\" || '_run1' AS export, "
                               f"p._time, p.\"inventory-server-id\", p.placement, p.url, p._field, "
                               f"p._value FROM {L('pdu')} p JOIN {inventory_sql()} i "
                               f"ON p.\"inventory-server-id\" = i.\"inventory-server-id\" "
                               f"WHERE p._time >= {START} AND p._time < {STOP}")
    o["processed_roundtrip"] = f"SELECT * FROM {wide_k8s()} w"
    o["split_sink"] = f"SELECT * FROM {split_sql()} s WHERE split = 'test'"

    # filters
    o["filter_eq"] = (f"SELECT _time, \"inventory-server-id\", url, {num()} AS _value "
                      f"FROM {telemetry_sql()} t WHERE plugin = 'pdu' AND _field = 'activePower'")
    o["filter_regex"] = (f"SELECT _time, vm_id, vm_name, _field, {num()} AS _value "
                         f"FROM {telemetry_sql()} t WHERE plugin = 'proxmox' "
                         f"AND regexp_matches(vm_name, '{VM_FILTER}')")
    o["filter_time_range"] = (f"SELECT _time, container_name, pod_name, _field, _value FROM {L('k8s')} x "
                              f"WHERE _time >= {START} AND _time < {STOP}")
    o["filter_not_null"] = (f"SELECT _time, container_name, pod_name, _field, _value FROM {L('k8s')} x "
                            f"WHERE container_name IS NOT NULL AND pod_name IS NOT NULL")
    o["filter_contains"] = (f"SELECT _time, vm_id, vm_name, cpuload, mem_used FROM {wide_proxmox()} w "
                            f"WHERE contains(vm_name, 'k8s')")
    o["filter_icontains"] = (f"SELECT _time, vm_id, vm_name, cpuload, mem_used FROM {wide_proxmox()} w "
                             f"WHERE contains(lower(vm_name), 'k8s')")
    vsrc = SOURCES["scaphandre_vm"]
    o["dropna_any"] = (f"SELECT * FROM {pivot_sql('scaphandre_vm')} w "
                       f"WHERE {notmissing_all(vsrc.index + vsrc.fields, set(vsrc.fields))}")
    o["dropna_subset"] = (f"SELECT {cols(SOURCES['k8s'].index)}, cpu_usage_nanocores, network_rx_bytes "
                          f"FROM {wide_k8s()} w WHERE cpu_usage_nanocores IS NOT NULL "
                          f"AND NOT isnan(cpu_usage_nanocores) AND network_rx_bytes IS NOT NULL "
                          f"AND NOT isnan(network_rx_bytes)")
    o["exists_gate"] = (f"SELECT _time, \"inventory-server-id\", _field, {num()} AS _value "
                        f"FROM {telemetry_sql()} t WHERE plugin = 'pdu' "
                        f"AND EXISTS (SELECT 1 FROM {inventory_sql()} i)")

    # projections
    keep = [c for c in ["result", "table", "_start", "_stop", "_time", "_value", "_field",
                        "_measurement"] + k8s_tags if c not in K8S_DROP]
    o["drop_columns"] = f"SELECT {cols(keep)} FROM {L('k8s')} x"
    o["select_columns"] = (f"SELECT {cols(ENERGY_FEATURES)}, container_power_watts "
                           f"FROM {energy_sql()} e")
    o["guarded_columns"] = (f"SELECT _time, vm_id, disk_free_gb, disk_total_gb, disk_used_gb "
                            f"FROM {wide_proxmox()} w")

    # joins
    o["join_energy"] = f"SELECT * FROM {energy_join_sql()} j"
    o["join_vm_power"] = f"SELECT * FROM {vm_join_sql()} j"
    o["join_left_meta"] = f"SELECT * FROM {wide_pdu_faithful()} w"
    o["semi_join_inventory"] = (f"SELECT _time, \"inventory-server-id\", url, _field, {num()} AS _value "
                                f"FROM {telemetry_sql()} t WHERE plugin = 'pdu' AND "
                                f"\"inventory-server-id\" IN (SELECT \"inventory-server-id\" FROM {inventory_sql()} i)")
    o["theta_join_regex"] = (f"SELECT h._time, h.url, i.\"inventory-server-id\" AS inventory_id, h._value "
                             f"FROM {L('scaphandre_host')} h JOIN {inventory_sql()} i "
                             f"ON regexp_matches(h.url, i.\"inventory-server-id\")")

    # aggregations
    ov_k8s = (f"(SELECT * FROM {overlapping_exports_sql('k8s')} o "
              f"WHERE container_name IS NOT NULL AND pod_name IS NOT NULL)")
    ov_host = overlapping_exports_sql("scaphandre_host")
    o["pivot_mean"] = f"SELECT * FROM {pivot_sql('pdu')} w"
    kidx = SOURCES["k8s"].index
    discovered = pivot_sql("k8s", sorted(STANDINS["k8s"].fields),
                           long_sql=standin_sql("k8s", with_file=True), per_file=True)
    o["pivot_discover"] = f"SELECT * FROM {discovered} w"
    o["pivot_mean_coerced"] = f"SELECT * FROM {pivot_sql('proxmox')} w"
    o["pivot_overlapping_exports"] = (
        f"SELECT * FROM {pivot_sql('k8s', long_sql=ov_k8s, per_file=True)} w")
    hsrc = SOURCES["scaphandre_host"]
    o["distinct_overlapping_exports"] = (
        f"SELECT DISTINCT * FROM {pivot_sql('scaphandre_host', long_sql=ov_host, per_file=True)} w "
        f"WHERE {notmissing_all(hsrc.index + hsrc.fields, set(hsrc.fields))}")
    o["distinct_rows"] = f"SELECT DISTINCT _time, _value, url FROM {L('scaphandre_host')} x"
    o["distinct_inventory"] = f"SELECT * FROM {inventory_sql()} i"
    o["distinct_pairs"] = (f"SELECT DISTINCT \"inventory-server-id\", vm_name FROM {telemetry_sql()} t "
                           f"WHERE plugin = 'proxmox' AND _time >= {START} AND _time < {STOP} "
                           f"AND regexp_matches(vm_name, '{VM_FILTER}') AND NOT "
                           f"((\"inventory-server-id\" IS NULL OR trim(\"inventory-server-id\") = '') "
                           f"AND (vm_name IS NULL OR trim(vm_name) = ''))")
    o["group_sum_zero"] = f"SELECT * FROM {kepler_energy_sql()} e"
    o["group_mixed_agg"] = f"SELECT * FROM {scaph_agg_sql()} s"
    shape_parts = []
    ncols = {"k8s": 36, "kepler": 7, "pdu": 14, "proxmox": 23, "scaphandre_host": 3,
             "scaphandre_vm": 13}
    wides = {"k8s": wide_k8s(), "kepler": wide_kepler(), "pdu": wide_pdu_faithful(),
             "proxmox": wide_proxmox(), "scaphandre_host": wide_scaph("scaphandre_host"),
             "scaphandre_vm": wide_scaph("scaphandre_vm")}
    for name, sql in wides.items():
        shape_parts.append(f"SELECT '{name}' AS \"table\", count(*) AS n_rows, "
                           f"CAST({ncols[name]} AS BIGINT) AS n_columns FROM {sql} w")
    o["profile_shape"] = " UNION ALL ".join(shape_parts)
    psrc = SOURCES["proxmox"]
    pcols = psrc.index + psrc.fields + ["disk_free_gb", "disk_total_gb", "disk_used_gb",
                                        "disk_usage_percent"]
    nparts = []
    for i, c in enumerate(pcols):
        miss = f"{q(c)} IS NULL" + ("" if c in psrc.index else f" OR isnan({q(c)})")
        nparts.append(f"SELECT '{c}' AS \"column\", {i} AS position, "
                      f"CAST(count(*) FILTER (WHERE {miss}) AS BIGINT) AS n_missing FROM w")
    o["profile_nulls"] = f"WITH w AS {wide_proxmox()} " + " UNION ALL ".join(nparts)
    ecols = [("_time", "timestamp_ntz"), ("container_name", "string"), ("namespace", "string"),
             ("pod_name", "string"), ("cpu_millicores", "double"), ("memory_usage_mb", "double"),
             ("logsfs_usage_percent", "double"), ("container_power_watts", "double")]
    cparts = []
    for c, t in ecols:
        isnum = t == "double"
        miss = f"{q(c)} IS NULL" + (f" OR isnan({q(c)})" if isnum else "")
        lo = f"CAST(min({q(c)}) AS DOUBLE)" if isnum else "CAST(NULL AS DOUBLE)"
        hi = f"CAST(max({q(c)}) AS DOUBLE)" if isnum else "CAST(NULL AS DOUBLE)"
        istime = t == "timestamp_ntz"
        tlo = f"min({q(c)})" if istime else "CAST(NULL AS TIMESTAMP)"
        thi = f"max({q(c)})" if istime else "CAST(NULL AS TIMESTAMP)"
        cparts.append(f"SELECT '{c}' AS \"column\", '{t}' AS dtype, "
                      f"CAST(count(DISTINCT {q(c)}) AS BIGINT) AS n_distinct, "
                      f"CAST(count(*) FILTER (WHERE {miss}) AS BIGINT) AS n_missing, "
                      f"count(DISTINCT {q(c)}) <= 1 AS is_constant, {lo} AS min_value, "
                      f"{hi} AS max_value, {tlo} AS min_time, {thi} AS max_time FROM e")
    o["profile_columns"] = f"WITH e AS {energy_sql()} " + " UNION ALL ".join(cparts)
    vs = []
    for c in [x for x in kidx if x != "_time"]:
        vs.append(f"SELECT '{c}' AS \"column\", {q(c)} AS value, count(*) AS n_rows FROM w "
                  f"WHERE {q(c)} IS NOT NULL GROUP BY 2")
    o["profile_value_sets"] = f"WITH w AS {wide_k8s()} " + " UNION ALL ".join(vs)
    o["threshold_3sigma"] = (f"SELECT round(avg(container_power_watts), 6) AS mean, "
                             f"round(stddev_pop(container_power_watts), 6) AS std, "
                             f"round(avg(container_power_watts) + 3 * stddev_pop(container_power_watts), 6) "
                             f"AS threshold FROM {energy_sql()} e")
    dev = " + ".join(f"({c} - m_{c}) * ({c} - m_{c})" for c in ENERGY_FEATURES)
    means = ", ".join(f"avg({c}) AS m_{c}" for c in ENERGY_FEATURES)
    o["rowwise_mse"] = (f"WITH e AS {energy_sql()} SELECT _time, container_name, namespace, pod_name, "
                        f"round(({dev}) / {float(len(ENERGY_FEATURES))}, 3) AS row_mse "
                        f"FROM e CROSS JOIN (SELECT {means} FROM e) m")
    o["max_of_two"] = (f"SELECT greatest(max(container_power_watts), max(cpu_millicores)) AS max_value "
                       f"FROM {energy_sql()} e")

    # sorts / sets
    o["sort_time"] = f"SELECT * FROM {wide_scaph('scaphandre_host')} w"
    o["limit_head"] = f"SELECT * FROM {wide_scaph('scaphandre_host')} w ORDER BY _time, url LIMIT 5"
    o["union_by_name"] = f"SELECT * FROM {wide_k8s()} a UNION ALL BY NAME SELECT * FROM {wide_kepler()} b"
    o["select_all_plugins"] = all_plugins_sql()
    o["run_plugin"] = (f"SELECT i.\"inventory-server-id\" AS export_name, t._time, t.\"inventory-server-id\", "
                       f"t.url, t._field, {num('t._value')} AS _value FROM {telemetry_sql()} t "
                       f"JOIN {inventory_sql()} i ON t.\"inventory-server-id\" = i.\"inventory-server-id\" "
                       f"WHERE t.plugin = 'pdu' AND t._time >= {START} AND t._time < {STOP}")

    o["run_plugin_field"] = (o["run_plugin"] + " AND t._field = 'activePower' "
                             "AND regexp_matches(t.url, i.\"inventory-server-id\")")

    # scalar functions
    o["parse_time"] = ("SELECT event_id, ts AS parsed, CAST(NULL AS TIMESTAMP) AS parsed_props "
                       "FROM events")
    o["to_numeric_coerce"] = f"SELECT _time, vm_id, _field, {num()} AS value FROM {L('proxmox')} x"
    o["time_floor"] = ("SELECT event_id, date_trunc('minute', ts) AS t1m, make_timestamp(epoch_us(ts) - epoch_us(ts) % 900000000) AS t15m, "
                       "date_trunc('hour', ts) AS t1h, date_trunc('day', ts) AS t1d FROM events")
    o["unit_conversions"] = (f"SELECT _time, container_name, namespace, pod_name, "
                             f"cpu_usage_nanocores / 1e6 AS cpu_millicores, "
                             f"memory_usage_bytes / 1048576 AS memory_usage_mb, "
                             f"kepler_container_joules_total / 60 AS container_power_watts "
                             f"FROM {energy_join_sql()} j")
    o["ieee_percent"] = (f"SELECT _time, vm_id, disk_free, disk_total, disk_usage_percent "
                         f"FROM {wide_proxmox()} w")
    o["guarded_percent"] = (f"SELECT {cols(SOURCES['k8s'].index)}, CASE WHEN logsfs_capacity_bytes > 0 "
                            f"THEN logsfs_used_bytes / logsfs_capacity_bytes * 100 ELSE 0.0 END "
                            f"AS logsfs_usage_percent FROM {wide_k8s()} w "
                            f"WHERE logsfs_used_bytes IS NOT NULL AND logsfs_capacity_bytes IS NOT NULL")
    stem = VM_FILTER[1:-1]
    o["export_name"] = (f"SELECT \"inventory-server-id\", coalesce(\"inventory-server-id\", '{stem}') "
                        f"AS export_name, '{stem}' AS filter_export_name FROM {inventory_sql()} i")

    # learning
    k8s = SOURCES["k8s"]
    hour_long = f"(SELECT * REPLACE (date_trunc('hour', _time) AS _time) FROM {L('k8s')} z)"
    o["stream_window_pivot"] = f"SELECT * FROM {pivot_sql('k8s', long_sql=hour_long)} w"
    o["train_test_split"] = f"SELECT * FROM {split_sql()} s"
    ekey = ("concat_ws('|', CAST(_time AS VARCHAR), container_name, namespace, pod_name, "
            "printf('%.4f', cpu_millicores), printf('%.4f', memory_usage_mb), "
            "printf('%.4f', logsfs_usage_percent))")
    o["train_test_split_exact"] = f"""WITH e AS {energy_sql()},
  h AS (SELECT e.*, ('0x' || substr(md5({ekey} || '|{SEED}'), 1, 15))::BIGINT AS u FROM e),
  r AS (SELECT h.*, row_number() OVER (ORDER BY u) AS rn, count(*) OVER () AS n FROM h)
SELECT _time, container_name, namespace, pod_name, cpu_millicores, memory_usage_mb,
       logsfs_usage_percent, container_power_watts,
       CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM r"""
    fstats = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL "
                       f"THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}" for c in ENERGY_FEATURES)
    scaled = ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in ENERGY_FEATURES)
    o["standard_scale"] = (f"WITH s AS {split_sql()} SELECT _time, container_name, namespace, pod_name, "
                           f"split, {scaled} FROM s CROSS JOIN "
                           f"(SELECT {fstats} FROM s WHERE split = 'train') m")
    o["regression_metrics"] = f"""WITH s AS {split_sql()},
  m AS (SELECT avg(container_power_watts) AS p FROM s WHERE split = 'train'),
  t AS (SELECT container_power_watts AS y, p FROM s CROSS JOIN m WHERE split = 'test'),
  a AS (SELECT count(*) AS n, avg(abs(y - p)) AS mae, avg((y - p) * (y - p)) AS mse,
               sum((y - p) * (y - p)) AS sse, var_pop(y) * count(*) AS sst FROM t)
SELECT n, round(mae, 6) AS mae, round(mse, 6) AS mse,
       round(CASE WHEN n = 0 THEN NULL WHEN sst = 0 THEN CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END
                  ELSE 1 - sse / sst END, 6) AS r2 FROM a"""
    o["metrics_log"] = " UNION ALL ".join(
        f"SELECT '{rid}' AS run_id, * FROM ({metrics_sql(seed)}) m{k}"
        for k, (rid, seed) in enumerate((("run-42", 42), ("run-7", 7))))

    # processed tables and datasets
    o["prep_k8s"] = f"SELECT * FROM {wide_k8s()} w"
    o["prep_kepler"] = f"SELECT * FROM {wide_kepler()} w"
    o["prep_pdu"] = f"SELECT * FROM {wide_pdu_faithful()} w"
    o["prep_proxmox"] = f"SELECT * FROM {wide_proxmox()} w"
    o["prep_scaphandre_host"] = f"SELECT * FROM {wide_scaph('scaphandre_host')} w"
    o["prep_scaphandre_vm"] = f"SELECT * FROM {wide_scaph('scaphandre_vm')} w"
    o["energy_dataset"] = f"SELECT * FROM {energy_sql()} e"
    o["vm_power_dataset"] = f"SELECT * FROM {vm_dataset_sql()} v"
    o["energy_dataset_1min"] = f"SELECT * FROM {energy_sql('minute', closer)} e"
    o["energy_dataset_skew_split"] = o["energy_dataset"]
    o["vm_power_dataset_skew_split"] = o["vm_power_dataset"]

    # models: keys, true values and checked properties
    ekeys, vkeys = "_time, container_name, namespace, pod_name", "_time, vm_id"
    test = "split = 'test'"
    def graded(split: str, keys: str, target: str, label: str, where: str) -> str:
        """The planted label of the rows ``where``, and the train-mean predictor's test error."""
        return f"""WITH s AS (SELECT * REPLACE ({label} AS {target}) FROM {split} p),
  m AS (SELECT avg({target}) AS mean FROM s WHERE split = 'train'),
  b AS (SELECT round(avg(({target} - mean) * ({target} - mean)), 6) AS mean_mse FROM s CROSS JOIN m
        WHERE split = 'test')
SELECT {keys}, round({target}, 6) AS y_true, mean_mse, true AS fits FROM s CROSS JOIN b WHERE {where}"""

    energy_label = "cpu_millicores + 10 * logsfs_usage_percent"
    vm_label = "cpuload + 5 * mem_used_percentage"
    o["rf_energy"] = graded(split_sql(), ekeys, "container_power_watts", energy_label, test)
    o["rf_vm_power"] = graded(vm_split_sql(), vkeys, "vm_power_watts", vm_label, test)
    o["mlp_vm_power"] = o["rf_vm_power"]
    o["batch_score"] = graded(split_sql(), ekeys, "container_power_watts", energy_label, "true")
    o["model_roundtrip"] = f"SELECT {ekeys}, true AS same FROM {split_sql()} s WHERE {test}"
    o["dense_model_roundtrip"] = f"SELECT {vkeys}, true AS same FROM {vm_split_sql()} s WHERE {test}"
    o["feature_importance"] = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {f in energy_label} AS used, CAST(1.0 AS DOUBLE) AS total"
        for f in ENERGY_FEATURES)
    o["loss_history"] = ("SELECT CAST(i AS INTEGER) AS epoch, true AS finite, true AS fell "
                         "FROM range(1, 21) t(i)")
    o["autoencoder_train"] = ("SELECT CAST(i AS INTEGER) AS epoch, true AS finite, "
                              "true AS val_finite, true AS fell FROM range(1, 51) t(i)")
    o["anomaly_flags"] = f"SELECT {vkeys}, true AS flag_ok FROM {vm_dataset_sql()} v"
    o["anomaly_workflow"] = o["anomaly_flags"]
    o["energy_workflow"] = stored_run_sql("energy", split_sql(rows=selected))
    o["vm_power_workflow"] = stored_run_sql("vm_power", vm_split_sql(rows=selected))
    o["scan_paths"] = o["scan_long_pdu"]
    o["ingest_exactly_once"] = o["scan_changing_headers"] = o["scan_long_kepler"]
    o["theta_join_indexed"] = o["theta_join_regex"]
    o["stream_energy_join"] = o["energy_dataset"]
    o["energy_dataset_bucketed"], o["vm_power_dataset_bucketed"] = o["energy_dataset"], o["vm_power_dataset"]
    o["processed_clustered"] = o["prep_k8s"]
    days = (f"(SELECT * FROM {L('scaphandre_vm')} x WHERE CAST(_time AS DATE) BETWEEN DATE '2024-01-05' "
            f"AND DATE '2024-01-13')")
    value = "CASE WHEN isnan(_value) THEN NULL ELSE _value END"
    o["profile_range_sketched"] = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) - count({e}) AS n_missing, "
        f"{low} AS low, {high} AS high, true AS near FROM {days} d"
        for c, e, low, high in (
            ("_value", value, f"min({value})", f"max({value})"), ("_field", "_field", "NULL::DOUBLE", "NULL::DOUBLE"),
            ("vm_id", "vm_id", "min(vm_id)::DOUBLE", "max(vm_id)::DOUBLE"),
            ("vm_name", "vm_name", "NULL::DOUBLE", "NULL::DOUBLE"), ("url", "url", "NULL::DOUBLE", "NULL::DOUBLE")))
    o["energy_run_resumed"] = (
        f"SELECT count(*) FILTER (WHERE split = 'test') AS n, CAST(6 AS INTEGER) AS executed, "
        f"CAST(6 AS INTEGER) AS reused FROM {split_sql(rows=selected)} s")
    o["incremental_energy"], o["incremental_vm_power"] = o["energy_dataset"], o["vm_power_dataset"]
    return {**o, **trained_sql.oracle_sql()}


def metrics_sql(seed: int = SEED) -> str:
    return f"""WITH s AS {split_sql(seed=seed)},
  m AS (SELECT avg(container_power_watts) AS p FROM s WHERE split = 'train'),
  t AS (SELECT container_power_watts AS y, p FROM s CROSS JOIN m WHERE split = 'test'),
  a AS (SELECT count(*) AS n, avg(abs(y - p)) AS mae, avg((y - p) * (y - p)) AS mse,
               sum((y - p) * (y - p)) AS sse, var_pop(y) * count(*) AS sst FROM t)
SELECT n, round(mae, 6) AS mae, round(mse, 6) AS mse,
       round(CASE WHEN n = 0 THEN NULL WHEN sst = 0 THEN CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END
                  ELSE 1 - sse / sst END, 6) AS r2 FROM a"""


def all_plugins_sql() -> str:
    t = telemetry_sql()
    rng = f"_time >= {START} AND _time < {STOP}"
    inv = inventory_sql()
    stem = VM_FILTER[1:-1]
    sel = "_time, _field, " + num() + " AS _value"
    parts = [
        f"SELECT 'proxmox' AS run_plugin, 'main' AS pass, '{stem}' AS export_name, {sel} FROM {t} x "
        f"WHERE plugin = 'proxmox' AND {rng} AND regexp_matches(vm_name, '{VM_FILTER}')",
        f"SELECT 'pdu', 'main', i.\"inventory-server-id\", x._time, x._field, {num('x._value')} "
        f"FROM {t} x JOIN {inv} i ON x.\"inventory-server-id\" = i.\"inventory-server-id\" "
        f"WHERE x.plugin = 'pdu' AND x._time >= {START} AND x._time < {STOP}",
        f"SELECT 'scaphandre', 'vm', '{stem}', {sel} FROM {t} x "
        f"WHERE plugin = 'scaphandre' AND {rng} AND regexp_matches(vm_name, '{VM_FILTER}')",
        f"SELECT 'scaphandre', 'host', i.\"inventory-server-id\", x._time, x._field, {num('x._value')} "
        f"FROM {t} x JOIN {inv} i ON regexp_matches(x.url, i.\"inventory-server-id\") "
        f"WHERE x.plugin = 'scaphandre' AND x._field = 'scaph_host_power_microwatts' "
        f"AND x._time >= {START} AND x._time < {STOP}",
        f"SELECT 'k8s', 'main', '{CLUSTER}', {sel} FROM {t} x "
        f"WHERE plugin = 'k8s' AND {rng} AND regexp_matches(\"inventory-server-id\", '{CLUSTER}')",
        f"SELECT 'kepler', 'main', '{CLUSTER}', {sel} FROM {t} x "
        f"WHERE plugin = 'kepler' AND {rng} AND regexp_matches(\"inventory-server-id\", '{CLUSTER}')",
    ]
    return ("SELECT * FROM (" + " UNION ALL ".join(parts) + f") u WHERE EXISTS (SELECT 1 FROM {inv} g)")


