import os
from datetime import datetime

from pyspark.sql import functions as F

from wattspark.operators.joins import regex_match_join
from wattspark.operators.select import exists_gate, export_name
from wattspark.plans import selection
from wattspark.schemas import DEFAULT_CLUSTER_FILTER, DEFAULT_VM_NAME_FILTER
from wattspark.sources import exports

VMP = DEFAULT_VM_NAME_FILTER.lstrip("^")     # names the default VM filter selects
CL = DEFAULT_CLUSTER_FILTER

TEL = ("plugin string, _time timestamp, _field string, _value string, "
       "`inventory-server-id` string, vm_name string, url string")


def _tel(spark):
    t = datetime(2025, 8, 4, 6, 0)
    rows = [
        ("proxmox", t, "cpuload", "1", " host1 ", VMP + "k8s-w1", None),
        ("proxmox", t, "cpuload", "1", "host10", VMP + "w2", None),
        ("proxmox", t, "cpuload", "1", "host3", "other-vm", None),
        ("proxmox", t, "cpuload", "1", "   ", VMP + "x", None),
        ("pdu", t, "activePower", "5", "host1", None, "http://pdu1"),
        ("pdu", t, "activePower", "6", "host3", None, "http://pdu3"),
        ("scaphandre", t, "scaph_host_power_microwatts", "7", None, None,
         "http://host10.x:8080/metrics"),
        ("scaphandre", datetime(2025, 8, 4, 7, 0), "scaph_host_power_microwatts", "8", None, None,
         "http://host1.x:8080/metrics"),
        ("k8s", t, "cpu_usage_nanocores", "9", CL + "-a", None, None),
        ("k8s", t, "cpu_usage_nanocores", "9", "edge-b", None, None),
    ]
    return spark.createDataFrame(rows, TEL)


START, STOP = datetime(2025, 8, 4, 6, 0), datetime(2025, 8, 4, 7, 0)


def test_inventory_ids_trimmed_distinct_sorted(spark):
    ids = [r[0] for r in selection.inventory_ids(_tel(spark), START, STOP).collect()]
    assert ids == ["host1", "host10"]


def test_time_range_start_inclusive_stop_exclusive(spark):
    spec = selection.TelemetrySpec("scaphandre", START, STOP)
    assert selection.select_telemetry(_tel(spark), spec).count() == 1


def test_run_plugin_pdu_and_regex_host(spark):
    tel = _tel(spark)
    pdu = selection.run_plugin(tel, "pdu", START, STOP)
    assert [(r["export_name"], r["_value"]) for r in pdu.collect()] == [("host1", "5")]
    host = selection.run_plugin(tel, "scaphandre", START, datetime(2025, 8, 4, 8, 0),
                                field="scaph_host_power_microwatts")
    got = sorted((r["export_name"], r["_value"]) for r in host.collect())
    # 'host1' is an unescaped pattern: it also matches host10
    assert got == [("host1", "7"), ("host1", "8"), ("host10", "7")]
    k8s = selection.run_plugin(tel, "k8s", START, STOP)
    assert [r["inventory-server-id"] for r in k8s.collect()] == [CL + "-a"]


def test_existence_gate(spark):
    tel = _tel(spark)
    empty = tel.where(F.lit(False))
    assert exists_gate(tel, empty).count() == 0
    assert exists_gate(tel, tel).count() == tel.count()
    assert selection.run_plugin(tel, "pdu", START, STOP, vm_name_filter="^nothing").count() == 0


def test_regex_join_escape_and_semi(spark):
    tel = _tel(spark).where("url is not null")
    ids = spark.createDataFrame([("host1",)], "id string")
    assert regex_match_join(tel, ids, "url", "id").count() == 2
    assert regex_match_join(tel, ids, "url", "id", how="left_semi").count() == 2
    # chunked broadcast gives the same pairs
    many = spark.createDataFrame([(f"host{i}",) for i in range(12)], "id string")
    a = regex_match_join(tel, many, "url", "id").count()
    b = regex_match_join(tel, many, "url", "id", max_broadcast_rows=1).count()
    assert a == b


def test_export_name():
    assert export_name("host1", "^prod-") == "host1"
    assert export_name(None, "^prod-") == "prod"


def _concatenated_sample(path):
    """A concatenated export shaped like appended query output: blank lines,
    a header per table, an empty first column, repeated tables."""
    header = (",result,table,_start,_stop,_time,_value,_field,_measurement,granularity,"
              "inventory-cluster-id,inventory-rack-id,plugin,url")
    lines = ["", "", "", ""]
    repeats = {"node3": 2, "node4": 2, "node5": 6}
    for node, times in repeats.items():
        for _ in range(times):
            lines.append(header)
            for m in range(1, 10):
                lines.append(
                    f",_result,0,2025-07-30T13:59:55.923183872Z,2025-07-30T14:09:55.923183872Z,"
                    f"2025-07-30T14:0{m}:02Z,{70000000 + m * 1000 + len(node)},"
                    f"scaph_host_power_microwatts,energy_measurements,host+process,cluster-b,r4,"
                    f"scaphandre,http://{node}.example:8080/metrics")
            lines.append("")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_read_concatenated_multi_table_csv(spark, tmp_dir):
    path = os.path.join(tmp_dir, "scaphandreHostData.csv")
    _concatenated_sample(path)
    df = exports.read_multi_table_csv(spark, path, "scaphandre_host")
    assert df.count() == 90
    assert df.select("_time", "_value", "url").distinct().count() == 27
    assert df.where("_start is null or _time is null or _value is null").count() == 0


def test_export_roundtrip_with_missing_tokens(spark, tmp_dir):
    t = datetime(2025, 8, 4, 6, 0)
    rows = [("_result", 0, None, None, t, 1.5, "activePower", "pdu", "r1", "srv,1", "A", "pdu", "u1"),
            ("_result", 0, None, None, t, None, "current", "pdu", "NA", "srv2", "B", "pdu", "u2")]
    df = spark.createDataFrame(rows, "result string, table int, _start timestamp, _stop timestamp, "
                                     "_time timestamp, _value double, _field string, _measurement string, "
                                     "`inventory-rack-id` string, `inventory-server-id` string, "
                                     "placement string, plugin string, url string")
    exports.write_exports(df, tmp_dir, "pdu", name_col="placement", run_id="r1")
    back = exports.read_exports(spark, tmp_dir, "pdu").orderBy("_field").collect()
    assert [r["_value"] for r in back] == [1.5, None]
    assert back[0]["inventory-server-id"] == "srv,1"           # quoted separator survives
    assert back[1]["inventory-rack-id"] is None                # 'NA' token is missing
    assert sorted(r["_file"] for r in back) == ["pdu_A_r1", "pdu_B_r1"]
    assert exports.read_exports(spark, os.path.join(tmp_dir, "nothing"), "pdu").count() == 0


def test_ingest_exports_into_store_and_select(spark, tmp_dir):
    from wattspark.sources import telemetry

    t = datetime(2025, 8, 4, 6, 0)
    rows = [("_result", 0, None, None, t, "2.5", "cpuload", "proxmox", "c", "r", "host1",
             "n1", "running", "proxmox", 5, VMP + "k8s-w1"),
            ("_result", 0, None, None, t, "running", "status", "proxmox", "c", "r", "host1",
             "n1", "running", "proxmox", 5, VMP + "k8s-w1")]
    schema = ("result string, table int, _start timestamp, _stop timestamp, _time timestamp, "
              "_value string, _field string, _measurement string, `inventory-cluster-id` string, "
              "`inventory-rack-id` string, `inventory-server-id` string, node_fqdn string, "
              "status string, plugin string, vm_id long, vm_name string")
    exports.write_exports(spark.createDataFrame(rows, schema), tmp_dir + "/raw", "proxmox")
    telemetry.ingest_exports(spark, tmp_dir + "/raw", "proxmox", tmp_dir + "/store")
    store = telemetry.read_telemetry(spark, tmp_dir + "/store")
    got = sorted((r["_field"], r["_value"], r["_value_text"]) for r in store.collect())
    assert got == [("cpuload", 2.5, None), ("status", None, "running")]
    spec = selection.TelemetrySpec("proxmox", START, STOP, vm_name_filter=DEFAULT_VM_NAME_FILTER)
    assert selection.select_telemetry(store, spec).count() == 2


def test_regex_join_literal_mode(spark):
    df = spark.createDataFrame([("http://nodeX1/m",), ("http://node.1/m",)], "url string")
    pats = spark.createDataFrame([("node.1",)], "p string")
    assert regex_match_join(df, pats, "url", "p").count() == 2            # '.' is a wildcard
    assert regex_match_join(df, pats, "url", "p", escape=True).count() == 1


def test_store_files_per_partition(spark, tmp_dir):
    import glob

    from wattspark.sources import telemetry

    t = datetime(2025, 8, 4, 6, 0)
    rows = [("k8s", t, "cpu", float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "plugin string, _time timestamp, _field string, _value double")
    telemetry.write_telemetry(df.repartition(16), tmp_dir + "/s", files_per_partition=3)
    files = glob.glob(tmp_dir + "/s/plugin=k8s/date=2025-08-04/*.parquet")
    assert 1 <= len(files) <= 3
    assert telemetry.read_telemetry(spark, tmp_dir + "/s").count() == 200


def test_per_export_semantics_through_files(spark, tmp_dir):
    from wattspark.plans import preprocess

    t = datetime(2025, 8, 4, 6, 0)
    cols = ("result string, table int, _start timestamp, _stop timestamp, _time timestamp, "
            "_value double, _field string, _measurement string, container_name string, "
            "`inventory-cluster-id` string, `inventory-rack-id` string, "
            "`inventory-server-id` string, namespace string, node_name string, plugin string, "
            "pod_name string, name string")
    row = ("_result", 0, None, None, t, 2.0, "cpu_usage_nanocores", "m", "c", "cl", "r", "s",
           "ns", "n", "k8s", "p")
    rows = [row + ("exportA",), row[:5] + (4.0,) + row[6:] + ("exportB",)]
    exports.write_exports(spark.createDataFrame(rows, cols), tmp_dir, "k8s", name_col="name",
                          run_id="r1")
    long = exports.read_exports(spark, tmp_dir, "k8s")
    assert sorted(r["_file"] for r in long.collect()) == ["k8s_exportA_r1", "k8s_exportB_r1"]
    wide = preprocess.prep_k8s(long)
    assert sorted(r.cpu_usage_nanocores for r in wide.collect()) == [2.0, 4.0]   # one row per export
    merged = preprocess.prep_k8s(long, per_file=False)
    assert [r.cpu_usage_nanocores for r in merged.collect()] == [3.0]


def test_stream_append_mode_emits_closed_windows(spark, tmp_dir):
    from wattspark.streaming import telemetry_stream as ts

    rows = [(datetime(2025, 8, 4, h, 10), "c", "ns", "n", "p", "cpu_usage_nanocores", float(h))
            for h in range(6)]
    schema = ("_time timestamp, container_name string, namespace string, node_name string, "
              "pod_name string, _field string, _value double")
    spark.createDataFrame(rows, schema).write.parquet(tmp_dir + "/in")
    stream = ts.read_long_stream(spark, tmp_dir + "/in", spark.read.parquet(tmp_dir + "/in").schema)
    out = ts.source_windowed_pivot(stream, "k8s", window="1 hour", watermark="1 hour")
    ts.run_to_table(out, tmp_dir + "/out", tmp_dir + "/ckpt")           # append mode
    got = sorted(r.cpu_usage_nanocores for r in spark.read.parquet(tmp_dir + "/out").collect())
    # windows whose end the watermark (max time - 1 h) has passed are final
    assert got == [0.0, 1.0, 2.0, 3.0]


def test_processed_table_csv_option(spark, tmp_dir):
    from wattspark.sources import sinks

    t = datetime(2025, 8, 4, 6, 0)
    df = spark.createDataFrame([(t, "c1", 1.5), (t, "c2", None)], "_time timestamp, k string, x double")
    sinks.write_table(df, tmp_dir + "/csv", fmt="csv", sort_within="_time")
    back = sinks.read_table(spark, tmp_dir + "/csv", fmt="csv").orderBy("k").collect()
    assert [(r.k, r.x) for r in back] == [("c1", "1.5"), ("c2", None)]   # text, header kept
    sinks.write_table(df, tmp_dir + "/pq")
    assert sinks.read_table(spark, tmp_dir + "/pq").schema == df.schema  # types preserved


def test_directory_runs(spark, tmp_dir):
    from conftest import SF001
    from wattspark.catalog import queries as Q
    from wattspark.plans import runs

    raw = tmp_dir + "/raw"
    for src in ("k8s", "kepler", "scaphandre_host", "scaphandre_vm"):
        exports.write_exports(Q.long(spark, SF001, src), raw, src)
    k8s = runs.process_exports(spark, raw, "k8s", tmp_dir + "/p/k8s")
    runs.process_exports(spark, raw, "kepler", tmp_dir + "/p/kepler")
    host, vm = runs.process_exports(spark, raw, "scaphandre", tmp_dir + "/p/scaph")
    assert k8s.count() == Q.wide(spark, SF001, "k8s").count()
    assert vm.count() == Q.wide(spark, SF001, "scaphandre_vm").count()
    ds = runs.build_dataset(spark, "energy", tmp_dir + "/p/k8s", tmp_dir + "/p/kepler",
                            tmp_dir + "/p/energy", interval="1D")
    direct = Q.energy(spark, SF001)
    assert ds.count() == direct.count()


def test_selection_spec_branches(spark):
    tel = _tel(spark)
    later = datetime(2025, 8, 4, 8, 0)
    # inventory id equality (not for scaphandre)
    spec = selection.TelemetrySpec("pdu", START, STOP, inventory_id="host1")
    assert [r["_value"] for r in selection.select_telemetry(tel, spec).collect()] == ["5"]
    # url regex only when a field is given
    with_field = selection.TelemetrySpec("scaphandre", START, later,
                                         field="scaph_host_power_microwatts", url_match="host10")
    assert [r["_value"] for r in selection.select_telemetry(tel, with_field).collect()] == ["7"]
    no_field = selection.TelemetrySpec("scaphandre", START, later, url_match="host10")
    assert selection.select_telemetry(tel, no_field).count() == 2
    # k8s without an id keeps the default cluster's servers only
    k8s = selection.TelemetrySpec("k8s", START, STOP)
    assert [r["inventory-server-id"] for r in selection.select_telemetry(tel, k8s).collect()] == [CL + "-a"]


def test_leading_blank_export_roundtrip(spark, tmp_dir):
    t = datetime(2025, 8, 4, 6, 0)
    rows = [("_result", 0, None, None, t, float(i), "scaph_host_power_microwatts", "m", "g", "c",
             "r", "scaphandre", f"http://h{i}") for i in range(3)]
    cols = ("result string, table int, _start timestamp, _stop timestamp, _time timestamp, "
            "_value double, _field string, _measurement string, granularity string, "
            "`inventory-cluster-id` string, `inventory-rack-id` string, plugin string, url string")
    exports.write_exports(spark.createDataFrame(rows, cols), tmp_dir, "scaphandre_host",
                          leading_blank=True)
    back = exports.read_exports(spark, tmp_dir, "scaphandre_host")
    assert sorted((r["url"], r["_value"]) for r in back.collect()) == [
        ("http://h0", 0.0), ("http://h1", 1.0), ("http://h2", 2.0)]


def test_exports_are_compressed_in_files_of_bounded_rows(spark, tmp_dir):
    """Long telemetry repeats its tags on each line: plain text was over ten times as large."""
    rows = spark.range(20_000).selectExpr(
        "cast(id % 7 as int) as `table`", "timestamp_seconds(1700000000 + id) as _time", "'power' as _field",
        "cast(id as double) as _value", "'energy_measurements' as _measurement",
        "'http://host.example:8080/metrics' as url", "concat('uuid-', id % 9) as uuid")
    exports.write_exports(rows, tmp_dir, "scaphandre_vm", max_records_per_file=1000)
    files = [os.path.join(d, f) for d, _, names in os.walk(tmp_dir) for f in names if f.startswith("part-")]
    assert sum(os.path.getsize(f) for f in files) < 20_000 * 100 / 5
    back = exports.read_exports(spark, tmp_dir, "scaphandre_vm", with_path=True)
    one = exports.read_exports(spark, tmp_dir, "scaphandre_vm", one_header=True)
    for got in (back, one):
        got = got.select("_time", "_value", "uuid")
        assert got.count() == 20_000 and not got.exceptAll(rows.select("_time", "_value", "uuid")).count()
    assert back.groupBy("_path").count().agg(F.max("count")).first()[0] <= 1000
