import math
from datetime import datetime

from wattspark.plans import datasets, preprocess
from wattspark.schemas import K8S_FIELDS, KEPLER_FIELDS, PROXMOX_FIELDS, SCAPH_VM_FIELDS


def _wide(spark, index, fields, rows, types):
    cols = ", ".join(f"`{c}` {types.get(c, 'double')}" for c in index + fields)
    return spark.createDataFrame(rows, cols)


def test_energy_dataset_fan_out_zero_sum_and_guarded_percent(spark):
    k_idx = ["_time", "container_name", "namespace", "node_name", "pod_name"]
    kt = {"_time": "timestamp", "container_name": "string", "namespace": "string",
          "node_name": "string", "pod_name": "string"}
    base = {f: None for f in K8S_FIELDS}

    def k8s_row(t, node, cpu, cap):
        vals = dict(base, cpu_usage_nanocores=cpu, memory_usage_bytes=1048576.0,
                    logsfs_used_bytes=50.0, logsfs_capacity_bytes=cap)
        return (t, "c1", "ns", node, "p1", *[vals[f] for f in K8S_FIELDS])

    k8s = _wide(spark, k_idx, K8S_FIELDS, [
        k8s_row(datetime(2025, 8, 4, 6, 0, 10), "n1", 2e6, 100.0),
        k8s_row(datetime(2025, 8, 4, 6, 0, 40), "n2", 4e6, 0.0),     # second scrape, other node
    ], kt)
    kep_idx = ["_time", "container_id", "container_name", "namespace", "pod_name"]
    kep_t = {"_time": "timestamp", "container_id": "string", "container_name": "string",
             "namespace": "string", "pod_name": "string"}
    kep = _wide(spark, kep_idx, KEPLER_FIELDS, [
        (datetime(2025, 8, 4, 6, 0, 5), "id1", "c1", "ns", "p1", 60.0, 1.0),
        (datetime(2025, 8, 4, 6, 0, 35), "id2", "c1", "ns", "p1", 120.0, 1.0),
    ], kep_t)
    out = datasets.energy_dataset(k8s, kep, "1min").orderBy("cpu_millicores").collect()
    assert len(out) == 2
    assert [r.container_power_watts for r in out] == [3.0, 3.0]          # (60+120)/60 each
    assert [r.cpu_millicores for r in out] == [2.0, 4.0]
    assert [r.logsfs_usage_percent for r in out] == [50.0, 0.0]
    assert out[0].memory_usage_mb == 1.0

    # an energy group whose joules are all missing sums to 0.0 and still joins
    kep2 = _wide(spark, kep_idx, KEPLER_FIELDS,
                 [(datetime(2025, 8, 4, 6, 0, 5), "id1", "c1", "ns", "p1", None, 1.0)], kep_t)
    out2 = datasets.energy_dataset(k8s, kep2, "1min").collect()
    assert sorted(r.container_power_watts for r in out2) == [0.0, 0.0]


def test_vm_power_dataset_filters_names_and_keeps_infinity(spark):
    p_idx = ["_time", "inventory-server-id", "vm_id", "vm_name"]
    pt = {"_time": "timestamp", "inventory-server-id": "string", "vm_id": "bigint", "vm_name": "string"}
    numeric = [f for f in PROXMOX_FIELDS]

    def prow(vm_id, name, disk_free, disk_total):
        vals = {f: 1.0 for f in numeric}
        vals.update(disk_free=disk_free, disk_total=disk_total, status=None, uptime=7200.0)
        return (datetime(2025, 8, 4, 6, 0, 3), "srv", vm_id, name, *[vals[f] for f in numeric])

    prox = _wide(spark, p_idx, numeric, [prow(1, "vm-k8s-w1", 5.0, 0.0),
                                         prow(2, "vm-K8S-w2", 5.0, 10.0),
                                         prow(3, None, 5.0, 10.0)], pt)
    prox = preprocess.add_disk_columns(prox)
    s_idx = ["_time", "url", "uuid", "vm_id", "vm_name"]
    st = {"_time": "timestamp", "url": "string", "uuid": "string", "vm_id": "bigint", "vm_name": "string"}
    srows = []
    for sec in (1, 31):
        vals = {f: 2.0 for f in SCAPH_VM_FIELDS}
        vals["scaph_process_power_consumption_microwatts"] = 1e6
        vals["scaph_process_disk_read_bytes"] = None
        srows.append((datetime(2025, 8, 4, 6, 0, sec), "u", "x", 1, "vm-k8s-w1",
                      *[vals[f] for f in SCAPH_VM_FIELDS]))
    scaph = _wide(spark, s_idx, SCAPH_VM_FIELDS, srows, st)
    out = datasets.vm_power_dataset(prox, scaph, "1min").collect()
    assert len(out) == 1
    r = out[0]
    assert r.vm_id == 1
    assert r.disk_usage_percent == -math.inf                   # kept by the final dropna
    assert r.vm_power_watts == 2.0                             # two scrapes summed
    assert r.scaph_process_disk_read_bytes == 0.0              # all-missing sum
    assert r.scaph_process_cpu_usage_percentage == 2.0         # mean
    assert r.uptime_hours == 2.0


def test_pdu_metadata_join_multiplies_rows(spark):
    t = datetime(2025, 8, 4, 6, 0)
    long = spark.createDataFrame([
        (t, "srv1", "A", "http://a", "activePower", 10.0),
        (t, "srv1", "A", "http://b", "activePower", 20.0),
    ], "_time timestamp, `inventory-server-id` string, placement string, url string, _field string, _value double")
    out = preprocess.prep_pdu(long, meta="faithful")
    assert "url_x" in out.columns and "url_y" in out.columns
    assert out.count() == 4          # two wide rows x two urls of the server
    assert preprocess.prep_pdu(long, meta="none").count() == 2


def test_scaphandre_absent_metric_is_no_column(spark):
    t = datetime(2025, 8, 4, 6, 0)
    long = spark.createDataFrame([
        (t, "u", "x", 1, "vm-k8s", "scaph_process_cpu_usage_percentage", 5.0),
        (t, "u", "x", 1, "vm-k8s", "scaph_process_memory_bytes", 7.0),
    ], "_time timestamp, url string, uuid string, vm_id bigint, vm_name string, "
       "_field string, _value double")
    out = preprocess.prep_scaphandre_vm(long)
    assert out.count() == 1
    assert "scaph_process_disk_read_bytes" not in out.columns
    # with the full declared schema the absent metrics are all-missing and
    # the row-wise drop removes the row
    assert preprocess.prep_scaphandre_vm(long, present_only=False).count() == 0


def test_field_modes_match_a_dynamic_pivot(spark):
    t = datetime(2025, 8, 4, 6, 0)
    long = spark.createDataFrame([
        (t, "c", "ns", "n", "p", "cpu_usage_nanocores", 5.0),
        (t, "c", "ns", "n", "p", "gpu_watts", 7.0),            # not a declared metric
        (t, "c", "ns", "n", "p", "memory_usage_bytes", None),   # declared, never a value
    ], "_time timestamp, container_name string, namespace string, node_name string, "
       "pod_name string, _field string, _value double")
    idx = ["_time", "container_name", "namespace", "node_name", "pod_name"]
    assert len(preprocess.prep_k8s(long).columns) == len(idx) + len(K8S_FIELDS)
    assert preprocess.prep_k8s(long, fields="present").columns == idx + ["cpu_usage_nanocores"]
    assert preprocess.prep_k8s(long, fields="discover").columns == idx + ["cpu_usage_nanocores",
                                                                          "gpu_watts"]
