"""Exactly-once ingest, segmented header scan, salted concatenated exports, increments."""

import csv
import datetime as dt
import io
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from wattspark.plans import datasets, incremental, preprocess
from wattspark.schemas import SOURCES, raw_schema
from wattspark.sources import exports, ledger

NAMES = [f.name for f in raw_schema(SOURCES["kepler"]).fields]


def kepler_line(order, k):
    row = {"result": "_result", "table": str(k % 5), "_start": "", "_stop": "",
           "_time": f"2025-08-0{1 + k % 7}T00:{k % 60:02d}:00Z", "_value": str(k), "plugin": "kepler",
           "_field": "kepler_container_joules_total", "container_id": f"c{k % 3}", "container_name": "a,b",
           "namespace": "n", "pod_name": f"p{k % 4}", "url": "u"}
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow([row.get(n, "") for n in order])
    return out.getvalue()


def write_file(path, ks, order=NAMES):
    with open(path, "w") as f:
        f.write("\n".join([",".join(order), *(kepler_line(order, k) for k in ks)]) + "\n")


def values(df):
    return sorted(r[0] for r in df.select("_value").collect())


def test_repeated_changed_and_failed_ingests_leave_the_right_rows(spark, tmp_dir, monkeypatch):
    folder, store = f"{tmp_dir}/in", f"{tmp_dir}/store"
    os.makedirs(folder)
    write_file(f"{folder}/kepler_a.csv", range(10))
    write_file(f"{folder}/kepler_b.csv", range(10, 20))
    assert ledger.ingest_once(spark, store, "kepler", folder).count() == 2
    assert ledger.ingest_once(spark, store, "kepler", folder).count() == 0
    assert values(ledger.read_ingested(spark, store)) == list(range(20))

    shutil.copy(f"{folder}/kepler_b.csv", f"{folder}/kepler_copy.csv")       # known content, new name
    write_file(f"{folder}/kepler_c.csv", range(20, 25))
    shutil.copy(f"{folder}/kepler_c.csv", f"{folder}/kepler_d.csv")          # two equal new files
    open(f"{folder}/kepler_empty.csv", "w").close()
    done = {r["path"].rsplit("_", 1)[1]: r["held"] for r in ledger.ingest_once(spark, store, "kepler", folder).collect()}
    assert done == {"copy.csv": False, "c.csv": True, "d.csv": False}
    assert values(ledger.read_ingested(spark, store)) == list(range(25))

    write_file(f"{folder}/kepler_a.csv", range(100, 103))                    # replaced by other content
    calls = {"n": 0}
    write = ledger.write_telemetry

    def failing(*a, **k):                      # data staged, then the job dies before the commit
        write(*a, **k)
        calls["n"] += 1
        raise RuntimeError("lost")

    monkeypatch.setattr(ledger, "write_telemetry", failing)
    with pytest.raises(RuntimeError):
        ledger.ingest_once(spark, store, "kepler", folder)
    assert values(ledger.read_ingested(spark, store)) == list(range(25)) and calls["n"] == 1
    monkeypatch.setattr(ledger, "write_telemetry", write)
    ledger.ingest_once(spark, store, "kepler", folder)
    got = ledger.read_ingested(spark, store)
    assert values(got) == [*range(10, 25), 100, 101, 102]
    assert "date" in got.columns and got.filter("plugin = 'kepler'").count() == 18


def test_a_repeated_run_replaces_its_own_exports(spark, tmp_dir):
    write_file(f"{tmp_dir}/kepler_x.csv", range(50))
    rows = exports.read_exports(spark, tmp_dir, "kepler")
    for layout in ({}, {"header_per": "table"}):
        out = f"{tmp_dir}/out{len(layout)}"
        exports.write_exports(rows, out, "kepler", run_id="one", **layout)
        exports.write_exports(rows, out, "kepler", run_id="one", **layout)
        assert values(exports.read_exports(spark, out, "kepler")) == list(range(50))
        exports.write_exports(rows, out, "kepler", run_id="two", **layout)
        assert values(exports.read_exports(spark, out, "kepler")) == sorted([*range(50)] * 2)


def test_a_large_result_is_spread_over_parts_with_a_header_each(spark, tmp_dir):
    write_file(f"{tmp_dir}/kepler_x.csv", range(400))
    rows = exports.read_exports(spark, tmp_dir, "kepler").withColumn("table", F.lit(3))
    exports.write_exports(rows, f"{tmp_dir}/out", "kepler", run_id="r", header_per="table", rows_per_part=60)
    lines = spark.read.text(f"{tmp_dir}/out/export=kepler_export_r")
    assert lines.filter(F.col("value").startswith("result,")).count() == 7     # ceil(400 / 60) parts
    assert values(exports.read_exports(spark, f"{tmp_dir}/out", "kepler")) == list(range(400))


def test_headers_are_carried_across_the_splits_of_one_file(spark, tmp_dir):
    rng = random.Random(1)
    path, lines, want = f"{tmp_dir}/kepler_big.csv", [], []
    order = NAMES
    lines.append(",".join(order))
    for k in range(900):
        if rng.random() < 0.01:
            order = rng.sample(NAMES, len(NAMES))
            lines += ["", ",".join(order)]
        lines.append(kepler_line(order, k))
        want.append((float(k), f"p{k % 4}", "a,b"))
    with open(path, "w") as f:
        f.write("\n".join(lines))
    write_file(f"{tmp_dir}/kepler_other.csv", [5000])
    conf = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        text = exports.lines_under_headers(spark, [path])
        assert spark.read.text(path).rdd.getNumPartitions() > 10
        plan = text._jdf.queryExecution().optimizedPlan().toString()
        windows = [x for x in plan.splitlines() if "Window [" in x]
        assert windows and all("split#" in x for x in windows)       # never a whole file in one group
        rows = exports.read_exports(spark, tmp_dir, "kepler")
        got = sorted((r[0], r[1], r[2]) for r in rows.select("_value", "pod_name", "container_name").collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == sorted([*want, (5000.0, "p0", "a,b")])


def long_rows(spark, source, n, seed):
    rng = random.Random(seed)
    src, rows = SOURCES[source], []
    for _ in range(n):
        t = dt.datetime(2025, 8, rng.randint(1, 9), rng.randint(0, 2), rng.choice([0, 0, 1]), 0)
        value = float(rng.randint(0, 50))
        rows.append((t, rng.choice(src.fields[:6]), str(value) if src.value_is_text else value,
                     f"k8s-{rng.randint(0, 2)}", rng.randint(0, 2)))
    schema = "_time timestamp, _field string, _value %s, tag string, num long" % (
        "string" if src.value_is_text else "double")
    df = spark.createDataFrame(rows, schema)
    for c in dict.fromkeys([*src.index[1:], *src.require_not_null]):
        df = df.withColumn(c, F.col("num") if c == "vm_id" else F.col("tag"))
    return df.drop("tag", "num")


def as_rows(df):
    return sorted(str(tuple(r)) for r in df.select(*sorted(f"`{c}`" for c in df.columns)).collect())


def test_three_increments_equal_one_run_and_touch_only_their_days(spark, tmp_dir, monkeypatch):
    state = f"{tmp_dir}/state"
    fields = SOURCES["k8s"].fields
    needed = ["cpu_usage_nanocores", "memory_usage_bytes", "logsfs_used_bytes", "logsfs_capacity_bytes"]
    k8s = long_rows(spark, "k8s", 900, 1).withColumn("_field", F.element_at(
        F.array(*map(F.lit, needed)), 1 + F.pmod(F.xxhash64("_field", "_value"), F.lit(4)).cast("int")))
    kepler = long_rows(spark, "kepler", 300, 2)
    k8s, kepler = k8s.checkpoint(), kepler.checkpoint()
    assert set(needed) <= set(fields)
    day = F.dayofmonth("_time")
    late = (F.col("_value") % 5 == 0) & (day == 2)
    parts = [(day <= 4) & ~late, day.between(5, 6), (day > 6) | late]
    read, real = [], incremental.current_paths

    def spying(*a, **k):
        read.append(real(*a, **k))
        return read[-1]

    for k, keep in enumerate(parts):
        if k == 2:
            monkeypatch.setattr(incremental, "current_paths", spying)
        got = incremental.apply_increment(spark, state, f"i{k}", {"k8s": k8s.where(keep), "kepler": kepler.where(keep)})
        assert got["k8s"]
    assert {p.rsplit("=", 1)[1] for paths in read for p in paths} == {"2025-08-02"}   # the late day alone
    assert not any("2025-08-03" in d for d in got["energy"])
    assert incremental.apply_increment(spark, state, "i2", {"k8s": k8s}) == {}        # committed: skipped
    for source, df, prep in (("k8s", k8s, preprocess.prep_k8s), ("kepler", kepler, preprocess.prep_kepler)):
        assert as_rows(incremental.read_processed(spark, state, source)) == as_rows(prep(df))
    want = datasets.energy_dataset(preprocess.prep_k8s(k8s), preprocess.prep_kepler(kepler))
    assert want.count() > 10
    assert as_rows(incremental.read_dataset(spark, state, "energy")) == as_rows(want)
    with pytest.raises(ValueError):
        incremental.apply_increment(spark, state, "x", {}, "7h")


def test_a_half_written_increment_is_not_seen_and_is_written_again(spark, tmp_dir, monkeypatch):
    state = f"{tmp_dir}/state"
    prox = long_rows(spark, "proxmox", 400, 3).checkpoint()
    incremental.apply_increment(spark, state, "a", {"proxmox": prox.where("day(_time) < 5")})
    before = as_rows(incremental.read_processed(spark, state, "proxmox"))
    real = spark.createDataFrame

    def dying(data, schema=None, *a, **k):
        if schema == incremental.MANIFEST:
            raise RuntimeError("lost")
        return real(data, schema, *a, **k)

    monkeypatch.setattr(spark, "createDataFrame", dying)
    with pytest.raises(RuntimeError):
        incremental.apply_increment(spark, state, "b", {"proxmox": prox.where("day(_time) >= 3")})
    monkeypatch.setattr(spark, "createDataFrame", real)
    assert as_rows(incremental.read_processed(spark, state, "proxmox")) == before
    incremental.apply_increment(spark, state, "b", {"proxmox": prox.where("day(_time) >= 5")})
    assert as_rows(incremental.read_processed(spark, state, "proxmox")) == as_rows(preprocess.prep_proxmox(prox))
    only = incremental.read_processed(spark, state, "proxmox", {"2025-08-07"})
    assert {r[0] for r in only.select(F.dayofmonth("_time")).distinct().collect()} == {7}


def test_files_of_one_header_are_read_without_a_header_pass(spark, tmp_dir, monkeypatch):
    back = NAMES[::-1]
    write_file(f"{tmp_dir}/kepler_a.csv", range(10), back)
    with open(f"{tmp_dir}/kepler_b.csv", "w") as f:                          # repeated header, blank lines
        f.write("\n".join(["", ",".join(back), kepler_line(back, 10), "", ",".join(back),
                           kepler_line(back, 11), "", ""]))
    usual = exports.read_exports(spark, tmp_dir, "kepler")
    monkeypatch.setattr(exports, "_by_header", None)                         # the pass over the headers
    once = exports.read_exports(spark, tmp_dir, "kepler", one_header=True)
    assert once.schema == usual.schema
    assert sorted(map(str, once.collect())) == sorted(map(str, usual.collect()))
    assert once.count() == 12 and values(once) == list(range(12))
    assert {r["container_name"] for r in once.select("container_name").collect()} == {"a,b"}


@pytest.mark.parametrize("lines", [
    lambda: [",".join(NAMES[1:]), kepler_line(NAMES[1:], 1)],                # another first line
    lambda: [",".join(NAMES), kepler_line(NAMES, 1), ",".join(NAMES[1:]), kepler_line(NAMES[1:], 2)]])
def test_a_line_that_contradicts_the_one_header_fails_the_scan(spark, tmp_dir, lines):
    write_file(f"{tmp_dir}/kepler_a.csv", range(2000))
    with open(f"{tmp_dir}/kepler_b.csv", "w") as f:
        f.write("\n".join(lines()) + "\n")
    rows = exports.read_exports(spark, tmp_dir, "kepler", one_header=True)
    for job in (rows.count, rows.select("_value").collect):
        with pytest.raises(Exception, match="another header"):
            job()
    assert exports.read_exports(spark, tmp_dir, "kepler").count() == 2000 + len(lines()) // 2


def test_one_header_without_any_header_or_file(spark, tmp_dir):
    assert exports.read_exports(spark, tmp_dir, "kepler", one_header=True).count() == 0
    with open(f"{tmp_dir}/kepler_a.csv", "w") as f:
        f.write("1,2,3\n")
    assert exports.read_exports(spark, tmp_dir, "kepler", one_header=True).count() == 0
    with pytest.raises(ValueError):
        exports.read_exports(spark, tmp_dir, "kepler", one_header=True, headers={})


def test_an_ingest_reads_its_files_twice_not_three_times(spark, tmp_dir, monkeypatch):
    """The pass that digests the lines finds the headers too, changed ones inside a file included."""
    folder, store = f"{tmp_dir}/in", f"{tmp_dir}/store"
    os.makedirs(folder)
    write_file(f"{folder}/kepler_a.csv", range(5), NAMES[::-1])
    few = [n for n in NAMES if n != "namespace"]
    with open(f"{folder}/kepler_b.csv", "w") as f:
        f.write("\n".join([",".join(NAMES), kepler_line(NAMES, 5), ",".join(few), kepler_line(few, 6)]) + "\n")
    given = []
    read = exports.read_exports
    monkeypatch.setattr(exports, "read_exports",
                        lambda *a, **k: given.append(k["headers"]) or read(*a, **k))
    ledger.ingest_once(spark, store, "kepler", folder)
    assert sorted(len(h) for h in given[0].values()) == [1, 2]
    got = ledger.read_ingested(spark, store)
    assert values(got) == list(range(7))
    assert got.filter("namespace is null").count() == 1


def test_lines_are_not_exchanged_to_find_their_header(spark, tmp_dir):
    """Windows over whole splits sorted all text; now it streams, parsed in one pass for all headers."""
    with open(f"{tmp_dir}/kepler_a.csv", "w") as f:
        for order in (NAMES, NAMES[::-1]):
            f.write("\n".join([",".join(order), *[kepler_line(order, k) for k in range(20)], ""]) + "\n")
    df = exports.read_exports(spark, tmp_dir, "kepler")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Union" not in plan
    assert sorted(r[0] for r in df.select("_value").collect()) == sorted(2 * [float(k) for k in range(20)])
