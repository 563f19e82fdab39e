"""No dependence on the driver, the cluster or a cap; plans that scale."""

import math
import os
import subprocess
import sys
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF001
from wattspark.operators import profile
from wattspark.operators.joins import regex_match_join
from wattspark.operators.learn import anomaly, dense, forest, metrics
from wattspark.plans import preprocess, selection
from wattspark.sources import exports, telemetry

COLUMNS = ["result", "table", "_start", "_stop", "_time", "_value", "_field", "_measurement",
           "inventory-rack-id", "inventory-server-id", "placement", "plugin", "url"]


def _line(names, **values):
    base = {"result": "_result", "table": "0", "_time": "2025-08-04T06:00:00Z", "_value": "5.0",
            "_field": "activePower", "_measurement": "pdu", "inventory-rack-id": "r1",
            "inventory-server-id": "srv1", "placement": "A", "plugin": "pdu", "url": "u1"} | values
    return ",".join(base.get(n, "") for n in names)


def _row(r):
    return (r["_value"], r["_field"], r["inventory-rack-id"], r["inventory-server-id"],
            r["placement"], r["plugin"], r["url"])


FULL = (5.0, "activePower", "r1", "srv1", "A", "pdu", "u1")


def _write(path, *lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


@pytest.mark.parametrize("names,want", [
    (COLUMNS[::-1], FULL),
    (["", *COLUMNS], FULL),
    (COLUMNS[:8] + ["agent"] + COLUMNS[8:], FULL),
    ([c for c in COLUMNS if c not in ("placement", "inventory-rack-id", "_start")],
     (5.0, "activePower", None, "srv1", None, "pdu", "u1"))])
def test_exports_are_read_by_header_name(spark, tmp_dir, names, want):
    _write(f"{tmp_dir}/pdu_a.csv", ",".join(names), _line(names, agent="agent1"))
    assert [_row(r) for r in exports.read_exports(spark, tmp_dir, "pdu").collect()] == [want]


def test_files_with_different_headers_and_changes_inside_a_file(spark, tmp_dir):
    back = COLUMNS[::-1]
    few = [c for c in COLUMNS if c != "placement"]
    _write(f"{tmp_dir}/pdu_a.csv", ",".join(COLUMNS), _line(COLUMNS))
    _write(f"{tmp_dir}/pdu_b.csv", ",".join(back), _line(back, url="u2"))
    _write(f"{tmp_dir}/pdu_c.csv", "", ",".join(COLUMNS), _line(COLUMNS, url='"u,3"'), "",
           ",".join(few), _line(few, url="u4"), _line(few, url="u5"), "", "", ",".join(COLUMNS),
           _line(COLUMNS, url="u6"))
    got = sorted(map(_row, exports.read_exports(spark, tmp_dir, "pdu").collect()),
                 key=lambda r: r[-1])
    place = {"u4": None, "u5": None}
    assert got == [(*FULL[:4], place.get(u, "A"), "pdu", u)
                   for u in ("u,3", "u1", "u2", "u4", "u5", "u6")]


def test_two_export_runs_stay_two_exports(spark, tmp_dir):
    from wattspark.catalog import queries as Q

    long = Q.long(spark, SF001, "k8s").where("`_value` is not null")
    exports.write_exports(long, tmp_dir, "k8s")
    one = preprocess.prep_k8s(exports.read_exports(spark, tmp_dir, "k8s")).count()
    exports.write_exports(long, tmp_dir, "k8s")
    both = exports.read_exports(spark, tmp_dir, "k8s")
    assert both.select("_file").distinct().count() == 2
    assert preprocess.prep_k8s(both).count() == 2 * one > 0


_RANGES = """
import sys
sys.path[:0] = [{root!r}, {tests!r}]
import tempfile
from wattspark.session import build_session
from wattspark.catalog import queries as Q
spark = build_session("local[2]", shuffle_partitions=2)
spark.sparkContext.setLogLevel("ERROR")
for name in ("filter_time_range", "telemetry_select", "run_plugin"):
    df = Q.queries()[name](spark, {sf!r})
    h = df.selectExpr("bit_xor(xxhash64(struct(*)))", "count(*)").first()
    print("ROW", name, *h, flush=True)
"""


def test_ranges_do_not_depend_on_the_driver_time_zone():
    script = _RANGES.format(root=ROOT, tests=os.path.join(ROOT, "tests"), sf=SF001)
    found = []
    for zone in ("UTC", "America/New_York"):
        out = subprocess.run([sys.executable, "-c", script], env=os.environ | {"TZ": zone},
                             capture_output=True, text=True, timeout=600)
        assert out.returncode == 0, out.stderr[-2000:]
        found.append([x for x in out.stdout.splitlines() if x.startswith("ROW")])
    assert len(found[0]) == 3 and found[0] == found[1]


def test_value_sets_have_no_cap(spark):
    df = spark.range(500).selectExpr("concat('v', id % 120) AS a", "'x' AS b", "id",
                                     "if(id % 2 = 0, 'y', NULL) AS c")
    out = profile.value_sets(df).collect()
    assert {(r.value, r.n_rows) for r in out if r.column == "a"} == {
        (f"v{i}", 5 if i < 20 else 4) for i in range(120)}
    assert [(r.column, r.value, r.n_rows) for r in out if r.column in "bc" and r.column != "a"] \
        and {(r.column, r.n_rows) for r in out if r.column != "a"} == {("b", 500), ("c", 250)}


def _linear(spark, n=2000):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(n, 4))
    y = x @ [3.0, -2.0, 0.5, 1.0] + rng.normal(scale=0.05, size=n)
    return spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y, strict=True)],
                                 "a double, b double, c double, d double, y double")


def test_training_does_not_depend_on_requested_partitions(spark):
    df = _linear(spark)
    r2 = []
    for parts in (1, 128):
        model, _ = dense.fit_dense(df, list("abcd"), ["y"], epochs=10, num_partitions=parts)
        scored = dense.predict_dense(df, model)
        r2.append(metrics.regression_metrics(scored, "y", "prediction").first().r2)
    assert r2[0] > 0.95 and abs(r2[0] - r2[1]) < 0.02
    assert dense.training_partitions(10**12, 32) == dense.MAX_PARTITIONS
    assert dense.training_partitions(32_000, 32) == 10


def test_equal_rows_spread_over_all_partitions(spark):
    df = spark.range(5000).selectExpr("1.0D AS x", "2.0D AS y").repartition(3)
    rows = dense._train_rows(df, ["x"], ["y"], 8, 1)
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_forest_depth_ten_costs_little_against_thirty(spark):
    df = _linear(spark, 1500).checkpoint()
    train, test = df.where("abs(hash(a)) % 4 > 0"), df.where("abs(hash(a)) % 4 = 0")
    r2 = {}
    for depth in (10, 30):
        model = forest.fit_random_forest(train, list("abcd"), "y", num_trees=20, max_depth=depth)
        r2[depth] = metrics.regression_metrics(forest.predict(model, test), "y",
                                               "prediction").first().r2
    assert r2[10] > 0.8 and abs(r2[10] - r2[30]) < 0.05


@pytest.mark.parametrize("same_time", [False, True])
def test_holdout_has_exactly_the_last_rows(spark, same_time):
    t0 = datetime(2025, 1, 1)
    rows = [(t0 if same_time else t0 + timedelta(minutes=i // 7), i) for i in range(1003)]
    df = spark.createDataFrame(rows, "_time timestamp, i long").repartition(6)
    first, last = anomaly.holdout_last(df, 0.1)
    late = last.collect()
    assert len(late) == math.ceil(0.1 * 1003) and first.count() == 1003 - len(late)
    assert min(r["_time"] for r in late) >= max(r["_time"] for r in first.collect())


@pytest.fixture()
def no_static_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_selection_joins_do_not_exchange_raw_rows(spark, no_static_broadcast):
    from wattspark.catalog import queries as Q

    tel = Q.tel(spark, SF001)
    ids = Q.inventory(spark, SF001)
    plans = [selection.semi_join_inventory(tel.where("plugin = 'pdu'"), ids),
             regex_match_join(tel.where("plugin = 'scaphandre'"), ids.withColumnRenamed(
                 "inventory-server-id", "id"), "url", "id"),
             selection.run_plugin(tel, "pdu", Q.START, Q.STOP)]
    for df in plans:
        text = _plan(df)
        assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_inventory_lookup_prunes_days(spark, tmp_dir):
    from wattspark.catalog import queries as Q

    telemetry.write_telemetry(Q.tel(spark, SF001), tmp_dir + "/s")
    store = telemetry.read_telemetry(spark, tmp_dir + "/s")
    for df in (selection.inventory_ids(store, Q.START, Q.STOP),
               selection.host_vm_pairs(store, Q.START, Q.STOP)):
        filters = _plan(df).split("PartitionFilters: [")[1].split("]")[0]
        assert "date" in filters and "plugin" in filters


def test_text_is_parsed_once_and_scaphandre_scanned_once(spark):
    from wattspark.catalog import queries as Q

    text = _plan(preprocess.prep_proxmox(Q.long(spark, SF001, "proxmox")))
    initial = text.split("== Initial Plan ==")[-1]
    assert initial.lower().count("try_cast") + initial.count("cast(trim") <= 2 * len(
        Q.SOURCES["proxmox"].fields) and "isnotnull(nanvl" not in initial
    started = spark.sparkContext.statusTracker()
    assert started is not None
    df = preprocess.prep_scaphandre_vm(Q.long(spark, SF001, "scaphandre_vm"))
    assert "parquet" not in _plan(df).lower()  # reads the written pivot, not the input again


def test_scaphandre_drops_a_metric_without_values(spark):
    from wattspark.catalog import queries as Q

    long = Q.long(spark, SF001, "scaphandre_vm")
    gone = "scaph_process_memory_bytes"
    less = long.withColumn("_value", F.when(F.col("_field") != gone, F.col("_value")))
    out = preprocess.prep_scaphandre_vm(less)
    assert gone not in out.columns and out.count() > 0


def test_checkpoint_folder_must_be_named_on_a_cluster():
    from wattspark import session

    class Context:
        master = "spark://head:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_a_retried_micro_batch_is_not_appended_twice(spark, tmp_dir):
    from wattspark.streaming import telemetry_stream as ts

    spark.range(10).selectExpr("id", "timestamp_seconds(id) AS _time").write.parquet(tmp_dir + "/in")
    stream = ts.read_long_stream(spark, tmp_dir + "/in", spark.read.parquet(tmp_dir + "/in").schema)
    for k in range(2):  # a fresh query log replays batch 0 into the same table
        ts.run_to_table(stream, tmp_dir + "/out", f"{tmp_dir}/ckpt{k}")
    out = spark.read.parquet(tmp_dir + "/out")
    assert out.count() == 10 and "batch_id" in out.columns


def test_a_dealt_stand_in_spreads_few_events_per_task(spark, tmp_dir, monkeypatch):
    """A task that writes the store sorts the long rows of its events, up to 15 of each."""
    from wattspark.sources import standins

    spark.range(3000).selectExpr(
        "id as event_id", "cast(timestamp_seconds(1704067200 + id * 700) as timestamp_ntz) as ts",
        "id % 50 as user_id", "'view' as event_type", "id / 3.0 as value", "'{}' as props",
    ).coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    monkeypatch.setattr(standins, "EVENTS_PER_TASK", 300)
    plain, dealt = (standins.telemetry_table(spark, tmp_dir, ["kepler"], dealt=d) for d in (False, True))
    per_task = dealt.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task < 2 * 3000 / 4
    assert plain.count() == dealt.count() and not plain.exceptAll(dealt).count()


def test_increments_deal_the_events_over_bounded_tasks(spark, tmp_dir, monkeypatch):
    from wattspark.catalog import upkeep
    from wattspark.sources import standins

    seen = []
    monkeypatch.setattr(standins, "EVENTS_PER_TASK", 50)
    monkeypatch.setattr(upkeep.incremental, "apply_increment", lambda s, state, name, rows, i: seen.append(rows))
    monkeypatch.setattr(upkeep.incremental, "read_dataset", lambda s, state, name: next(iter(seen[0].values())))
    spark.range(1000).selectExpr(
        "id as event_id", "cast(timestamp_seconds(1704067200 + id * 60) as timestamp_ntz) as ts",
        "id % 9 as user_id", "'view' as event_type", "id / 2.0 as value").coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    upkeep._increments(spark, tmp_dir, ("scaphandre_vm",), "vm_power")
    per_task = (seen[0]["scaphandre_vm"].groupBy(F.spark_partition_id().alias("p"))
                .agg(F.count_distinct("_time").alias("n")).agg(F.max("n")).first()[0])
    assert per_task < 150


def test_an_epoch_runs_many_partitions_in_few_tasks_with_the_same_steps(spark, monkeypatch):
    monkeypatch.setattr(dense, "MIN_BATCHES", 1)
    df = _linear(spark).repartition(3).checkpoint()
    cols, sizes, acts = list("abcd"), [4, 3, 4], ["relu", "linear"]
    sc = spark.sparkContext
    sc.setJobGroup("epochs", "")
    model, _ = dense.fit_dense(df, cols, cols, (3,), epochs=1, batch_size=8, seed=5)
    sc.setJobGroup("other", "")
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(k) for k in
              tracker.getJobInfo(max(tracker.getJobIdsForGroup("epochs"))).stageIds]
    count = df.count() // 8
    tasks = max(2 * sc.defaultParallelism, -(-count // dense.PARTITIONS_PER_TASK))
    assert tasks < count and all(s is None or s.numTasks <= tasks for s in stages)

    parts = {}
    for r in dense._train_rows(df, cols, cols, count, 5).withColumn(
            "p", F.spark_partition_id()).collect():
        parts.setdefault(r.p, []).append(r.x)
    p = dense.param_count(sizes)
    start = np.concatenate([dense.init_params(sizes, 5), np.zeros(2 * p), [0.0]])
    total = 0.0
    for k, x in parts.items():
        x = np.array(x)
        end, _ = dense.adam_epoch(start, sizes, acts, x, x, 1e-3, 8, np.random.default_rng([5, 1, k]))
        total = total + end * len(x)
    assert len(parts) == count
    assert np.allclose(model.params, total[:p] / sum(map(len, parts.values())), rtol=1e-12, atol=0)
