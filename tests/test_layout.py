"""Regex index, bucketed and clustered tables, sketches, resumed runs."""

import datetime as dt
import random
import re
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wattspark.operators import regex_index, sketches
from wattspark.operators.joins import regex_match_join
from wattspark.plans import resume, stored
from wattspark.sources import sinks


@pytest.mark.parametrize("pattern, literal", [
    ("flux-node1", "flux-node1"), ("^flux-node1$", "flux-node1"), (r"node\.7:9", "node.7:9"),
    ("ab+cde", "cde"), ("abcx?de", "abc"), ("abcx*", "abc"), ("a.bcd", "bcd"), ("[abc]defg", "defg"),
    ("x(abcd)?yzw", "yzw"), ("abc|defg", ""), ("(?i)abcd", ""), (r"\d+abc\w", "abc"), (r"a[\]x]bcd", "bcd"),
    ("abc{2}def", "def"), ("", ""), (".*", ""), (r"\Qabc\E", ""), (r"abc\tdef1", "def1")])
def test_literals_are_sure(pattern, literal):
    assert regex_index.required_literal(pattern) == literal


def test_literals_are_in_every_match():
    rng = random.Random(4)
    atoms = ["a", "b", "-", r"\.", ".", "[ab]", "(ab)", "(a|b)", "a?", "b*", "a+", "b{2}", "^", "$", r"\d", "x1"]
    texts = ["".join(rng.choice("ab-.x1") for _ in range(rng.randint(0, 12))) for _ in range(400)]
    hits = 0
    for _ in range(400):
        p = "".join(rng.choice(atoms) for _ in range(rng.randint(1, 6)))
        literal = regex_index.required_literal(p)
        for t in texts:
            if re.search(p, t):
                hits += 1
                assert literal in t, (p, literal, t)
    assert hits > 1000


def test_indexed_join_equals_the_nested_loop(spark):
    rng = random.Random(2)
    texts = [f"http://node{rng.randint(0, 60)}.rack{rng.randint(0, 5)}:91{rng.randint(0, 9)}" for _ in range(300)]
    patterns = [*(f"node{i}" for i in range(0, 60, 3)), "node1", r"rack2:9", "k[0-3]:", ".*:919", "", "x", "nomatch-at-all",
                "node5.rack", "^http://node4", "node(1|2)\\.", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, "", "ab"])], "id long, url string")
    pats = spark.createDataFrame([(p,) for p in patterns], "p string")
    for escape in (False, True):
        for how in ("inner", "left_semi"):
            a, b = (regex_match_join(rows, pats, "url", "p", how=how, escape=escape, max_pairs=m)
                    for m in (10 ** 9, 0))
            assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.count()
    texts = rows.select(F.col("url").alias("__text")).filter("__text is not null").distinct()
    sure = regex_index.with_literals(pats.filter("p like 'node%'").select(F.col("p").alias("__pattern")), True)
    plan = regex_index.indexed_pairs(texts, sure, False)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def wide_tables(spark):
    rng = random.Random(9)
    t0 = dt.datetime(2025, 8, 1)
    k8s = [(t0 + dt.timedelta(minutes=rng.randint(0, 600)), f"c{rng.randint(0, 9)}", "n", f"p{rng.randint(0, 3)}", "w",
            *(float(rng.randint(1, 99)) for _ in range(4))) for _ in range(900)]
    kep = [(t0 + dt.timedelta(minutes=rng.randint(0, 600)), f"id{k}", f"c{rng.randint(0, 9)}", "n", f"p{rng.randint(0, 3)}",
            float(rng.randint(1, 99)), 1.0) for k in range(700)]
    a = spark.createDataFrame(k8s, "_time timestamp, container_name string, namespace string, pod_name string, node_name string, "
                                   "cpu_usage_nanocores double, memory_usage_bytes double, logsfs_used_bytes double, "
                                   "logsfs_capacity_bytes double")
    b = spark.createDataFrame(kep, "_time timestamp, container_id string, container_name string, namespace string, "
                                   "pod_name string, kepler_container_joules_total double, "
                                   "kepler_container_microwatts_consumption_total double")
    return a, b


def test_bucketed_tables_join_without_an_exchange(spark, tmp_dir):
    from wattspark.plans import datasets

    a, b = wide_tables(spark)
    name = f"t{uuid.uuid4().hex[:8]}"
    stored.store_tables("energy", a, b, tmp_dir, name, 8)
    old = {k: spark.conf.get(k, None) for k in stored._CONF}
    out = stored.stored_dataset(spark, "energy", name, f"{tmp_dir}/out", "1h")
    want = datasets.energy_dataset(a, b, "1h")
    assert sorted(map(str, out.collect())) == sorted(map(str, want.select(*out.columns).collect())) and out.count() > 500
    assert {k: spark.conf.get(k, None) for k in stored._CONF} == old
    try:
        for k, v in stored._CONF.items():
            spark.conf.set(k, v)
        df = datasets.energy_dataset(spark.table(f"{name}_left"), spark.table(f"{name}_right"), "1h")
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_clustered_files_hold_disjoint_keys_and_prune_reads(spark, tmp_dir):
    t0 = dt.datetime(2025, 8, 1)
    df = spark.range(48_000).select(
        (F.lit(t0) + F.expr("make_interval(0, 0, 0, 0, 0, 0, cast(id / 50 as int) * 90)")).alias("_time"),
        F.format_string("pod-%02d", F.col("id") % 50).alias("pod"), F.rand(1).alias("v"))
    df = df.unionByName(df.limit(1).withColumn("pod", F.lit(None).cast("string"))).checkpoint()
    path = f"{tmp_dir}/clustered"
    sinks.write_clustered(df, path, ["pod"], files=32)
    back = spark.read.parquet(path)
    assert back.count() == df.count() and back.exceptAll(df).isEmpty()
    hour, groups, hit = t0 + dt.timedelta(hours=5), 0, 0
    for f in __import__("glob").glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            stats = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics
                     for c in range(meta.num_columns)}
            t, p = stats["_time"], stats["pod"]
            low, high = (x.replace(tzinfo=None) for x in (t.min, t.max))
            groups += 1
            hit += p.has_min_max and p.min <= "pod-07" <= p.max and low < hour + dt.timedelta(hours=1) and high >= hour
    assert groups >= 30 and 1 <= hit <= 3
    one = [r[0] for r in spark.range(1).select(sinks.interleaved(F.lit(5), F.lit(3), 3)).collect()]
    assert one == [0b100111]


def test_sketches_of_a_range(spark, tmp_dir):
    rng = random.Random(5)
    rows = [("k8s" if i % 3 else "pdu", dt.datetime(2025, 8, 1 + i % 6, i % 24), f"u{rng.randint(0, 3000)}",
             float(rng.randint(0, 10_000)) if i % 10 else None, "same") for i in range(20_000)]
    df = spark.createDataFrame(rows, "plugin string, _time timestamp, url string, v double, s string").checkpoint()
    path = f"{tmp_dir}/sk"
    sketches.write_sketches(df.filter("day(_time) <= 3"), path)
    sketches.write_sketches(df.filter("day(_time) >= 3"), path)       # day 3 again: replaced
    got = {r["column"]: r for r in sketches.range_profile(spark, path, "k8s", "2025-08-02", "2025-08-04").collect()}
    own = [r for r in rows if r[0] == "k8s" and 2 <= r[1].day <= 4]
    assert {r.n_rows for r in got.values()} == {len(own)}
    assert abs(got["url"].n_distinct / len({r[2] for r in own}) - 1) < 0.05 and got["s"].n_distinct == 1
    values = sorted(r[3] for r in own if r[3] is not None)
    assert got["v"].n_missing == len(own) - len(values) and (got["v"].low, got["v"].high) == (values[0], values[-1])
    for q, x in zip((0.05, 0.5, 0.95), got["v"].quantiles):
        rank = sum(v <= x for v in values) / len(values)
        assert abs(rank - q) < 0.03
    assert got["url"].quantiles is None
    plan = sketches.range_profile(spark, path, "k8s", "2025-08-02", "2025-08-04")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(plugin" in plan


def test_a_run_killed_after_any_stage_goes_on_from_there(spark, tmp_dir, monkeypatch):
    from conftest import SF001
    from wattspark.catalog import queries as q
    from wattspark.sources import telemetry

    store = f"{tmp_dir}/store"
    telemetry.write_telemetry(q.tel(spark, SF001), store)
    tel = telemetry.read_telemetry(spark, store)
    args = dict(vm_name_filter=q.VM_FILTER, interval="1D", num_trees=2, max_depth=None, split_key=q.SPLIT_KEY)
    names = ["kepler", "k8s", "dataset", "splits", "model", "metrics"]
    real, seen = resume.Run._commit, []

    def killed_at(stage):
        def commit(self, path, name):
            real(self, path, name)
            seen.append(name)
            if name == stage:
                raise RuntimeError("killed")
        return commit

    for stage in names[:-1]:
        monkeypatch.setattr(resume.Run, "_commit", killed_at(stage))
        with pytest.raises(RuntimeError):
            resume.energy_run(tel, q.START, q.STOP, f"{tmp_dir}/run", **args)
    monkeypatch.setattr(resume.Run, "_commit", killed_at(None))
    m, run = resume.energy_run(tel, q.START, q.STOP, f"{tmp_dir}/run", **args)
    assert seen == names and run.executed == ["metrics"] and run.reused == names[:-1]
    assert m.first().n > 0
    _, more = resume.energy_run(tel, q.START, q.STOP, f"{tmp_dir}/run", **{**args, "num_trees": 3})
    assert more.reused == names[:4] and more.executed == names[4:]
    telemetry.write_telemetry(q.tel(spark, SF001).limit(50), store)          # new input: all again
    _, fresh = resume.energy_run(telemetry.read_telemetry(spark, store), q.START, q.STOP, f"{tmp_dir}/run", **args)
    assert fresh.executed == names
