"""Property checks on small random inputs (hypothesis)."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wattspark.operators.pivot import pivot_mean
from wattspark.plans import datasets
from wattspark.schemas import ENERGY_K8S_COLUMNS, K8S_FIELDS, KEPLER_FIELDS

T0 = datetime(2025, 8, 4, 6, 0)

long_rows = st.lists(st.tuples(
    st.integers(0, 5),                       # minute offset
    st.sampled_from(["a", "b", "c", None]),  # key
    st.sampled_from(["x", "y", "z"]),        # field
    st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False), st.just(float("nan"))),
), max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(long_rows)
def test_pivot_rows_bounded_by_distinct_keys(spark, rows):
    data = [(T0 + timedelta(minutes=m), k, f, v) for m, k, f, v in rows]
    df = spark.createDataFrame(data, "_time timestamp, k string, _field string, _value double")
    out = pivot_mean(df, ["_time", "k"], ["x", "y"])
    keys = {(t, k) for t, k, f, v in data
            if k is not None and f in ("x", "y") and v is not None and v == v}
    assert out.count() == len(keys)
    for r in out.collect():
        assert r.x is not None or r.y is not None


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["c1", "c2"]), st.integers(0, 119)),
                min_size=1, max_size=25),
       st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["c1", "c2"]), st.integers(0, 119),
                          st.floats(0, 100, allow_nan=False)), max_size=25))
def test_energy_join_fan_out_count(spark, k8s_rows, kep_rows):
    base = {f: None for f in K8S_FIELDS}
    kr = []
    for i, (minute, c, sec) in enumerate(k8s_rows):
        vals = dict(base, cpu_usage_nanocores=1.0, memory_usage_bytes=1.0, logsfs_used_bytes=1.0,
                    logsfs_capacity_bytes=2.0)
        kr.append((T0 + timedelta(minutes=minute, seconds=sec % 60), c, "ns", f"n{i}", "p",
                   *[vals[f] for f in K8S_FIELDS]))
    k8s = spark.createDataFrame(kr, "_time timestamp, container_name string, namespace string, "
                                    "node_name string, pod_name string, "
                                    + ", ".join(f"{f} double" for f in K8S_FIELDS))
    er = [(T0 + timedelta(minutes=m, seconds=s % 60), "id", c, "ns", "p", j, 1.0)
          for m, c, s, j in kep_rows]
    kep = spark.createDataFrame(er, "_time timestamp, container_id string, container_name string, "
                                    "namespace string, pod_name string, "
                                    + ", ".join(f"{f} double" for f in KEPLER_FIELDS))
    out = datasets.energy_join(k8s, kep, "1min")
    buckets = {(m, c) for m, c, s, j in kep_rows}
    expected = sum(1 for m, c, s in k8s_rows if (m, c) in buckets)
    assert out.count() == expected
    assert set(out.columns) >= set(ENERGY_K8S_COLUMNS)


_num_text = st.one_of(
    st.from_regex(r"\A[ \t]?[+-]?[0-9]{0,4}(\.[0-9]{0,3})?([eE][+-]?[0-9]{1,3})?[dfx_%]?[ \t]?\Z"),
    st.sampled_from(["inf", "-inf", "Infinity", "nan", "NaN", "True", "0x10", "1_000", "", " ",
                     "1e400", "-1e400", "1.2.3", "++1", "e5", "."]),
)


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_num_text, min_size=200, max_size=200))
def test_to_numeric_agrees_with_pandas(spark, texts):
    import math

    import pandas as pd

    from wattspark.functions.missing import to_numeric

    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(to_numeric("s")).collect()]
    exp = pd.to_numeric(pd.Series(texts, dtype=object), errors="coerce").tolist()
    for t, g, e in zip(texts, got, exp):
        e = None if e is None or (isinstance(e, float) and math.isnan(e)) else float(e)
        assert g == e, (t, g, e)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.datetimes(min_value=datetime(1960, 1, 1), max_value=datetime(2040, 1, 1)),
                min_size=50, max_size=50),
       st.sampled_from(["1min", "15min", "7min", "1h", "1D", "30s", "2h"]))
def test_floor_time_agrees_with_pandas(spark, times, interval):
    import pandas as pd

    from wattspark.functions.timeops import floor_time

    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    got = [r[0] for r in df.select(floor_time("t", interval, ntz=True)).collect()]
    exp = [x.to_pydatetime() for x in pd.Series(pd.to_datetime(times)).dt.floor(interval)]
    assert got == exp


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]),
                          st.one_of(st.none(), st.just(float("nan")), st.integers(-50, 50).map(float)),
                          st.one_of(st.none(), st.just(float("nan")), st.integers(-50, 50).map(float))),
                min_size=1, max_size=30))
def test_group_aggregate_agrees_with_pandas(spark, rows):
    import math

    import pandas as pd

    from wattspark.operators.aggregate import group_aggregate

    df = spark.createDataFrame(rows, "k string, s double, m double")
    got = {r.k: (r.s, r.m) for r in group_aggregate(df, ["k"], {"s": "sum", "m": "mean"}).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "s", "m"]).astype({"s": float, "m": float})
    exp = pdf.groupby("k").agg({"s": "sum", "m": "mean"})
    assert set(got) == set(exp.index)
    for k, (s, m) in got.items():
        assert s == exp.loc[k, "s"]
        em = exp.loc[k, "m"]
        assert (m is None and math.isnan(em)) or m == em


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.one_of(st.just(0.0), st.integers(-5, 5).map(float)),
                          st.one_of(st.just(0.0), st.integers(-5, 5).map(float))),
                min_size=20, max_size=20))
def test_usage_percent_agrees_with_numpy(spark, pairs):
    import math

    import numpy as np

    from wattspark.functions import units

    df = spark.createDataFrame(pairs, "free double, total double")
    got = [r[0] for r in df.select(units.usage_percent_from_free("free", "total")).collect()]
    with np.errstate(divide="ignore", invalid="ignore"):
        exp = 100 * (1 - np.array([f for f, _ in pairs]) / np.array([t for _, t in pairs]))
    for g, e in zip(got, exp.tolist()):
        assert (g is None and math.isnan(e)) or g == e
