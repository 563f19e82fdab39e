from datetime import datetime

import pytest

from wattspark.operators.aggregate import distinct_rows, group_aggregate
from wattspark.operators.pivot import pivot_mean

T0 = datetime(2025, 8, 4, 6, 0, 0)
T1 = datetime(2025, 8, 4, 6, 1, 0)
LONG = "_time timestamp, k string, _field string, _value double"


def _rows(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_pivot_mean_of_duplicates_and_missing_rules(spark):
    df = spark.createDataFrame([
        (T0, "a", "x", 1.0), (T0, "a", "x", 3.0),        # duplicate -> mean 2.0
        (T0, "a", "y", 5.0),
        (T0, None, "x", 9.0),                            # missing key -> dropped
        (T1, "b", "x", None), (T1, "b", "y", float("nan")),  # all missing -> no row
        (T1, "c", "zzz", 4.0),                           # undeclared field only -> no row
    ], LONG)
    out = pivot_mean(df, ["_time", "k"], ["x", "y"])
    assert out.columns == ["_time", "k", "x", "y"]
    assert _rows(out, ["_time", "k"]) == [(T0, "a", 2.0, 5.0)]


def test_pivot_absent_field_is_null_column_and_strict_raises(spark):
    df = spark.createDataFrame([(T0, "a", "x", 1.0)], LONG)
    assert _rows(pivot_mean(df, ["_time", "k"], ["x", "w"]), ["k"]) == [(T0, "a", 1.0, None)]
    with pytest.raises(KeyError):
        pivot_mean(df, ["_time", "k"], ["x", "w"], strict=True)


def test_pivot_text_values_are_coerced(spark):
    df = spark.createDataFrame([(T0, "a", "x", "2"), (T0, "a", "status", "running"),
                                (T0, "a", "y", "1d")], "_time timestamp, k string, _field string, _value string")
    out = pivot_mean(df, ["_time", "k"], ["status", "x", "y"])
    assert _rows(out, ["k"]) == [(T0, "a", None, 2.0, None)]


def test_pivot_per_file_keeps_overlaps(spark):
    rows = [(T0, "a", "x", 1.0, "f1.csv"), (T0, "a", "x", 3.0, "f2.csv")]
    df = spark.createDataFrame(rows, LONG + ", _file string")
    assert sorted(r.x for r in pivot_mean(df, ["_time", "k"], ["x"]).collect()) == [1.0, 3.0]
    merged = pivot_mean(df, ["_time", "k"], ["x"], per_file=False)
    assert [r.x for r in merged.collect()] == [2.0]


def test_discover_fields(spark):
    df = spark.createDataFrame([(T0, "a", "q", 1.0), (T0, "a", "p", 2.0)], LONG)
    out = pivot_mean(df, ["_time", "k"], "discover")
    assert out.columns == ["_time", "k", "p", "q"]


def test_group_sum_zero_and_mean_null(spark):
    df = spark.createDataFrame([("g", None, None), ("g", None, None), ("h", 1.0, 2.0),
                                ("h", 3.0, None), (None, 5.0, 5.0)], "k string, s double, m double")
    out = group_aggregate(df, ["k"], {"s": "sum", "m": "mean"})
    assert _rows(out, ["k"]) == [("g", 0.0, None), ("h", 4.0, 2.0)]


def test_distinct_rows_treats_missing_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, float("nan")), (1, float("nan")), (2, 1.0)],
                               "a int, b double")
    assert distinct_rows(df).count() == 3


def test_strict_and_discover_use_non_missing_values(spark):
    df = spark.createDataFrame([(T0, "a", "x", 1.0), (T0, "a", "w", None)], LONG)
    with pytest.raises(KeyError):
        pivot_mean(df, ["_time", "k"], ["x", "w"], strict=True)   # 'w' has no value
    assert pivot_mean(df, ["_time", "k"], "discover").columns == ["_time", "k", "x"]
