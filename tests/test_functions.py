import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wattspark.functions.missing import clean_tag, clean_value, ieee_div, to_numeric
from wattspark.functions.timeops import floor_time, interval_micros, parse_range
from wattspark.functions import units


def test_to_numeric_coerces_like_a_coercing_parse(spark):
    cases = [("1.5", 1.5), (" 7 ", 7.0), ("1e3", 1000.0), ("-2", -2.0), (".5", 0.5),
             ("running", None), ("1d", None), ("1f", None), ("0x10", None), ("", None),
             ("True", None), ("1_000", None), ("nan", None), (None, None), ("inf", math.inf)]
    df = spark.createDataFrame([(t,) for t, _ in cases], "t string")
    got = [r[0] for r in df.select(to_numeric("t")).collect()]
    assert got == [e for _, e in cases]


def test_ieee_division(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (6.0, 3.0), (None, 1.0),
                                (1.0, None)], "n double, d double")
    got = [r[0] for r in df.select(ieee_div("n", "d")).collect()]
    assert got == [math.inf, -math.inf, None, 2.0, None, None]


def test_usage_percent_from_free(spark):
    df = spark.createDataFrame([(0.0, 0.0), (5.0, 0.0), (25.0, 100.0)], "free double, total double")
    got = [r[0] for r in df.select(units.usage_percent_from_free("free", "total")).collect()]
    assert got[0] is None and got[1] == -math.inf and got[2] == 75.0


def test_guarded_percent(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 10.0), (5.0, -1.0)], "u double, c double")
    assert [r[0] for r in df.select(units.guarded_percent("u", "c")).collect()] == [0.0, 50.0, 0.0]


def test_missing_tokens_and_nan(spark):
    df = spark.createDataFrame([("NA", float("nan")), ("null", 1.0), ("x", None)], "t string, v double")
    rows = df.select(clean_tag("t").alias("t"), clean_value("v").alias("v")).collect()
    assert [(r.t, r.v) for r in rows] == [(None, None), (None, 1.0), ("x", None)]


def test_interval_parsing():
    assert interval_micros("1min") == 60_000_000
    assert interval_micros("15T") == 900_000_000
    assert interval_micros("1D") == 86_400_000_000
    assert interval_micros("30s") == 30_000_000
    with pytest.raises(ValueError):
        interval_micros("fortnight")


def test_floor_time_general_interval(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 10, 7, 59),), (datetime(1969, 12, 31, 23, 59, 59),)],
                               "t timestamp")
    rows = df.select(floor_time("t", "15min").alias("a"), floor_time("t", "1min").alias("b")).collect()
    assert rows[0].a == datetime(2024, 1, 1, 10, 0) and rows[0].b == datetime(2024, 1, 1, 10, 7)
    assert rows[1].a == datetime(1969, 12, 31, 23, 45)


def test_parse_range():
    now = datetime(2025, 8, 4, 12, 0, 0)
    assert parse_range("start: -10m", now) == (datetime(2025, 8, 4, 11, 50), now)
    s, e = parse_range("start: 2025-08-01T00:00:00Z, stop: 2025-08-05T23:59:59Z", now)
    assert s == datetime(2025, 8, 1) and e == datetime(2025, 8, 5, 23, 59, 59)


def test_tune_shuffle_sizes_partitions(spark):
    from wattspark.session import input_bytes, tune_shuffle

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        size = input_bytes(spark, ["/root/testdata/sf0.01/events.parquet"])
        assert size > 0
        n = tune_shuffle(spark, ["/root/testdata/sf0.01/events.parquet"], target_partition_bytes=1024)
        assert n == max(size // 1024 + 1, 2 * spark.sparkContext.defaultParallelism)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "true")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_parse_range_compound_and_calendar_durations():
    now = datetime(2025, 3, 31, 12, 0, 0)
    assert parse_range("start: -1h30m", now)[0] == datetime(2025, 3, 31, 10, 30)
    assert parse_range("start: -1mo", now)[0] == datetime(2025, 2, 28, 12, 0)    # day clamped
    assert parse_range("start: -1y", now)[0] == datetime(2024, 3, 31, 12, 0)
    assert parse_range("start: -2w, stop: -1d", now) == (datetime(2025, 3, 17, 12, 0),
                                                        datetime(2025, 3, 30, 12, 0))
    with pytest.raises(ValueError):
        parse_range("stop: -1h", now)
