from pyspark.sql import functions as F

from wattspark.operators.joins import skew_split_join


def _data(spark):
    # key 'hot' holds half of the left rows; right is unique per key
    left = spark.range(0, 4000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("k"),
        F.col("id").alias("v"))
    left = left.unionByName(spark.createDataFrame([(None, -1)], "k string, v long"))
    right = spark.range(0, 97).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"),
                                      (F.col("id") * 10).alias("w"))
    right = right.unionByName(spark.createDataFrame([("hot", 7)], "k string, w long"))
    return left, right


def _sorted(df):
    return sorted((repr(tuple(r)) for r in df.select("k", "v", "w").collect()))


def test_split_join_equals_plain_join(spark):
    left, right = _data(spark)
    for how in ("inner", "left"):
        plain = left.join(right, ["k"], how)
        split = skew_split_join(left, right, ["k"], how, hot_fraction=0.1)
        assert _sorted(split) == _sorted(plain)


def test_salted_path_equals_plain_join(spark):
    left, right = _data(spark)
    # a right side with several rows per hot key forces the salted path
    right2 = right.unionByName(spark.createDataFrame([("hot", 8), ("hot", 9)], "k string, w long"))
    plain = left.join(right2, ["k"], "inner")
    split = skew_split_join(left, right2, ["k"], "inner", hot_fraction=0.1, max_broadcast_rows=1,
                            salt_buckets=8)
    assert _sorted(split) == _sorted(plain)


def test_dataset_split_mode_matches(spark):
    from conftest import SF001
    from wattspark.catalog import queries as Q
    from wattspark.plans import datasets

    k8s, kep = Q.wide(spark, SF001, "k8s"), Q.wide(spark, SF001, "kepler")
    a = datasets.energy_dataset(k8s, kep, "1D")
    b = datasets.energy_dataset(k8s, kep, "1D", skew="split")
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
