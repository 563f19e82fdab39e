"""Running row numbers over a total order, without one task holding all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattspark.session import scratch_path


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "pos") -> DataFrame:
    """``df`` plus ``name``: 0, 1, ... in ``order``.

    Rows are sorted over ranges (sampled by Spark) and written; a row's number is its
    place in its range plus the rows of the ranges before.  The rows per range are the
    only thing collected: one number per task.  Rows equal in ``order`` are numbered
    in any order among themselves.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
     .withColumn("__at", F.monotonically_increasing_id()).write.parquet(path))
    rows = spark.read.parquet(path).withColumn("__range", F.shiftright("__at", 33))
    before, total = [], 0
    for r in rows.groupBy("__range").count().orderBy("__range").collect():
        before.append((r["__range"], total))
        total += r["count"]
    offsets = spark.createDataFrame(before, "__range long, __before long")
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return (rows.join(F.broadcast(offsets), "__range")     # one row per range
            .withColumn(name, F.col("__before") + place).drop("__at", "__range", "__before"))
