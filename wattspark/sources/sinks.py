"""Sinks: processed tables, dataset splits, metrics logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattspark.operators.joins import small_side
from wattspark.operators.numbering import number_rows
from wattspark.operators.select import col

#: Bits of time and of entity in the key of a clustered table.
CLUSTER_BITS = 16


def write_table(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, sort_within: str | None = None,
                header: bool = True) -> None:
    """Write a processed table (Parquet by default, CSV by option).

    ``sort_within`` orders rows inside each output file (for example by
    ``_time``) without a global sort shuffle.
    """
    if sort_within:
        df = df.sortWithinPartitions(sort_within)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", header).csv(path)
    else:
        w.format(fmt).save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "csv":
        return spark.read.option("header", True).option("inferSchema", False).csv(path)
    return spark.read.format(fmt).load(path)


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """X and y of every split in one table, partitioned by the split name."""
    write_table(df, path, partition_by=[split_col])


def read_split(spark: SparkSession, path: str, split: str, split_col: str = "split") -> DataFrame:
    """One split back (partition pruning on ``split_col``)."""
    return read_table(spark, path).where(f"{split_col} = '{split}'")


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Append a metrics row (run_id, mae, mse, r2, ...) to a metrics log."""
    metrics.write.mode("append").parquet(path)


def interleaved(a: Column, b: Column, bits: int = CLUSTER_BITS) -> Column:
    """The bits of two codes in turn (``a`` first), one sortable number."""
    out = F.lit(0).cast("long")
    for k in range(bits):
        for c, place in ((a, 2 * k + 1), (b, 2 * k)):
            bit = F.shiftright(c.cast("long"), k).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, place))
    return out


def write_clustered(df: DataFrame, path: str, entity: Sequence[str], *, time_col: str = "_time",
                    files: int | None = None) -> None:
    """Write a table whose files hold disjoint ranges of an interleaved (time, entity) key.

    Time is scaled between its ends, entities are numbered in their order, both to
    ``CLUSTER_BITS`` bits.  Rows are range-partitioned and sorted by the interleaved key, so a
    file covers a short span of time *and* few entities, and the minima and maxima of its
    row groups let a read of one entity and hour skip nearly all others.  ``files``
    defaults to the shuffle partitions.  Rows without a time come first.
    """
    spark, entity = df.sparkSession, list(entity)
    micros = F.unix_micros(col(time_col).cast(T.TimestampType()))
    ends = df.agg(F.min(micros).alias("low"), F.max(micros).alias("high")).first()
    low, span = ends["low"] or 0, max((ends["high"] or 0) - (ends["low"] or 0), 1)
    top = (1 << CLUSTER_BITS) - 1
    names = df.select(*[col(c) for c in entity]).distinct()
    names = number_rows(names, [col(c) for c in entity], "__entity")
    count = max(names.count() - 1, 1)
    names = names.select(*[col(c).alias(f"__e{k}") for k, c in enumerate(entity)],
                         F.floor(F.col("__entity") * F.lit(top) / F.lit(count)).alias("__entity"))
    same = [col(c).eqNullSafe(F.col(f"__e{k}")) for k, c in enumerate(entity)]
    on = same[0]
    for s in same[1:]:
        on = on & s
    rows = df.join(small_side(names), on).drop(*[f"__e{k}" for k in range(len(entity))])
    when = F.floor((micros - F.lit(low)) / F.lit(span) * F.lit(top))
    key = interleaved(F.coalesce(when, F.lit(0)), F.col("__entity"))
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (rows.withColumn("__key", key).repartitionByRange(n, "__key", time_col)
     .sortWithinPartitions("__key", time_col).drop("__key", "__entity")
     .write.mode("overwrite").parquet(path))


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str) -> None:
    """Store a processed table under ``path`` as ``table``, hashed by ``keys`` into buckets, so
    that joins and groupings on these and further keys need no exchange."""
    (df.repartition(buckets, *[col(k) for k in keys]).write.mode("overwrite")
     .bucketBy(buckets, *keys).option("path", path).saveAsTable(table))
