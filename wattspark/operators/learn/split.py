"""Deterministic train/test split.

Membership is a pure function of a row key and the seed (an MD5 bucket), so
it is the same whatever the partitioning, the cluster size or a re-run after
executor loss, and it needs no shuffle.  ``randomSplit`` is not used: it
depends on partition layout.  Rows with an equal key land on the same side,
so passing a group key (e.g. the time bucket and container) keeps fan-out
copies of one measurement out of both sides.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattspark.operators.select import col

BUCKETS = 10_000


def split_bucket(key_cols: Sequence[str], seed: int) -> Column:
    """Bucket 0..9999 of a row: first 32 bits of md5('<key>|<seed>')."""
    key = F.concat_ws("|", *[col(c).cast("string") for c in key_cols])
    digest = F.md5(F.concat(key, F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % BUCKETS


def train_test_split(df: DataFrame, test_size: float = 0.2, seed: int = 42,
                     key_cols: Sequence[str] | None = None,
                     split_col: str = "split", exact: bool = False) -> DataFrame:
    """Add ``split`` = 'test' for about ``test_size`` of the rows, else 'train'.

    ``exact=True`` puts exactly ``ceil(test_size * n)`` rows in the test
    split: the rows with the smallest key hashes (see :func:`_exact_split`).
    """
    if not 0.0 <= test_size <= 1.0:
        raise ValueError("test_size must be within [0, 1]")
    keys = list(key_cols) if key_cols else df.columns
    if exact:
        return _exact_split(df, test_size, seed, keys, split_col)
    cut = int(round(test_size * BUCKETS))
    return df.withColumn(split_col, F.when(split_bucket(keys, seed) < cut, F.lit("test"))
                         .otherwise(F.lit("train")))


_LEVEL_BITS = 15
_LEVELS = 4          # 4 x 15 = 60 hash bits


def _hash60(key_cols: Sequence[str], seed: int) -> Column:
    key = F.concat_ws("|", *[col(c).cast("string") for c in key_cols])
    digest = F.md5(F.concat(key, F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _exact_split(df: DataFrame, test_size: float, seed: int, keys: Sequence[str],
                 split_col: str) -> DataFrame:
    """Exactly ``k = ceil(test_size * n)`` test rows: those with the smallest
    60-bit key hashes."""
    return mark_smallest(df, _hash60(keys, seed), test_size, split_col)


def mark_smallest(df: DataFrame, key: Column, share: float, mark_col: str = "split",
                  yes: str = "test", no: str = "train") -> DataFrame:
    """Mark exactly ``k = ceil(share * n)`` rows: those with the smallest
    ``key`` (0 <= key < 2**60), found without a global sort.

    The keyed rows are checkpointed (stable partitions for the passes
    below).  Four rounds of a 15-bit histogram narrow the boundary key (each
    round collects at most 32,768 counts).  Rows whose key equals the boundary
    are split by quotas: their count per partition is collected (one row per
    partition), the remaining quota is handed out in partition order, and
    within a partition the first rows by position take it; that ranking is a
    window over one partition's tie rows, never over all of them.
    """
    spark = df.sparkSession
    base = df.withColumn("__u", key).checkpoint(eager=True)
    base = base.withColumn("__p", F.spark_partition_id()).withColumn(
        "__row", F.monotonically_increasing_id())
    n = base.count()
    k = math.ceil(share * n)
    if k == 0 or k == n:
        return base.withColumn(mark_col, F.lit(yes if k else no)).drop(
            "__u", "__p", "__row")
    below = F.lit(False)     # rows certainly marked
    same = F.lit(True)       # rows sharing the boundary prefix so far
    need = k
    for level in range(_LEVELS):
        shift = (_LEVELS - level - 1) * _LEVEL_BITS
        bucket = F.shiftright(F.col("__u"), shift).bitwiseAND((1 << _LEVEL_BITS) - 1)
        hist = sorted(tuple(r) for r in base.where(same).groupBy(bucket.alias("b")).count()
                      .collect())
        cum = 0
        for b, c in hist:
            if cum + c >= need:
                bstar = b
                break
            cum += c
        below = below | (same & (bucket < bstar))
        same = same & (bucket == bstar)
        need -= cum
    ties = base.where(same)
    counts = sorted(tuple(r) for r in ties.groupBy("__p").count().collect())
    quota, left = [], need
    for p, c in counts:
        q = min(c, left)
        quota.append((p, q))
        left -= q
    quota_df = spark.createDataFrame(quota, "__p int, __q long")  # one row per partition
    rank = F.row_number().over(Window.partitionBy("__p").orderBy("__row"))
    tie_rows = (ties.join(F.broadcast(quota_df), "__p")
                .withColumn(mark_col, F.when(rank <= F.col("__q"), yes).otherwise(no))
                .drop("__q"))
    rest = base.where(~same).withColumn(
        mark_col, F.when(below, F.lit(yes)).otherwise(F.lit(no)))
    return rest.unionByName(tie_rows.select(*rest.columns)).drop("__u", "__p", "__row")
