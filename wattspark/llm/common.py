"""Helpers shared by the corpus operators: text columns, scratch tables, checked joins."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspark.session import scratch_path

#: ASCII white space, the separator of words (Java / RE2 syntax).  Python's
#: ``bytes.split()`` splits on exactly these six bytes.
SPACES = r"[\x20\x09-\x0D]+"
#: Rows at most this many times the mean row count are hashed into one bucket
#: where an operator numbers rows inside buckets.
BUCKET_ROWS = 8_192
#: Largest table (bytes, counted before use) an operator broadcasts.
BROADCAST_BYTES = 32 * 1024 ** 2


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts lineage: a lost executor costs a re-read, and values that depend on
    task order (row counters) are fixed from here on.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def own_names(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators that keep all input columns and name their own ``__...``: input columns of
    such names are renamed on the way in and back on the way out."""
    @wraps(fn)
    def run(df: DataFrame, *args, **how) -> DataFrame:
        taken = [c for c in df.columns if c.startswith("__")]
        if not taken:
            return fn(df, *args, **how)
        mark = "in_"
        while any(c.lower().startswith(mark) for c in df.columns):
            mark += "_"
        safe = {c: f"{mark}{k}" for k, c in enumerate(taken)}
        new = lambda v: safe.get(v, v) if isinstance(v, str) else v
        out = fn(df.withColumnsRenamed(safe), *map(new, args), **{k: new(v) for k, v in how.items()})
        return out.withColumnsRenamed({v: k for k, v in safe.items()})

    return run


def sliced(batches: Iterable, rows: int = 1024) -> Iterator:
    """Arrow batches cut into pieces of at most ``rows`` rows (no copies), which bounds
    what a task holds as Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def words_column(text: Column) -> Column:
    """Array of the words of a text (null or blank text: empty array)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words of a text as a long (null: 0)."""
    return F.size(words_column(text)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def checked_broadcast(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``broadcast(df)`` when ``rows * row_bytes`` is under the bound, else ``df`` as it is."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def hot_cold_join(left: DataFrame, right: DataFrame, on: Sequence[str], weight: str,
                  total: int, share: float = 1e-3) -> DataFrame:
    """Inner join whose hot keys never meet in one task.

    ``right`` has one row per key and ``weight`` counts the key's rows in
    ``left`` (``total`` rows).  Keys with more than ``share`` of the rows are
    at most ``1 / share``, so their rows are broadcast; the others are joined
    by a shuffle.  ``left`` is read twice and should be a written table.
    """
    on = list(on)
    bar = max(1.0, share * total)
    hot = F.broadcast(right.filter(F.col(weight) > bar))
    cold = right.filter(F.col(weight) <= bar)
    return (left.join(hot, on)
            .unionByName(left.join(hot.select(*on), on, "left_anti").join(cold, on)))


def numbered(df: DataFrame, within: Sequence[str], order: Sequence[Column], spread: Column,
             name: str, total: int, weight: Column | None = None) -> DataFrame:
    """Add a running position per ``within`` group without one task holding a group.

    Rows are put into ``ceil(total / BUCKET_ROWS)`` buckets by ``spread`` (a
    non-negative 62-bit order key: buckets are ranges of it).  Positions inside
    a bucket come from a window over that bucket, the bucket offsets from a
    prefix sum over the small (group, bucket) table.  ``name`` gets the sum of
    ``weight`` (default 1) over the rows before this one in
    (spread, ``order``) order.
    """
    from pyspark.sql import Window

    within = list(within)
    buckets = max(1, -(-total // BUCKET_ROWS))
    one = F.lit(1).cast("long") if weight is None else weight
    width = (1 << 62) // buckets + 1
    rows = df.withColumn("__b", F.floor(spread / F.lit(width)).cast("long"))
    rows = rows.withColumn("__w", one)
    keys = [*within, "__b"]
    before = Window.partitionBy(*within).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy(*keys).agg(F.sum("__w").alias("__s"))
               .select(*keys, F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__o")))
    inside = (Window.partitionBy(*keys).orderBy(spread, *order)
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("__i", F.coalesce(F.sum("__w").over(inside), F.lit(0)))
    left, right = rows.alias("l"), offsets.alias("r")
    cond = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    out = left.join(right, cond).select("l.*", "r.__o")
    return (out.withColumn(name, (F.col("__o") + F.col("__i")).cast("long"))
            .drop("__b", "__w", "__i", "__o"))


def order_key(*cols: Column) -> Column:
    """A seeded 62-bit non-negative order key of the given columns."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 2)


def keep_rows(docs: DataFrame, verdict: DataFrame, id_col: str, row_hash: Column) -> DataFrame:
    """The rows of ``docs`` (all columns) that a row-wise verdict keeps.

    ``verdict`` has a row (``id``, ``hash``, ``kept``) per input row, where
    ``hash`` equals ``row_hash`` of that row.  Of repeated rows (same id and
    hash) one is kept.  Only the rows to drop or to thin out are joined.
    """
    drop = (verdict.groupBy(F.xxhash64("id").alias("__k"), F.col("hash").alias("__h"))
            .agg(F.max("kept").alias("__kept"), F.count(F.lit(1)).alias("__n"))
            .filter("not __kept or __n > 1"))
    drop = materialize(drop, "rows-to-drop")
    keys = ["__k", "__h"]
    rows = docs.withColumns({"__k": F.xxhash64(F.col(f"`{id_col}`")), "__h": row_hash})
    rows = rows.join(checked_broadcast(drop, drop.count(), 32), keys, "left")
    once = rows.filter(F.col("__n").isNull())
    thinned = rows.filter(F.col("__kept")).dropDuplicates(keys)
    return once.unionByName(thinned).select(*[F.col(f"`{c}`") for c in docs.columns])
