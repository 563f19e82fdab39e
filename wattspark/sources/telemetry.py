"""The long telemetry store: Parquet partitioned by ``plugin`` and ``date``.

A selection over the store names the plugin and a time range; with this
layout both become partition filters, so only the matching plugin/day
directories are listed and read, and ``_time`` bounds are also pushed into
the Parquet row-group statistics.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattspark.functions.missing import clean_value, to_numeric
from wattspark.functions.timeops import as_utc, in_range

VALUE_TEXT = "_value_text"


def normalize_values(long: DataFrame) -> DataFrame:
    """Store form of the value: ``_value`` double, parsed once at ingest.

    Text values are coerced with the numeric rule (``to_numeric``); text that
    is not a number (e.g. a status word) is missing in ``_value`` and kept
    verbatim in ``_value_text``.  Every later read then aggregates doubles
    instead of re-parsing strings.
    """
    if VALUE_TEXT in long.columns:
        return long
    if isinstance(long.schema["_value"].dataType, T.StringType):
        num = to_numeric(F.col("_value"))
        text = F.when(num.isNull() & F.col("_value").isNotNull(), F.col("_value"))
        return long.withColumns({VALUE_TEXT: text, "_value": num})
    return long.withColumns({VALUE_TEXT: F.lit(None).cast("string"),
                             "_value": clean_value(F.col("_value").cast("double"))})


def _date_col(time_col: str = "_time"):
    return F.date_format(F.col(time_col).cast(T.TimestampType()), "yyyy-MM-dd")


def write_telemetry(df: DataFrame, path: str, *, mode: str = "append",
                    files_per_partition: int | None = None,
                    max_records_per_file: int = 5_000_000) -> None:
    """Append long telemetry to the store (``plugin=<p>/date=<yyyy-mm-dd>``),
    values normalised by :func:`normalize_values`.

    Without ``files_per_partition`` every task writes one file per
    (plugin, date) it holds: no shuffle, fine for incremental appends.  For
    large backfills set it: rows are hash-partitioned on (plugin, date,
    salt) with ``files_per_partition`` salts, so each partition directory
    gets at most that many files, and a hot plugin or day is still written
    by that many tasks in parallel.
    """
    out = normalize_values(df).withColumn("date", _date_col())
    if files_per_partition:
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in out.columns]),
                      F.lit(files_per_partition))
        out = out.repartition("plugin", "date", salt)
    (out.sortWithinPartitions("plugin", "date", "_time")
     .write.mode(mode).partitionBy("plugin", "date")
     .option("maxRecordsPerFile", max_records_per_file)
     .parquet(path))


def read_telemetry(spark: SparkSession, path: str) -> DataFrame:
    """The whole store as one DataFrame (``plugin`` and ``date`` are
    partition columns; nothing is read until a query runs)."""
    return spark.read.option("basePath", path).parquet(path)


def date_bounds(start: datetime, stop: datetime) -> tuple[str, str]:
    """Inclusive date-partition range covering ``[start, stop)``."""
    start, last = as_utc(start), as_utc(stop) - timedelta(microseconds=1)
    return start.strftime("%Y-%m-%d"), last.strftime("%Y-%m-%d")


def prune(df: DataFrame, plugin: str | None, start: datetime, stop: datetime) -> DataFrame:
    """Partition filters (plugin, date) plus the exact time range."""
    lo, hi = date_bounds(start, stop)
    cond = (F.col("date") >= F.lit(lo)) & (F.col("date") <= F.lit(hi)) & in_range("_time", start, stop)
    if plugin:
        cond = cond & (F.col("plugin") == F.lit(plugin))
    return df.where(cond)


def ingest_exports(spark: SparkSession, directory: str, source: str, store_path: str, *,
                   files_per_partition: int = 8, one_header: bool = False) -> None:
    """Read a source's CSV exports once and append them to the store, at most
    ``files_per_partition`` files per plugin and day.

    Text parsing happens here, once; later selections read typed Parquet
    with partition pruning instead of re-scanning CSV.  The export name is
    not part of the store (the store is the bucket, not the exports).
    ``one_header``: the files share one header, so no pass has to find it.
    """
    from wattspark.sources.exports import read_exports

    long = read_exports(spark, directory, source, one_header=one_header).drop("_file")
    write_telemetry(long, store_path, files_per_partition=files_per_partition)
