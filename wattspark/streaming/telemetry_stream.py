"""Streaming form of the pivot: new export files -> windowed wide rows.

Long telemetry arriving as files is read with ``readStream`` (explicit
schema), a watermark bounds how late a scrape may arrive, and the pivot is
the same single conditional aggregation as the batch form, grouped by an
event-time window instead of the exact scrape time.  (``groupBy().pivot()``
would plan two aggregations, which a streaming query with a watermark
refuses.)  State lives in the state store on the executors; results are
written by ``foreachBatch`` into a table, so nothing passes through the
driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattspark.functions.missing import clean_value, to_numeric
from wattspark.schemas import SOURCES


def read_long_stream(spark: SparkSession, path: str, schema: T.StructType,
                     fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame over the long telemetry files in ``path``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


def windowed_pivot(long: DataFrame, keys: Sequence[str], fields: Sequence[str], *,
                   window: str = "1 minute", watermark: str = "10 minutes",
                   time_col: str = "_time") -> DataFrame:
    """Mean of each field per (event-time window, keys); works on batch and
    streaming input alike.  ``_time`` of the output is the window start."""
    value = F.col("_value")
    if isinstance(long.schema["_value"].dataType, T.StringType):
        value = to_numeric(value)
    else:
        value = clean_value(value)
    ts = F.col(time_col).cast(T.TimestampType())
    base = long.select(ts.alias(time_col), *[F.col(f"`{k}`") for k in keys],
                       F.col("_field"), value.alias("_value"))
    cond = F.col("_value").isNotNull() & F.col("_field").isin(list(fields))
    for k in keys:
        cond = cond & F.col(f"`{k}`").isNotNull()
    base = base.where(cond)
    if long.isStreaming:
        base = base.withWatermark(time_col, watermark)
    grouped = base.groupBy(F.window(time_col, window).alias("w"), *[F.col(f"`{k}`") for k in keys])
    out = grouped.agg(*[F.avg(F.when(F.col("_field") == f, F.col("_value"))).alias(f)
                        for f in fields])
    return out.select(F.col("w.start").alias(time_col), *[F.col(f"`{k}`") for k in keys], *fields)


def source_windowed_pivot(long: DataFrame, source: str, **kw) -> DataFrame:
    """:func:`windowed_pivot` with the index keys and fields of a source."""
    src = SOURCES[source]
    keys = [k for k in src.index if k != "_time"]
    return windowed_pivot(long, keys, src.fields, **kw)


def run_to_table(stream: DataFrame, table_path: str, checkpoint_path: str, *,
                 output_mode: str = "append", available_now: bool = True,
                 fmt: str = "parquet") -> None:
    """Run the stream into a table from the executors (``foreachBatch``).

    An appended micro-batch is written to the table's partition ``batch_id``
    of its number, which a retry of the batch replaces, so no row comes twice.

    ``append`` (default, for long-running streams): a window is written once
    the watermark passes its end, and its state is then dropped, so state
    stays bounded.  ``complete``: every micro-batch rewrites the whole
    result; meant for draining a finite set of files, where append would
    never emit the windows the watermark has not yet passed.
    """
    def write(batch: DataFrame, number: int) -> None:
        if output_mode != "complete":
            batch = batch.withColumn("batch_id", F.lit(number))
            writer = batch.write.option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
        else:
            writer = batch.write
        writer.mode("overwrite").format(fmt).save(table_path)

    writer = (stream.writeStream.outputMode(output_mode)
              .option("checkpointLocation", checkpoint_path)
              .foreachBatch(write))
    writer = writer.trigger(availableNow=True) if available_now else writer
    q = writer.start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
