"""Exactly-once ingest of export files into a telemetry store.

The store holds data in ``data/batch=<n>/plugin=<p>/date=<d>`` and a ledger of files in
``ledger``.  An ingest

1. lists the files (names and lengths only; empty files count for nothing) and leaves out those the ledger knows by path
   and length (left-anti join);
2. digests the others' lines and finds their headers (one distributed pass, no file in one
   task); a digest that the ledger has under any path, or that an earlier file of this ingest
   has, is not read again;
3. stages the new files' rows in the next batch's folder, replacing what a failed attempt
   left there;
4. commits by appending the batch's ledger rows, one file.

Readers see the committed batches only, so a repeated or half-failed ingest leaves the rows
as they are.  A path that comes back with other content replaces its earlier rows: its
older batch is superseded for that path.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspark.session import glob_paths, path_exists, scratch_path
from wattspark.sources import exports
from wattspark.sources.telemetry import normalize_values, write_telemetry

LEDGER = "batch long, path string, file_id long, length long, digest string, held boolean"


def read_ledger(spark: SparkSession, store: str) -> DataFrame:
    """All committed ledger rows; ``held`` says whether the batch holds the file's rows (else
    its content was known)."""
    path = f"{store.rstrip('/')}/ledger"
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def file_digests(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path`` and ``digest`` of the lines of each file: their number and two sums of 64-bit
    hashes, added up by every task (the order of lines does not count); ``headers``, the
    distinct header lines."""
    wide = "decimal(38,0)"
    lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("path"))
    sums = lines.groupBy("path").agg(
        F.count(F.lit(1)).cast("string").alias("n"),
        F.sum(F.xxhash64("value").cast(wide)).cast("string").alias("a"),
        F.sum(F.xxhash64("value", F.lit(7)).cast(wide)).cast("string").alias("b"),
        exports.distinct_headers(F.col("value")).alias("headers"))
    return sums.select("path", F.sha2(F.concat_ws("|", "n", "a", "b"), 256).alias("digest"), "headers")


def _listed(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path`` and ``length`` of the files (their content is not read)."""
    return (spark.read.format("binaryFile").load(list(paths))
            .select(F.col("_metadata.file_path").alias("path"), "length").distinct())


def ingest_once(spark: SparkSession, store: str, source: str, directory: str = "", *,
                paths: Sequence[str] | None = None, files_per_partition: int = 8) -> DataFrame:
    """Ingest the exports of ``source`` found in ``directory`` (or ``paths``) that the store
    does not hold.  Returns the ledger rows this call committed (none: nothing was new)."""
    store = store.rstrip("/")
    globs = list(paths) if paths is not None else exports.export_globs(directory, source)
    globs = exports.existing(spark, globs)
    none = spark.createDataFrame([], LEDGER)
    if not globs:
        return none
    known = read_ledger(spark, store)
    latest = _latest(known)
    fresh = _listed(spark, globs).join(latest.select("path", "length"), ["path", "length"], "left_anti")
    fresh_paths = [r["path"] for r in fresh.select("path").collect()]     # names of new files
    if not fresh_paths:
        return none
    batch = (known.agg(F.max("batch")).first()[0] or 0) + 1
    sized = fresh.join(file_digests(spark, fresh_paths), "path")
    staged = scratch_path(spark, "ingest-files")
    sized.write.parquet(staged)
    sized = spark.read.schema(sized.schema).parquet(staged)
    # content held now under some path that this call does not replace
    held = (latest.join(sized.select("path"), "path", "left_anti").filter("held")
            .select("digest").distinct().withColumn("elsewhere", F.lit(True)))
    first = sized.groupBy("digest").agg(F.min("path").alias("first"))      # one of equal new files
    rows = (sized.join(first, "digest").join(held, "digest", "left")
            .select(F.lit(batch).cast("long").alias("batch"), "path", F.xxhash64("path").alias("file_id"),
                    "length", "digest",
                    (F.col("elsewhere").isNull() & (F.col("path") == F.col("first"))).alias("held"),
                    "headers"))
    entries = rows.collect()                                               # one per new file
    out = spark.createDataFrame([r[:-1] for r in entries], LEDGER)
    keep = {r["path"]: r["headers"] for r in entries if r["held"]}
    target = f"{store}/data/batch={batch}"
    if keep:
        long = exports.read_exports(spark, "", source, paths=list(keep), with_path=True,
                                    headers=keep)
        long = normalize_values(long.withColumn("file_id", F.xxhash64("_path")).drop("_path", "_file"))
        if "plugin" not in long.columns:
            long = long.withColumn("plugin", F.lit(source))
        write_telemetry(long, target, mode="overwrite", files_per_partition=files_per_partition)
    # the commit: ledger rows appear in one file, after the data
    out.coalesce(1).write.mode("append").parquet(f"{store}/ledger")
    return out


def _latest(ledger: DataFrame) -> DataFrame:
    """The ledger row in force of each path."""
    newest = ledger.groupBy("path").agg(F.max("batch").alias("batch"))
    return ledger.join(newest, ["path", "batch"])


def read_ingested(spark: SparkSession, store: str) -> DataFrame:
    """The store's rows: committed batches, without rows of replaced files.  ``plugin`` and
    ``date`` prune folders as in :func:`telemetry.read_telemetry`."""
    store = store.rstrip("/")
    ledger = read_ledger(spark, store)
    batches = [r[0] for r in ledger.filter("held").select("batch").distinct().collect()]
    folders = [f"{store}/data/batch={b}" for b in sorted(batches)]
    folders = [p for p in folders if glob_paths(spark, f"{p}/plugin=*")]     # files can hold a header only
    if not folders:
        raise FileNotFoundError(f"no committed batch in {store}")
    rows = spark.read.option("basePath", f"{store}/data").option("mergeSchema", True).parquet(*folders)
    current = _latest(ledger).select("path", "batch")
    replaced = (ledger.filter("held").join(current.withColumnRenamed("batch", "now"), "path")
                .filter("batch <> now").select("batch", "file_id").distinct())
    if not replaced.isEmpty():
        rows = rows.join(replaced, ["batch", "file_id"], "left_anti")
    return rows.drop("batch", "file_id")
