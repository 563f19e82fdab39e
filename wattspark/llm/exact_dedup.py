"""Exact duplicates through an extendible-hash index on shared files.

Every text is normalised (each run of ASCII white space becomes one space)
and hashed (XXH64).  The distinct keys fill the buckets of an extendible-hash
directory: a bucket with more than ``capacity`` keys is split by one more hash
bit, doubling the directory until no bucket is overfull or the last bit of the
directory is used.  The index is written to the shared scratch folder in key
order, so each file holds a range of buckets.  Texts that share a key are looked
up with their bucket, combined and compared by their bytes, and dealt to tasks
by ranges of buckets: the owner of a range chains the different texts under one
key of a bucket.

Only DataFrame functions are used.

Cases: a null text counts as empty, so null and empty texts are one group; a
null ``doc_id`` never becomes a group's ``keep_id`` unless all its ids are
null; of repeated rows with the smallest id exactly one is kept; an empty
table gives an empty result; extra columns are ignored whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, checked_broadcast, hot_cold_join, keep_rows, materialize, own_names

#: Keys a bucket holds before it is split.
BUCKET_CAPACITY = 4096
#: Directory bits beyond an even spread of the keys.
SPARE_BITS = 2


def normalized(text):
    """The text with each run of ASCII white space replaced by one space (null: empty)."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def bucket_directory(keys: DataFrame, n_keys: int, capacity: int = BUCKET_CAPACITY) -> DataFrame:
    """The extendible-hash directory of the distinct hashes in ``keys.h``.

    One row per directory slot that has keys: ``slot`` (the first
    ``global_depth`` hash bits), ``local_depth`` and ``bucket`` (first hash of
    the slot's bucket).  Several slots point to one bucket where its local
    depth is below the global depth.  A bucket still overfull at the global
    depth chains its surplus keys.
    """
    bits = max(1, max(0, (max(n_keys, 1) - 1).bit_length() - (capacity.bit_length() - 1))
               + SPARE_BITS)
    slots = keys.groupBy(F.shiftrightunsigned("h", 64 - bits).alias("slot")).agg(
        F.count(F.lit(1)).alias("n"))
    depths = slots.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth"))
    depths = depths.withColumn("prefix", F.expr(f"shiftrightunsigned(slot, {bits} - depth)"))
    fits = (depths.groupBy("depth", "prefix").agg(F.sum("n").alias("held"))
            .filter((F.col("held") <= capacity) | (F.col("depth") == bits)))
    local = (depths.join(fits, ["depth", "prefix"]).groupBy("slot")
             .agg(F.min("depth").alias("local_depth")))
    return local.select(
        "slot", "local_depth", F.lit(bits).alias("global_depth"),
        F.expr(f"shiftleft(shiftrightunsigned(slot, {bits} - local_depth), "
               f"{bits} - local_depth)").alias("bucket"))


def build_index(entries: DataFrame, capacity: int = BUCKET_CAPACITY) -> DataFrame:
    """Write the index: one row per distinct (h, digest) with its bucket, in key order."""
    digests = materialize(
        entries.groupBy("h", "sha").agg(F.min("id").alias("keep_id"),
                                        F.count(F.lit(1)).alias("n")), "dedup-digests")
    n_keys = digests.count()
    directory = bucket_directory(digests, n_keys, capacity)
    bits = max(1, max(0, (max(n_keys, 1) - 1).bit_length() - (capacity.bit_length() - 1))
               + SPARE_BITS)
    placed = (digests.withColumn("slot", F.shiftrightunsigned("h", 64 - bits))
              .join(directory.select("slot", "bucket", "local_depth"), "slot").drop("slot"))
    return materialize(placed.repartitionByRange("bucket", "h")
                       .sortWithinPartitions("bucket", "h", "sha"), "dedup-index")


def _members(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (bucket, h, id, norm) of the documents whose hash occurs more than once."""
    rows = (docs.select(F.col(id_col).alias("id"), normalized(F.col(text_col)).alias("norm"))
            .withColumn("h", F.xxhash64("norm")))
    return rows.join(checked_broadcast(keys, keys.count(), 24), "h")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = BUCKET_CAPACITY) -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256`` of the normalised text, ``h`` (its key) and ``chain`` (its
    place among different texts with this key)."""
    norm = normalized(F.col(text_col))
    entries = materialize(docs.select(F.col(id_col).alias("id"), F.xxhash64(norm).alias("h"),
                                      F.sha2(norm, 256).alias("sha")), "dedup-entries")
    total = entries.count()
    index = build_index(entries, capacity)
    shared = (index.groupBy("bucket", "h").agg(F.sum("n").alias("rows"))
              .filter("rows > 1").select("bucket", "h"))
    shared = materialize(shared, "dedup-shared")
    # grouping by the normalised text itself compares the bytes; equal texts
    # are combined before the shuffle, so a hot group sends one row per task
    chains = (_members(docs, shared, id_col, text_col)
              .groupBy("bucket", "h", "norm").agg(F.min("id").alias("keep_id"),
                                                  F.count(F.lit(1)).alias("group_size"))
              .select("bucket", "h", F.sha2("norm", 256).alias("sha"), "keep_id", "group_size"))
    # one row per text that shares a key; the owner of a range of buckets chains them
    chains = chains.repartitionByRange("bucket", "h")
    same = Window.partitionBy("bucket", "h", "sha")
    chains = chains.select(
        "h", "sha", "keep_id", "group_size",
        (F.row_number().over(Window.partitionBy("bucket", "h").orderBy("sha")) - 1).alias("chain"),
        F.count(F.lit(1)).over(same).alias("texts"))
    chains = chains.select("h", "sha", "keep_id", "group_size", F.when(
        F.col("texts") > 1, F.raise_error(F.lit("different texts share both digests"))
        .cast("int")).otherwise(F.col("chain")).alias("chain"))
    alone = (index.join(checked_broadcast(shared, shared.count(), 24), ["bucket", "h"], "left_anti")
             .select("h", "sha", "keep_id", F.col("n").alias("group_size"),
                     F.lit(0).alias("chain")))
    groups = materialize(chains.unionByName(alone), "dedup-groups")
    rows = hot_cold_join(entries, groups, ["h", "sha"], "group_size", total)
    # of repeated rows (same id, same text) one stays
    nth = F.row_number().over(Window.partitionBy("h", "sha", "id").orderBy("chain"))
    return rows.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (nth == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"), "h", "chain")


@own_names
def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          capacity: int = BUCKET_CAPACITY) -> DataFrame:
    """The input rows that stay (all columns): of equal texts the one with the smallest id."""
    groups = materialize(exact_groups(docs, id_col, text_col, capacity), "dedup-rows")
    return keep_rows(docs, groups.select(F.col("doc_id").alias("id"), F.col("h").alias("hash"),
                                         "kept"),
                     id_col, F.xxhash64(normalized(F.col(text_col))))
