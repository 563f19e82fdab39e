"""Near duplicates by SimHash and meet-in-the-middle ball hashing.

A text's fingerprint has bit b set if over half of its word shingles (repeats
included) have bit b set in their XXH64.  Two fingerprints within ``distance``
bits have a common point within half the distance of both, so every distinct
fingerprint emits all variants within half of it, and the variants are
shuffled.  Fingerprints that meet on a variant are linked, neighbour by
neighbour in order, after their bit distance is verified; links found on
several variants count once.  (For an even distance all that meet on a variant
are within the distance of each other, so the chain links the same groups as
all pairs would; a variant meets at most the fingerprints of one ball.)

Groups are the connected components of the links, found by alternating
large-star and small-star rounds over written tables.

Cases: a null or blank text has no shingles and fingerprint zero, linked like
any other; a text with fewer words than a shingle is one shingle; copies and
repeated rows share a fingerprint and hence a group; null ids never become a
group's id unless all its ids are null; an empty table gives an empty result;
extra columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hot_cold_join, keep_rows, materialize, own_names

SHINGLE = 3
DISTANCE = 2
SEED = 42


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text's word shingles (as an unsigned integer)."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    hashed = xxhash.xxh64_intdigest
    h = np.fromiter((hashed(x, SEED) for x in parts), np.uint64)
    bits = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``text_hash`` and ``fp`` (the signed 64-bit fingerprint)."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"),
                       text.cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")],
                          np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(fp)],
                names=["doc_id", "text_hash", "fp"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, fp long")


def ball_masks(radius: int) -> list[int]:
    """All 64-bit masks of at most ``radius`` bits, as signed integers."""
    found = [sum(1 << b for b in bits) for r in range(radius + 1)
             for bits in combinations(range(64), r)]
    return [x - (1 << 64) if x >= 1 << 63 else x for x in found]


def ball_links(points: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Verified links (``a`` < ``b``) between the distinct fingerprints in ``points.fp``."""
    if distance % 2:
        raise ValueError("the bit distance must be even: half of it is the ball's radius")
    masks = F.array(*[F.lit(m) for m in ball_masks(distance // 2)])
    met = points.select("fp", F.explode(masks).alias("mask")).select(
        F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"), "fp")
    before = F.lag("fp").over(Window.partitionBy("variant").orderBy("fp"))
    pairs = met.select(before.alias("a"), F.col("fp").alias("b")).filter("a is not null")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return pairs.filter(near).distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of (``a``, ``b``): rows (``node``, ``root``) with the smallest
    node as root.  Alternates large-star and small-star until the links are stars."""
    edges = materialize(links.select("a", "b"), name)

    def state(e):
        return e.agg(F.count(F.lit(1)).alias("n"),
                     F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("x")).first()

    def star(e, large):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        if not large:
            both = both.filter("v <= u")
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("m", "u").alias("m"))
        linked = both.join(least, "u")
        out = linked.filter("v > u" if large else "v <> m").select(
            F.col("m").alias("a"), F.col("v").alias("b"))
        if not large:
            out = out.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
        return out.filter("a <> b").select(F.least("a", "b").alias("a"),
                                           F.greatest("a", "b").alias("b")).distinct()

    before = state(edges)
    while before["n"]:
        edges = materialize(star(star(edges, True), False), name)
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def near_duplicate_groups(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``text_hash``, ``fingerprint`` (hex),
    ``component_id`` (smallest id in the group) and ``kept`` (the group's row that stays)."""
    rows = materialize(fingerprints(docs, shingle, id_col, text_col), "simhash-rows")
    total = rows.count()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    points = materialize(rows.groupBy("fp").agg(first.alias("first"),
                                                F.count(F.lit(1)).alias("n")), "simhash-points")
    tree = components(ball_links(points, distance), "simhash-links")
    rooted = (points.join(tree, points["fp"] == tree["node"], "left")
              .select("fp", "first", "n", F.coalesce("root", "fp").alias("root")))
    best = rooted.groupBy("root").agg(F.min("first").alias("best"))
    groups = materialize(rooted.join(best, "root").select("fp", "n", "best"), "simhash-groups")
    out = hot_cold_join(rows, groups, ["fp"], "n", total)
    return out.select(
        "doc_id", "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("best.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
         & (F.col("text_hash") == F.col("best.text_hash"))).alias("kept"))


@own_names
def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows that stay (all columns): one document of each group."""
    groups = materialize(near_duplicate_groups(docs, shingle, distance, id_col, text_col),
                         "simhash-verdict")
    return keep_rows(docs, groups.select(F.col("doc_id").alias("id"),
                                         F.col("text_hash").alias("hash"), "kept"), id_col,
                     F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
