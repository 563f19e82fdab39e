"""Join helpers: metadata joins, inventory semi-joins, regex theta joins.

Equi-joins are left to Catalyst/AQE: the smaller side becomes a broadcast
only when its measured runtime size is below the threshold, otherwise a
shuffle join runs, and AQE splits a skewed (hot-key) partition.  The only
explicit broadcasts are of sets that were first materialised and counted,
rows and bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattspark.operators import regex_index
from wattspark.operators.select import col

#: Largest pattern set broadcast in one piece by :func:`regex_match_join`.
MAX_BROADCAST_PATTERNS = 5000
#: Most (distinct text, distinct pattern) pairs compared one by one without an index.
MAX_LOOP_PAIRS = 10_000


#: Largest lookup set (e.g. inventory ids) broadcast by an explicit hint: rows
#: and bytes, both counted on the materialised set.
MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 32 * 1024 ** 2


def materialize_small(df: DataFrame) -> tuple[DataFrame, int]:
    """Write a (expected small) derived set to the checkpoint folder and
    count it, so a later broadcast of it has a checked size and the scan
    that produced it is not repeated by every consumer."""
    out = df.checkpoint(eager=True)
    return out, out.count()


def broadcast_if_small(df: DataFrame, n_rows: int, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when the counted rows and bytes of a materialised
    set are within the bounds; otherwise the join planner (and AQE) picks a
    shuffle join."""
    return F.broadcast(df) if n_rows <= max_rows and table_bytes(df) <= MAX_BROADCAST_BYTES else df


def table_bytes(df: DataFrame) -> int:
    """Bytes of the values of a (small, materialised) table: text by its
    length, anything else 8 bytes, and 16 per value and row of overhead."""
    size = F.lit(0).cast("long")
    for f in df.schema.fields:
        text = isinstance(f.dataType, T.StringType)
        size = size + 16 + (F.coalesce(F.octet_length(col(f.name)), F.lit(0)) if text else F.lit(8))
    return int(df.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"])


def small_side(df: DataFrame) -> DataFrame:
    """Materialise a derived lookup set and hint its broadcast if its counted
    size allows, so that the other side is not exchanged."""
    out, n = materialize_small(df)
    return broadcast_if_small(out, n)


def left_meta_join(left: DataFrame, meta: DataFrame, keys: Sequence[str],
                   shared: str, suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Left join ``meta`` on ``keys``; a non-key column present on both sides
    (``shared``) becomes ``shared_x`` (left) and ``shared_y`` (right), placed
    as the reference's merge places them (left columns, then right)."""
    keys = list(keys)
    lx, ry = shared + suffixes[0], shared + suffixes[1]
    left_cols = [c if c != shared else lx for c in left.columns]
    l2 = left.withColumnRenamed(shared, lx)
    r2 = small_side(meta.withColumnRenamed(shared, ry))
    out = l2.join(r2, on=keys, how="left")
    right_cols = [c for c in r2.columns if c not in keys]
    return out.select(*[col(c) for c in left_cols + right_cols])


def semi_join_values(df: DataFrame, values: DataFrame, column: str,
                     value_column: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``column`` equals one of ``values`` (one job,
    instead of one selection per value)."""
    vc = value_column or column
    v = small_side(values.select(col(vc).alias("__v")).distinct())
    return df.join(v, col(column) == F.col("__v"), "left_semi")


def _pattern_chunks(patterns: DataFrame, pcol: str, max_rows: int) -> list[DataFrame]:
    """Materialise the distinct pattern set and split it into pieces of
    about ``max_rows`` so that every broadcast has a checked size."""
    pats = patterns.select(col(pcol).alias("__pattern")).where(F.col("__pattern").isNotNull())
    pats = pats.distinct().checkpoint(eager=True)
    n = pats.count()
    if n <= max_rows:
        return [pats]
    k = -(-n // max_rows)
    bucketed = pats.withColumn("__chunk", F.pmod(F.xxhash64("__pattern"), F.lit(k)))
    return [bucketed.where(F.col("__chunk") == i).drop("__chunk") for i in range(k)]


def regex_match_join(df: DataFrame, patterns: DataFrame, text_col: str, pattern_col: str,
                     *, how: str = "inner", escape: bool = False,
                     max_broadcast_rows: int = MAX_BROADCAST_PATTERNS,
                     max_pairs: int = MAX_LOOP_PAIRS) -> DataFrame:
    """Theta join ``text_col =~ /pattern/`` (partial match, unescaped).

    Only the *distinct* texts of ``df`` and the distinct patterns are
    compared, never raw rows; both are counted.  Up to ``max_pairs`` pairs
    they meet in a nested loop.  Beyond it, patterns that hold a literal of
    three characters are looked up in a trigram index of the texts
    (:mod:`wattspark.operators.regex_index`), and only the others are looped:
    the texts are the broadcast side when they fit ``max_broadcast_rows``, so
    each pattern is compiled once for all texts, otherwise the patterns are
    broadcast in counted pieces.  The matching (text, pattern) pairs are
    then equi-joined back to ``df``.  ``how='inner'`` yields one row per
    (row, matching pattern) with the pattern in ``pattern_col``;
    ``'left_semi'`` keeps each matching row once.  ``escape=True`` treats
    patterns as literal text.
    """
    texts = df.select(col(text_col).alias("__text")).where(F.col("__text").isNotNull()).distinct()
    texts, n_texts = materialize_small(texts)

    def cond():
        return (F.instr(F.col("__text"), F.col("__pattern")) > 0) if escape else \
            F.expr("__text rlike __pattern")

    pats = (patterns.select(col(pattern_col).alias("__pattern"))
            .where(F.col("__pattern").isNotNull()).distinct())
    pats, n_pats = materialize_small(pats)
    pieces = []
    if n_texts * n_pats > max_pairs:
        pats, _ = materialize_small(regex_index.with_literals(pats, escape))
        long = F.length("__literal") >= regex_index.GRAM
        pieces.append(regex_index.indexed_pairs(texts, pats.where(long), escape))
        pats, n_pats = materialize_small(pats.where(~long).drop("__literal"))
    if n_pats and n_texts <= max_broadcast_rows:
        pieces.append(pats.join(F.broadcast(texts), cond(), "inner"))
    elif n_pats:
        pieces += [texts.join(F.broadcast(chunk), cond(), "inner")
                   for chunk in _pattern_chunks(pats, "__pattern", max_broadcast_rows)]
    if not pieces:
        pieces = [texts.limit(0).withColumn("__pattern", F.lit(None).cast("string"))]
    pairs = pieces[0].select("__text", "__pattern")
    for p in pieces[1:]:
        pairs = pairs.unionByName(p.select("__text", "__pattern"))
    pairs, n_pairs = materialize_small(pairs)
    if how == "left_semi":
        keys = small_side(pairs.select("__text").distinct())
        return df.join(keys, col(text_col) == F.col("__text"), "left_semi")
    joined = df.join(broadcast_if_small(pairs, n_pairs), col(text_col) == F.col("__text"), "inner")
    return joined.drop("__text").withColumnRenamed("__pattern", pattern_col)


def skew_split_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                    *, hot_fraction: float = 0.01, salt_buckets: int = 64,
                    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                    materialize_left: bool = True) -> DataFrame:
    """Equi-join that isolates the hot keys of ``left`` (inner or left join).

    1. rows per key on the left (partial aggregation first, so the shuffle
       carries at most one row per key and map task);
    2. keys holding more than ``hot_fraction`` of the left rows are hot; there
       can be at most ``1 / hot_fraction`` of them, so the hot-key set has a
       proven size bound; it is materialised and counted;
    3. the right rows of the hot keys are materialised and counted: within
       ``max_broadcast_rows`` they are broadcast and the hot left rows join
       them where they are (no shuffle of the hot rows); beyond it the hot
       part is a salted join: each hot left row gets one of
       ``salt_buckets`` salts and the hot right rows are replicated once per
       salt, so every hot key is spread over ``salt_buckets`` tasks;
    4. the other left rows join ``right`` normally; the union is the result.

    Exact for ``inner`` and ``left``: the split is by left key, and right
    rows of a hot key can only meet left rows of that key.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_split_join supports inner and left joins")
    keys = list(keys)
    if materialize_left:
        left = left.checkpoint(eager=True)
    total = left.count()
    if total == 0:
        return left.join(right, keys, how)
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    hot, n_hot = materialize_small(
        counts.where(F.col("__n") > F.lit(hot_fraction * total)).drop("__n"))
    if n_hot == 0:
        return left.join(right, keys, how)
    hot_b = F.broadcast(hot)  # at most 1 / hot_fraction rows
    left_hot = left.join(hot_b, keys, "left_semi")
    left_cold = left.join(hot_b, keys, "left_anti")
    right_hot, n_right_hot = materialize_small(right.join(hot_b, keys, "left_semi"))
    cold = left_cold.join(right, keys, how)
    if n_right_hot <= max_broadcast_rows and table_bytes(right_hot) <= MAX_BROADCAST_BYTES:
        hot_part = left_hot.join(F.broadcast(right_hot), keys, how)
    else:
        salted_left = left_hot.withColumn(
            "__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left_hot.columns]),
                             F.lit(salt_buckets)))
        salted_right = right_hot.withColumn(
            "__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salt_buckets - 1).cast("long"))))
        hot_part = salted_left.join(salted_right, keys + ["__salt"], how).drop("__salt")
    return cold.unionByName(hot_part)
