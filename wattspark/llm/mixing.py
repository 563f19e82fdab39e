"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks.

The documents of each source are put in a seeded order; their words form the
source's line, repeated up to ``max_epochs`` times.  The mix has at least
about ``blocks`` blocks of equal length, cut from these lines; blocks are so
short that the smallest target has ``LEAST_BLOCKS`` of them (one word, if it
has fewer words).  Each block in turn
goes to the source with the highest quotient ``target / (2 * blocks_so_far + 1)``
(Sainte-Lague), so every shard, a run of consecutive awards, has an integer
quota of blocks per source.  A source's blocks come from the front of its
seeded line, so exactly one document per source can be cut; a seeded permutation
of them tells which blocks fill which shard's quota.

Targets: each source gets its weight's share of all words; a target stops at
``max_epochs`` times the source's size and the excess is shared again by
weight, until none is above.  This is the level ``w * L`` at which
``sum(min(cap, w * L))`` equals all words, found from a sorted prefix sum.

Cases: a null text has size 0; null sources are one source, last in order;
ties in the seeded order (repeated rows) are broken by id and size, and rows
equal in all of them are interchangeable; a source without words has target 0;
an empty table gives an empty result; extra columns are kept by ``mix_rows``
(a result column replaces an input column of its name).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import (
    checked_broadcast,
    hot_cold_join,
    materialize,
    numbered,
    order_key,
    own_names,
    word_count,
    words_column,
)

MAX_EPOCHS = 3
BLOCKS = 8192
#: Blocks that the smallest target has at least, unless a block is one word.
LEAST_BLOCKS = 64
SHARDS = 64
WEIGHTS = (1, 2, 3)
SEED = 17


def source_targets(totals: DataFrame, weight: Column, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of the sources in ``totals`` (``source``, ``source_size``), which has one row
    per source; the windows below run over sources, not documents."""
    t = totals.withColumn("w", weight.cast("double")).withColumn(
        "cap", (F.col("source_size") * max_epochs).cast("double"))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumns({
        "all_words": F.sum("source_size").over(everything).cast("double"),
        "caps_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "w_from": F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))})
    # the level if this source and all later ones (by cap / w) stay below their caps; the
    # first source for which that holds has the highest such level
    t = t.withColumn("level", (F.col("all_words") - F.col("caps_before")) / F.col("w_from"))
    level = F.max(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))).over(everything)
    return t.select("source", "source_size", "all_words",
                    F.least(F.col("cap"), F.coalesce(level, F.lit(0.0)) * F.col("w")).alias("target"))


def block_quotas(targets: DataFrame, blocks: int = BLOCKS, shards: int = SHARDS,
                 max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Award the blocks one by one: rows (``source``, ``shard``, ``blocks``, ``block_words``).

    The awards up to each shard's end are counted without listing them: a source surely has
    those with quotients above the highest divisor possible, and only its next few bids, up
    to the lowest one, are ranked (about three per source, however many blocks there are).
    """
    t = targets.withColumn("block_words", F.greatest(
        F.ceil(F.col("all_words") / blocks), F.lit(1)).cast("long"))
    t = t.withColumn("seats", F.round(F.col("all_words") / F.col("block_words")).cast("long"))
    t = t.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy()))
    t = t.withColumn("cap", F.ceil(F.col("source_size") * max_epochs / F.col("block_words")))
    t = t.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    t = t.withColumn("turns", F.ceil((F.col("shard") + 1) * F.col("seats") / shards).cast("long"))
    every = F.greatest(F.col("all_words"), F.lit(1.0))
    # the divisor is between all_words / (turns + sources / 2) and / (turns - sources / 2)
    most = F.least(F.ceil(F.col("target") * (F.col("turns") + F.col("n") / 2) / every + 0.5),
                   F.col("cap")).cast("long")
    sure = F.floor(F.col("target") * (F.col("turns") - F.col("n") / 2) / every + 0.5)
    t = t.withColumn("most", most).filter("most > 0").withColumn(
        "sure", F.greatest(F.lit(0), F.least(sure, F.col("most"))).cast("long"))
    first = F.when(F.col("most") > F.col("sure"), F.sequence("sure", F.col("most") - 1))
    bids = t.select("source", "shard", "target", "block_words", "turns", "sure",
                    F.explode_outer(first).alias("j"))
    bids = bids.withColumn("q", F.col("target") / (2 * F.col("j") + 1))
    in_turn = Window.partitionBy("shard").orderBy(
        F.desc_nulls_last("q"), F.col("source").asc_nulls_last(), "j")
    own = F.row_number().over(Window.partitionBy("shard", "source").orderBy("j"))
    bids = bids.withColumn("once", F.when(own == 1, F.col("sure")).otherwise(0))
    left = F.col("turns") - F.sum("once").over(Window.partitionBy("shard"))
    won = (F.row_number().over(in_turn) <= left) & F.col("j").isNotNull()
    upto = (bids.withColumn("won", won.cast("long")).groupBy("source", "shard", "block_words")
            .agg((F.max("sure") + F.sum("won")).alias("upto")))
    before = F.lag("upto", 1, 0).over(Window.partitionBy("source").orderBy("shard"))
    return (upto.withColumn("blocks", (F.col("upto") - before).cast("long")).drop("upto")
            .filter("blocks > 0"))


def mix_rows(docs: DataFrame, weights: Sequence[float] = WEIGHTS, *, size: Column | None = None,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             max_epochs: int = MAX_EPOCHS, blocks: int = BLOCKS, shards: int = SHARDS,
             seed: int = SEED) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``,
    ``taken`` (words the mix takes, repeats counted), ``start`` (its place in the
    source's line), ``drawn`` (words of the line the mix takes), ``block`` (of its first
    word, null if the mix does not reach it), ``shard`` (whose quota holds that block)
    and ``text_hash``.

    Sources by code point weigh ``weights`` in turn, repeating.
    """
    size = word_count(F.col(text_col)) if size is None else size
    rows = materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        size.alias("size"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash")), "mix-rows")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"),
                                        F.count(F.lit(1)).alias("rows"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (nth % len(weights) + 1).cast("int"))
    totals = materialize(totals, "mix-totals")
    targets = source_targets(totals.drop("rows"), weight, max_epochs)
    least = targets.agg(F.max("all_words").alias("n"), F.min(F.when(
        F.col("target") > 0, F.col("target"))).alias("target")).first()
    if least["target"]:
        blocks = max(blocks, math.ceil(least["n"] / max(1, least["target"] // LEAST_BLOCKS)))
    # per source: its shards in order with the awards up to each one's end (at most `shards`)
    quotas = (block_quotas(targets, blocks, shards, max_epochs).groupBy("source")
              .agg((F.sum("blocks") * F.max("block_words")).alias("drawn"),
                   F.max("block_words").alias("block_words"), F.sum("blocks").alias("won"),
                   F.sort_array(F.collect_list(F.struct("shard", "blocks"))).alias("quotas")))
    plan = (targets.alias("t").join(quotas.alias("q"),
                                    F.col("t.source").eqNullSafe(F.col("q.source")), "left")
            .select("t.source", "t.source_size", "t.target", F.least(
                F.coalesce("q.drawn", F.lit(0)), F.col("t.source_size") * max_epochs)
                .cast("long").alias("drawn"), "q.block_words", "q.won", "q.quotas"))
    counts = totals.select(F.col("source").alias("s2"), "rows")
    plan = materialize(plan.join(counts, F.col("source").eqNullSafe(F.col("s2")))
                       .select(F.struct("source").alias("key"), "source_size", "target", "drawn",
                               "block_words", "won", "quotas", "rows"), "mix-plan")
    total = rows.count()
    spread = order_key(F.lit(seed), F.col("doc_id"), F.col("text_hash"))
    placed = numbered(rows, ["source"], [F.col("doc_id"), F.col("text_hash")], spread,
                      "start", total, F.col("size"))
    placed = materialize(placed.withColumn("key", F.struct("source")), "mix-placed")
    out = hot_cold_join(placed, plan, ["key"], "rows", total).drop("key", "rows")
    taken = sum((_pass_words(r) for r in range(max_epochs)), F.lit(0).cast("long"))
    block = F.when(F.col("start") < F.col("drawn"), F.floor(F.col("start") / F.col("block_words")))
    out = out.withColumns({"taken": taken.cast("long"), "block": block.cast("long")})
    return out.withColumn("shard", shard_of(F.col("block"), F.col("won"), F.col("quotas"), seed)
                          ).drop("block_words", "won", "quotas")


#: A prime that steps through a source's blocks in seeded order.
STEP = 2_654_435_761


def shard_of(block: Column, won: Column, quotas: Column, seed: int) -> Column:
    """The shard whose quota holds a block: blocks are permuted by ``(STEP * block + seed) mod
    won``, and the shards take as many of that order as their quotas say, one after another."""
    place = F.pmod(block * F.lit(STEP) + F.lit(seed), won)
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(None).cast("int").alias("shard"))
    found = F.aggregate(quotas, start, lambda acc, q: F.struct(
        (acc["end"] + q["blocks"]).alias("end"),
        F.when(acc["shard"].isNull() & (place < acc["end"] + q["blocks"]), q["shard"])
        .otherwise(acc["shard"]).alias("shard")))
    return found["shard"]


def _pass_words(r: int) -> Column:
    """Words of the document that pass ``r`` over its source's line takes."""
    room = F.col("drawn") - r * F.col("source_size") - F.col("start")
    return F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), room))


@own_names
def mix_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, *, id_col: str = "doc_id",
                  text_col: str = "text", chars_col: str | None = "n_chars",
                  max_epochs: int = MAX_EPOCHS, **how) -> DataFrame:
    """The mixed documents, all input columns: one row per pass that takes the document.

    A whole document keeps its text; a document cut by the end of its source's
    draw keeps its first words, joined by one space.
    """
    plan = mix_rows(docs, weights, id_col=id_col, text_col=text_col, max_epochs=max_epochs, **how)
    plan = materialize(plan.select(
        F.xxhash64("doc_id").alias("__k"), F.col("text_hash").alias("__h"),
        F.col("size").alias("__size"), F.col("start").alias("__start"),
        F.array(*[_pass_words(r) for r in range(max_epochs)]).alias("__takes")),
        "mix-plan-rows")
    keys = ["__h", "__k"]
    repeated = plan.groupBy(*keys).count().filter("count > 1").select(*keys)
    repeated = materialize(repeated, "mix-repeated")
    n = repeated.count()
    rows = docs.withColumns({
        "__h": F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), "__k": F.xxhash64(id_col)})
    if n:
        # repeated rows are matched to their places one by one
        few = checked_broadcast(repeated, n, 32)
        nth = F.row_number().over(Window.partitionBy(*keys).orderBy("__size"))
        first = F.row_number().over(Window.partitionBy(*keys).orderBy("__start"))
        many = (rows.join(few, keys, "left_semi").withColumn("__size", F.lit(0))
                .withColumn("__nth", nth).drop("__size")
                .join(plan.join(few, keys, "left_semi").withColumn("__nth", first),
                      [*keys, "__nth"]).drop("__nth"))
        rows = (rows.join(few, keys, "left_anti").join(plan.join(few, keys, "left_anti"), keys)
                .unionByName(many))
    else:
        rows = rows.join(plan, keys)
    rows = rows.select("*", F.explode("__takes").alias("__take")).filter("__take > 0")
    text = F.when(F.col("__take") == F.col("__size"), F.col(text_col)).otherwise(
        F.array_join(F.slice(words_column(F.col(text_col)), 1, F.col("__take").cast("int")), " "))
    out = rows.withColumn(text_col, text)
    if chars_col and chars_col in docs.columns:
        out = out.withColumn(chars_col, F.length(text_col).cast(docs.schema[chars_col].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
