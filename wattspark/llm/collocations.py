"""Phrase collocations of two and three words, counted in direct-address tiles.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and into words at
blanks and tabs.  Everything is counted per language over all documents:

1. texts are encoded once, in blocks of some megabytes with a dictionary each; the
   dictionaries are added up, and the words seen ``least`` times or more are ranked by
   frequency (a phrase of rarer words can't be a candidate);
2. each block looks its words up (a join on its dictionary, no broadcast) and counts its
   neighbouring pairs of ranks.  The plane of pairs is cut into square tiles of ``TILE``
   ranks a side.  The tiles of the most frequent ranks are addressed directly and
   counted with dense ``bincount``; the thinly filled rest is kept as sorted
   coordinate lists, in hashed parts.  Blocks' counts are added tile by tile: a tile
   that all blocks meet is added in rounds of ``FAN_IN``, so no task holds more;
3. pairs seen ``least`` times or more are ranked by frequency in turn, looked up by
   the blocks, and (pair rank, word rank) counted in the same way, which gives
   three-word phrases of two frequent pairs;
4. candidates are scored in decimal arithmetic: ``floor(10^6 * a * a / (l * r))``, the
   lowest of the cuts, ties to the first.

Defined results:

* null or empty texts hold no word; a null language is ``und`` (one with a language of
  that name); an empty string is a language of its own;
* repeated rows count each time; document ids and other columns are not read;
* long texts are one block each, encoded piece by piece;
* score and frequency ties are ordered by the phrase's UTF-8 bytes;
* an empty table, or one without candidates, gives no rows;
* more than 2^30 ranked words or 2^33 ranked pairs of one language are refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checked_broadcast, hot_cold_join, materialize, sliced

#: Ranks a tile covers on each side (as bits), and tiles a side that are addressed directly.
TILE_BITS, HEAD = 10, 8
TILE = 1 << TILE_BITS
#: Bytes of text in a block, blocks whose tiles one task adds, and words per hashed part.
BLOCK_BYTES, FAN_IN, PART_WORDS = 4 << 20, 8, 4 << 20
NO_LANGUAGE = "und"

_SPLITS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(bytes(range(65, 91)) + _SPLITS + b"\t",
                         bytes(range(97, 123)) + b"\n" * len(_SPLITS) + b" ")
_CHUNK = 1 << 22


class _Codes(dict):
    """Numbers of the words of a block, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        out = self[word] = len(self)
        return out


def encode_text(text: bytes, codes: _Codes) -> list[np.ndarray]:
    """Codes of the words in order, -1 between pieces and at the end."""
    text = text.translate(_TABLE)
    out, at = [], 0
    while at < len(text):
        end = len(text)
        if end - at > _CHUNK:    # cut a long text where no word crosses
            cuts = [c for c in (text.find(b" ", at + _CHUNK), text.find(b"\n", at + _CHUNK))
                    if c >= 0]
            end = min(cuts, default=end)
        own: list[int] = []
        for piece in text[at:end].split(b"\n"):
            own += [codes[w] for w in piece.split()]
            own.append(-1)
        if end < len(text):
            own.pop()            # the last piece goes on
        out.append(np.array(own, np.int32))
        at = end
    return [*out, np.full(1, -1, np.int32)]


def encoded_blocks(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """``block``, ``lang``, ``words`` (distinct), ``counts`` and ``codes`` (int32 bytes)."""
    rows = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.col(f"`{text_col}`").alias("text")).filter(F.length("text") > 0)
    schema = "block long, lang string, words array<binary>, counts array<long>, codes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}      # codes, parts and bytes of a language's open block
        size, block = 0, TaskContext.get().partitionId() << 36

        def flush(langs: list[str]) -> Iterator[pa.RecordBatch]:
            nonlocal block, size
            for lang in langs:
                codes, parts, length = held.pop(lang)
                own = np.concatenate(parts)
                counts = np.bincount(own[own >= 0], minlength=len(codes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([lang]),
                     pa.array([list(codes)], pa.list_(pa.binary())),
                     pa.array([counts.tolist()], pa.list_(pa.int64())),
                     pa.array([own.tobytes()], pa.binary())],
                    names=["block", "lang", "words", "counts", "codes"])
                block += 1
                size -= length

        for batch in sliced(batches):
            for lang, text in zip(batch.column("lang"), batch.column("text").cast(pa.binary()),
                                  strict=True):
                text, lang = text.as_py(), lang.as_py()
                own = held.setdefault(lang, [_Codes(), [], 0])
                own[1] += encode_text(text, own[0])
                own[2] += len(text)
                size += len(text)
                if own[2] >= BLOCK_BYTES:
                    yield from flush([lang])
                elif size >= 4 * BLOCK_BYTES:      # many languages: all close early
                    yield from flush(list(held))
        yield from flush(list(held))

    return materialize(rows.mapInArrow(run, schema), "phrase-blocks")


def ranked(df: DataFrame, tie: list[str], name: str) -> DataFrame:
    """``df`` (with ``lang`` and ``f``) and its rank per language by falling ``f``, from 0.

    The rows are sorted over ranges; a row's rank is its place in its range and the rows
    of its language in the ranges before.  No task holds a language."""
    rows = (df.repartitionByRange("lang", F.desc("f"), *tie)
            .sortWithinPartitions("lang", F.desc("f"), *tie)
            .withColumn("at", F.monotonically_increasing_id()))
    rows = materialize(rows, name).withColumn("range", F.shiftright("at", 33))
    ranges = rows.groupBy("range", "lang").agg(F.count(F.lit(1)).alias("m"),
                                               F.min("at").alias("first"))
    before = Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = materialize(ranges.select("range", "lang", "first", F.coalesce(
        F.sum("m").over(before), F.lit(0)).alias("before")), f"{name}-ranges")
    rows = rows.join(checked_broadcast(ranges, ranges.count(), 64), ["range", "lang"])
    return materialize(rows.withColumn("rank", F.col("before") + F.col("at") - F.col("first"))
                       .drop("range", "first", "before", "at"), f"{name}-ranks")


def tile_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(tile row, tile column, row, column) of a pair of ranks, in one sortable number."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    low = TILE - 1
    return ((a >> TILE_BITS) << 40 | (b >> TILE_BITS) << 20 | (a & low) << TILE_BITS | b & low)


def key_ranks(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = TILE - 1
    return ((key >> 40) << TILE_BITS | key >> TILE_BITS & low,
            (key >> 20 & (1 << 20) - 1) << TILE_BITS | key & low)


def add_cells(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and their added counts."""
    if not len(keys):
        return keys, counts
    tile = int(keys.min()) >> 20
    cells = TILE * TILE
    if int(keys.max()) >> 20 == tile and 4 * len(keys) >= cells:      # one well-filled tile
        dense = np.bincount(keys & (cells - 1), counts, cells).astype(np.int64)
        at = np.flatnonzero(dense)
        return at | tile << 20, dense[at]
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


def count_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and counts of pairs of ranks: the first tile dense, the others sorted."""
    key = tile_key(a, b)
    near = key < TILE * TILE
    dense = np.bincount(key[near], minlength=1)
    at = np.flatnonzero(dense)
    rest, counts = np.unique(key[~near], return_counts=True)
    return np.concatenate([at, rest]), np.concatenate([dense[at], counts]).astype(np.int64)


def units_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Unit of work: the tile where both ranks are frequent, else a hashed part (negative)."""
    tile = keys >> 20
    head = ((tile >> 20) < HEAD) & ((tile & (1 << 20) - 1) < HEAD)
    mixed = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    return np.where(head, tile, -1 - (mixed % np.uint64(parts)).astype(np.int64))


def _pack(keys: np.ndarray) -> bytes:
    return np.diff(keys, prepend=0).tobytes()    # sorted: small steps compress well


def _unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.int64))


def _messages(keys: np.ndarray, counts: np.ndarray, parts: int) -> list[tuple]:
    """(unit, keys, counts) of a block's counts."""
    unit = units_of(keys, parts)
    order = np.argsort(unit, kind="stable")
    unit, keys, counts = unit[order], keys[order], counts[order]
    cut = np.flatnonzero(np.append(True, unit[1:] != unit[:-1])) if len(unit) else []
    return [(int(u[0]), _pack(k), c.tobytes()) for u, k, c in zip(
        np.split(unit, cut[1:]), np.split(keys, cut[1:]), np.split(counts, cut[1:]),
        strict=True)] if len(cut) else []


_BLOCK_SCHEMA = "block long, lang string, unit long, keys binary, counts binary, seq binary"


def _block_rows(block: int, lang: str, messages: list[tuple], seq: bytes | None) -> pa.Table:
    n = len(messages)
    units, keys, counts = map(list, zip(*messages, strict=True)) if n else ([], [], [])
    extra = 0 if seq is None else 1
    return pa.table({
        "block": pa.array([block] * (n + extra), pa.int64()),
        "lang": pa.array([lang] * (n + extra), pa.string()),
        "unit": pa.array(units + [None] * extra, pa.int64()),
        "keys": pa.array(keys + [None] * extra, pa.binary()),
        "counts": pa.array(counts + [None] * extra, pa.binary()),
        "seq": pa.array([None] * n + [seq] * extra, pa.binary())})


def _by_block(left: DataFrame, right: DataFrame, fn, schema: str, blocks: int) -> DataFrame:
    """Bring the parts of each block together; tasks grow in number with the blocks."""
    n = max(blocks // 4 + 1, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    right = right.withColumnRenamed("block", "of")    # both sides can come from one table
    return (left.repartition(n, "block").groupBy("block")
            .cogroup(right.repartition(n, "of").groupBy("of")).applyInArrow(fn, schema))


def pair_blocks(blocks: DataFrame, words: DataFrame, n_blocks: int, parts: int) -> DataFrame:
    """Each block's word ranks (``seq``, int32, -1 for breaks and rare words) and its
    counted pairs of ranks by unit."""
    named = (blocks.select("block", "lang", F.posexplode("words").alias("code", "word"))
             .join(words.select("lang", "word", "rank"), ["lang", "word"])
             .select("block", "code", "rank"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _block_rows(0, "", [], None)
        codes = np.frombuffer(left.column("codes")[0].as_py(), np.int32)
        rank = np.full(codes.max(initial=0) + 2, -1, np.int32)    # code -1 meets the last place
        rank[right.column("code").to_numpy()] = right.column("rank").to_numpy()
        seq = rank[codes]
        both = np.flatnonzero((seq[:-1] >= 0) & (seq[1:] >= 0))
        keys, counts = count_pairs(seq[both], seq[both + 1])
        return _block_rows(left.column("block")[0].as_py(), left.column("lang")[0].as_py(),
                           _messages(keys, counts, parts), seq.tobytes())

    return materialize(_by_block(blocks.select("block", "lang", "codes"), named, run,
                                 _BLOCK_SCHEMA, n_blocks), "phrase-pairs")


def triple_blocks(pairs: DataFrame, answers: DataFrame, n_blocks: int, parts: int) -> DataFrame:
    """Each block's counted (pair rank, word rank) by unit, where both pairs of the three
    words are ranked."""
    seqs = pairs.filter(F.col("seq").isNotNull()).select("block", "lang", "seq")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _block_rows(0, "", [], None)
        seq = np.frombuffer(left.column("seq")[0].as_py(), np.int32)
        known = np.concatenate([_unpack(k.as_py()) for k in right.column("keys")])
        rank = np.concatenate([np.frombuffer(r.as_py(), np.int64) for r in right.column("ranks")])
        order = np.argsort(known)
        known, rank = known[order], rank[order]
        pair = np.full(len(seq), -1, np.int64)
        both = np.flatnonzero((seq[:-1] >= 0) & (seq[1:] >= 0))
        key = tile_key(seq[both], seq[both + 1])
        at = np.minimum(np.searchsorted(known, key), len(known) - 1)
        pair[both] = np.where(known[at] == key, rank[at], -1)
        start = np.flatnonzero((pair[:-1] >= 0) & (pair[1:] >= 0))
        keys, counts = count_pairs(pair[start], seq[start + 2])
        return _block_rows(left.column("block")[0].as_py(), left.column("lang")[0].as_py(),
                           _messages(keys, counts, parts), None)

    return materialize(_by_block(seqs, answers, run, _BLOCK_SCHEMA, n_blocks), "phrase-triples")


def _salted(rows: DataFrame, key: Column, salts: int) -> DataFrame:
    """Tiles are met by every block: deal them over ``salts``; parts are not."""
    return rows.withColumn("salt", F.when(F.col("unit") >= 0, F.pmod(F.xxhash64(key), salts))
                           .otherwise(0).cast("long"))


def frequent_cells(rows: DataFrame, n_blocks: int, parts: int, least: int) -> DataFrame:
    """``lang``, ``unit``, ``a``, ``b`` (ranks) and ``f`` of the cells counted ``least`` times
    or more, from the blocks' messages."""
    shuffles = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.filter(F.col("unit").isNotNull())
    schema = "lang string, unit long, salt long, keys binary, counts binary"

    def cells(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return add_cells(
            np.concatenate([_unpack(k.as_py()) for k in table.column("keys")]),
            np.concatenate([np.frombuffer(c.as_py(), np.int64) for c in table.column("counts")]))

    def add(table: pa.Table) -> pa.Table:
        keys, counts = cells(table)
        one = table.slice(0, 1)
        return pa.table({"lang": one.column("lang"), "unit": one.column("unit"),
                         "salt": one.column("salt"), "keys": pa.array([_pack(keys)], pa.binary()),
                         "counts": pa.array([counts.tobytes()], pa.binary())})

    def finish(table: pa.Table) -> pa.Table:
        keys, counts = cells(table)
        often = counts >= least
        a, b = key_ranks(keys[often])
        n = len(a)
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * n, pa.string()),
                         "unit": pa.array([table.column("unit")[0].as_py()] * n, pa.int64()),
                         "a": pa.array(a), "b": pa.array(b), "f": pa.array(counts[often])})

    salts = max(1, -(-n_blocks // FAN_IN))
    names = ["lang", "unit", "salt", "keys", "counts"]
    tiles = _salted(rows, F.col("block"), salts).filter("unit >= 0").select(*names)
    while salts > 1:
        fewer = -(-salts // FAN_IN)
        tiles = (tiles.repartition(max(shuffles, salts), "lang", "unit", "salt")
                 .groupBy("lang", "unit", "salt").applyInArrow(add, schema)
                 .withColumn("salt", F.pmod(F.col("salt"), F.lit(fewer))))
        salts = fewer
    sparse = rows.filter("unit < 0").select(
        "lang", "unit", F.lit(0).cast("long").alias("salt"), "keys", "counts")
    return (tiles.unionByName(sparse)
            .repartition(max(shuffles, parts + HEAD * HEAD), "lang", "unit")
            .groupBy("lang", "unit")
            .applyInArrow(finish, "lang string, unit long, a long, b long, f long"))


def pair_answers(rows: DataFrame, pairs: DataFrame, n_blocks: int) -> DataFrame:
    """``block``, ``keys`` and ``ranks`` of the ranked pairs among each block's pairs."""
    shuffles = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(1, -(-n_blocks // (2 * FAN_IN)))

    def pack(table: pa.Table) -> pa.Table:
        keys = tile_key(table.column("a").to_numpy(), table.column("b").to_numpy())
        order = np.argsort(keys)
        one = table.slice(0, 1)
        rank = table.column("rank").to_numpy()[order]
        return pa.table({"lang": one.column("lang"), "unit": one.column("unit"),
                         "keys": pa.array([_pack(keys[order])], pa.binary()),
                         "ranks": pa.array([rank.astype(np.int64).tobytes()], pa.binary())})

    tables = pairs.groupBy("lang", "unit").applyInArrow(
        pack, "lang string, unit long, keys binary, ranks binary")
    last = F.when(F.col("unit") >= 0, salts - 1).otherwise(0).cast("long")
    tables = tables.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    asked = (_salted(rows.filter(F.col("unit").isNotNull()), F.col("block"), salts)
             .select("block", "lang", "unit", "salt", "keys"))

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        block, keys, ranks = [], [], []
        if right.num_rows:
            known = _unpack(right.column("keys")[0].as_py())
            rank = np.frombuffer(right.column("ranks")[0].as_py(), np.int64)
            for b, k in zip(left.column("block"), left.column("keys"), strict=True):
                own = _unpack(k.as_py())
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                hit = known[at] == own
                if hit.any():
                    block.append(b.as_py())
                    keys.append(_pack(own[hit]))
                    ranks.append(rank[at[hit]].tobytes())
        return pa.table({"block": pa.array(block, pa.int64()), "keys": pa.array(keys, pa.binary()),
                         "ranks": pa.array(ranks, pa.binary())})

    n, by = max(shuffles, n_blocks // 4 + 1), ["lang", "unit", "salt"]
    return (asked.repartition(n, *by).groupBy(*by)
            .cogroup(tables.repartition(n, *by).groupBy(*by))
            .applyInArrow(answer, "block long, keys binary, ranks binary"))


def _score(f: str, left: str, right: str) -> Column:
    """``floor(10^6 f f / (left right))`` in decimals of 38 digits."""
    d = lambda c: f"cast({c} as decimal(15,0))"
    return F.expr(f"(cast(1000000 as decimal(7,0)) * {d(f)} * {d(f)}) div ({d(left)} * {d(right)})")


def mine_phrases(docs: DataFrame, least: int = 10, top: int = 2000, inside_percent: int = 50,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The first ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``,
    ``r``, ``n``, ``score`` and ``cut`` (words before the cut).

    A pair inside a three-word candidate of at least ``inside_percent`` of its
    frequency is dropped."""
    blocks = encoded_blocks(docs, lang_col, text_col)
    counted = (blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
               .groupBy("lang", F.col("w.words").alias("word"))
               .agg(F.sum("w.counts").alias("f")))
    counted = materialize(counted, "phrase-words")
    sizes = materialize(counted.groupBy("lang").agg(F.sum("f").alias("n")), "phrase-sizes")
    words = ranked(counted.filter(F.col("f") >= least), ["word"], "phrase-vocabulary")
    n_blocks = blocks.count()
    total = sizes.agg(F.sum("n")).first()[0] or 0
    parts = max(1, total // PART_WORDS)

    first = pair_blocks(blocks, words, n_blocks, parts)
    pairs = ranked(frequent_cells(first, n_blocks, parts, least), ["a", "b"], "phrase-ranked")
    top_ranks = (words.agg(F.max("rank")).first()[0] or 0, pairs.agg(F.max("rank")).first()[0] or 0)
    if top_ranks[0] >= 1 << 30 or top_ranks[1] >= 1 << 33:
        raise ValueError(f"ranks do not fit the tile keys: {top_ranks}")
    answers = pair_answers(first, pairs, n_blocks)
    second = triple_blocks(first, answers, n_blocks, parts)
    triples = materialize(frequent_cells(second, n_blocks, parts, least)
                          .select("lang", F.col("a").alias("pair"), F.col("b").alias("c"),
                                  F.col("f").alias("f3")), "phrase-triple-counts")

    def side(name: str) -> DataFrame:
        return words.select("lang", F.col("rank").alias(name), F.col("f").alias(f"f_{name}"),
                            F.col("word").alias(f"word_{name}"))

    # a word's rows here are at most a tenth of its occurrences: the most frequent words are
    # joined by broadcast, the others by shuffle
    named = pairs.select("lang", "a", "b", "f", F.col("rank").alias("pair"))
    named = materialize(hot_cold_join(named, side("a"), ["lang", "a"], "f_a", total), "phrase-first")
    named = materialize(hot_cold_join(named, side("b"), ["lang", "b"], "f_b", total), "phrase-named")
    start = named.select("lang", "pair", "a", "b", F.col("f").alias("f_ab"), "f_a", "word_a", "word_b")
    whole = materialize(hot_cold_join(triples, start, ["lang", "pair"], "f_ab", total),
                        "phrase-starts")
    end = named.select("lang", F.col("a").alias("b"), F.col("b").alias("c"), F.col("f").alias("f_bc"),
                       F.col("f_b").alias("f_c"), F.col("word_b").alias("word_c"),
                       F.col("pair").alias("last_pair"))
    whole = materialize(hot_cold_join(whole, end, ["lang", "b", "c"], "f_bc", total), "phrase-wholes")

    covers = (whole.select("lang", "pair", "f3")
              .unionByName(whole.select("lang", F.col("last_pair").alias("pair"), "f3"))
              .groupBy("lang", "pair").agg(F.max("f3").alias("f3")))
    two = (named.join(covers, ["lang", "pair"], "left")
           .filter(F.col("f3").isNull() | (100 * F.col("f3") < inside_percent * F.col("f")))
           .select("lang", F.concat_ws(" ", F.col("word_a").cast("string"),
                                       F.col("word_b").cast("string")).alias("phrase"),
                   F.col("f").alias("a"), F.col("f_a").alias("l"), F.col("f_b").alias("r"),
                   _score("f", "f_a", "f_b").alias("score"), F.lit(1).alias("cut")))
    three = whole.withColumns({"s1": _score("f3", "f_a", "f_bc"), "s2": _score("f3", "f_ab", "f_c")})
    late = F.col("s2") < F.col("s1")
    three = three.select(
        "lang", F.concat_ws(" ", *[F.col(f"word_{k}").cast("string") for k in "abc"]).alias("phrase"),
        F.col("f3").alias("a"), F.when(late, F.col("f_ab")).otherwise(F.col("f_a")).alias("l"),
        F.when(late, F.col("f_c")).otherwise(F.col("f_bc")).alias("r"),
        F.least("s1", "s2").alias("score"), F.when(late, 2).otherwise(1).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = (two.unionByName(three).withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= top))     # Spark limits each task to `top` rows a language
    return best.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "cut")
