"""Repeated passages by seed and extend on winnowed anchors.

Seeds: every run of ``length`` words (a window) picks one anchor, the word
k-gram of smallest hash in it (the rightmost of equals).  Equal windows pick
equal anchors, so two repeats always share one.  Consecutive windows with the
same anchor are one seed; its context is all words of these windows.

Extend: only anchors found in two places matter.  Seeds with equal contexts
match to their full extent on both sides; they are counted, not compared in
pairs.  Where an anchor has several contexts, a match may end inside one:
one seed of each such context is extended window by window against the
others, by joining the windows' 128-bit digests.  The union of the matched
windows of a document is its maximal repeats.

Repeated windows are removed with all words they cover, judged on the input.

Cases: a null or blank text has no words; a text shorter than a window repeats
nothing; repeated rows repeat each other; a run of one word repeats itself
inside its text; an empty table gives an empty result; extra columns are
ignored whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hot_cold_join, materialize

LENGTH = 35
ANCHOR_WORDS = 8
#: Odd multipliers of the two polynomial digests (arithmetic modulo 2**64).
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Distinct words a task remembers the hash of.
WORD_CACHE = 1 << 20

SEEDS = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("id_hash", T.LongType()),
    T.StructField("text_hash", T.LongType()),
    T.StructField("anchors", T.ArrayType(T.LongType())),
    T.StructField("contexts", T.ArrayType(T.LongType())),
    T.StructField("firsts", T.ArrayType(T.IntegerType())),
    T.StructField("counts", T.ArrayType(T.IntegerType()))])


class Digests:
    """Polynomial digests of word runs, from 64-bit word hashes."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {}
        self.powers = [np.ones(1, np.uint64) for _ in BASES]
        self.inverse = [np.ones(1, np.uint64) for _ in BASES]

    def hashes(self, words: list[bytes]) -> np.ndarray:
        if len(self.words) > WORD_CACHE:
            self.words.clear()
        known, digest = self.words, xxhash.xxh64_intdigest
        out = np.empty(len(words), np.uint64)
        for k, w in enumerate(words):
            h = known.get(w)
            if h is None:
                h = known[w] = digest(w)
            out[k] = h
        return out

    def prefix(self, hashes: np.ndarray, which: int) -> np.ndarray:
        """Running sums ``sum(h[i] * base**i)``, one more than words."""
        n = len(hashes)
        if len(self.powers[which]) < n:
            size = max(n, 2 * len(self.powers[which]))
            base = BASES[which]
            for table, b in ((self.powers, base), (self.inverse, pow(base, -1, 1 << 64))):
                grown = np.full(size, b, np.uint64)
                grown[0] = 1
                table[which] = np.cumprod(grown, dtype=np.uint64)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * self.powers[which][:n], out=out[1:], dtype=np.uint64)
        return out

    def runs(self, prefix: np.ndarray, start: np.ndarray, length, which: int) -> np.ndarray:
        """Digests of the runs of ``length`` words at ``start``; equal runs have equal digests."""
        return (prefix[start + length] - prefix[start]) * self.inverse[which][start]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of a digest, so that its order is that of a hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def picked_anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` k-grams the place of its smallest (rightmost of equals)."""
    n = len(grams) - width + 1
    best, place = grams[:n].copy(), np.arange(n)
    for k in range(1, width):
        other = grams[k:n + k]
        better = other <= best
        np.copyto(best, other, where=better)
        np.copyto(place, np.arange(k, n + k), where=better)
    return place


def seeds_of(words: list[bytes], digests: Digests, length: int, k: int) -> tuple[np.ndarray, ...]:
    """Anchor, context digest, first window and number of windows of each seed of a text."""
    prefix = digests.prefix(digests.hashes(words), 0)
    n = len(words)
    grams = _mixed(digests.runs(prefix, np.arange(n - k + 1), k, 0))
    place = picked_anchors(grams, length - k + 1)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    count = np.diff(first, append=len(place))
    context = _mixed(digests.runs(prefix, first, count - 1 + length, 0))
    return grams[place[first]], context, first, count


def find_seeds(docs: DataFrame, length: int = LENGTH, k: int = ANCHOR_WORDS,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row with its seeds as arrays (written once: ``row`` is then fixed)."""
    if not 0 < k <= length:
        raise ValueError("an anchor has at least one word and at most a window's")
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.xxhash64(F.col(f"`{id_col}`")).alias("id_hash"),
                       F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"),
                       text.cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = Digests()
        no = TaskContext.get().partitionId() << 36
        for batch in batches:
            found: list[list] = [[], [], [], []]
            for t in batch.column("text"):
                words = (t.as_py() or b"").split()
                parts = (seeds_of(words, digests, length, k) if len(words) >= length
                         else [np.empty(0, np.uint64)] * 4)
                for col, x in zip(found, parts, strict=True):
                    col.append(x)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in found[0]])]).astype(np.int32)
            arrays = []
            for col, kind in zip(found, (np.int64, np.int64, np.int32, np.int32), strict=True):
                flat = np.concatenate([x.view(np.int64) if kind is np.int64 else x.astype(kind)
                                       for x in col])
                arrays.append(pa.ListArray.from_arrays(offsets, pa.array(flat)))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(no, no + n)), batch.column("id_hash"),
                 batch.column("text_hash"), *arrays], names=SEEDS.names)
            no += n

    return materialize(rows.mapInArrow(run, SEEDS), "substring-seeds")


def _context_windows(docs: DataFrame, reps: DataFrame, length: int, id_col: str,
                     text_col: str) -> DataFrame:
    """Windows of one seed per open context: (``w1``, ``w2``, seed ``row``/``first``, ``start``,
    ``uses``).  ``reps`` has a row per document key with its seeds as an array."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.xxhash64(F.col(f"`{id_col}`")).alias("id_hash"),
                       F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"),
                       text.cast("binary").alias("text"))
    rows = rows.join(reps, ["id_hash", "text_hash"]).select("text", "seeds")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = Digests()
        for batch in batches:
            out: list[list[np.ndarray]] = [[] for _ in range(5)]
            for text, seeds in zip(batch.column("text"), batch.column("seeds"), strict=True):
                words = (text.as_py() or b"").split()
                h = digests.hashes(words)
                prefixes = [digests.prefix(h, which) for which in (0, 1)]
                own = seeds.values
                first = own.field("first").to_numpy()
                count = own.field("count").to_numpy().astype(np.int64)
                start = np.repeat(first, count) + (
                    np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
                for col, x in zip(out, (
                        digests.runs(prefixes[0], start, length, 0).view(np.int64),
                        digests.runs(prefixes[1], start, length, 1).view(np.int64),
                        np.repeat(own.field("row").to_numpy(), count), start.astype(np.int32),
                        np.repeat(own.field("uses").to_numpy(), count)), strict=True):
                    col.append(x)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out],
                                                 names=["w1", "w2", "row", "start", "uses"])

    return rows.mapInArrow(run, "w1 long, w2 long, row long, start int, uses long")


def repeated_spans(docs: DataFrame, length: int = LENGTH, k: int = ANCHOR_WORDS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Word spans covered by repeated windows: one row per distinct (``id_hash``,
    ``text_hash``) that has any, with ``spans``, an array of (``start``, ``end``)."""
    table = find_seeds(docs, length, k, id_col, text_col)
    seeds = table.select("row", F.inline(F.arrays_zip(
        F.col("anchors").alias("anchor"), F.col("contexts").alias("context"),
        F.col("firsts").alias("first"), F.col("counts").alias("count"))))
    twice = (seeds.groupBy("anchor").agg(F.count(F.lit(1)).alias("places"))
             .filter("places > 1"))
    twice = materialize(twice, "substring-twice")
    places = table.agg(F.coalesce(F.sum(F.size("anchors")), F.lit(0)).alias("n")).first()["n"]
    met = materialize(hot_cold_join(seeds, twice, ["anchor"], "places", places).drop("places"),
                      "substring-met")
    context = ["anchor", "context", "count"]
    classes = materialize(met.groupBy(*context).agg(
        F.count(F.lit(1)).alias("uses"), F.min(F.struct("row", "first")).alias("rep")),
        "substring-classes")
    # anchors with several contexts: a match may cover a part of a context
    several = (classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("classes"))
               .filter("classes > 1"))
    several = materialize(several, "substring-several")
    total = classes.count()
    opened = hot_cold_join(classes, several, ["anchor"], "classes", total).select(
        "rep.row", "rep.first", "count", "uses")
    keys = table.select("row", "id_hash", "text_hash")
    reps = (opened.join(keys, "row").groupBy("id_hash", "text_hash")
            .agg(F.collect_list(F.struct("row", "first", "count", "uses")).alias("seeds")))
    windows = materialize(_context_windows(docs, materialize(reps, "substring-reps"), length,
                                           id_col, text_col), "substring-windows")
    again = (windows.groupBy("w1", "w2").agg(F.sum("uses").alias("uses"),
                                             F.count(F.lit(1)).alias("rows"))
             .filter("uses > 1").select("w1", "w2", "rows"))
    again = materialize(again, "substring-again")
    partial = hot_cold_join(windows.filter("uses = 1").select("w1", "w2", "row", "start"), again,
                            ["w1", "w2"], "rows", windows.count()).select(
        "row", "start", (F.col("start") + length).alias("end"))
    whole = classes.filter("uses > 1").select(*context, "uses")
    full = hot_cold_join(met, whole, context, "uses", met.count()).select(
        "row", F.col("first").alias("start"),
        (F.col("first") + F.col("count") - 1 + length).cast("int").alias("end"))
    spans = full.unionByName(partial).join(keys, "row")
    spans = spans.select("id_hash", "text_hash", "start", "end").distinct()
    return materialize(spans.groupBy("id_hash", "text_hash").agg(
        F.collect_list(F.struct("start", "end")).alias("spans")), "substring-spans")


def remove_repeats(docs: DataFrame, length: int = LENGTH, k: int = ANCHOR_WORDS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words``, ``n_removed`` and ``kept_text``
    (the words that stay, joined by one space)."""
    spans = repeated_spans(docs, length, k, id_col, text_col)
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       F.xxhash64(F.col(f"`{id_col}`")).alias("id_hash"),
                       F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"),
                       text.cast("binary").alias("text"))
    rows = rows.join(spans, ["id_hash", "text_hash"], "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = (text.as_py() or b"").split()
                n = len(words)
                n_words.append(n)
                if spans.is_valid:
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, spans.values.field("start").to_numpy(), 1)
                    np.add.at(edge, spans.values.field("end").to_numpy(), -1)
                    stay = np.flatnonzero(np.cumsum(edge[:n]) == 0)
                    words = [words[i] for i in stay.tolist()]
                n_removed.append(n - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()),
                 pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept_text string")
