"""Scoring texts with a weighted backoff automaton of smoothed word n-grams.

Counts: all n-grams of all training texts are counted on Spark.  Unigrams get
add-one probabilities over the training vocabulary and one unknown token.
Every n-gram of two and more tokens seen at least ``MIN_COUNT`` times is an
arc, whatever the input's size (``share`` can raise that bar).  Arcs have the
absolutely discounted probability ``(c - discount) / c(context)``; a context's
failure arc carries the backoff weight that makes its probabilities sum to one.

Automaton: states are contexts.  A token follows its arc from the current
state, or failure arcs to shorter contexts until one has it.  No process holds
the whole automaton.  Texts are encoded once, in blocks with a dictionary
each, in a table bucketed by block, so it is never shuffled.  Then one round
per n-gram length: a block sends each of its distinct n-grams once, as (number
of the context, number of the word), to the owner of the context, which sums
the blocks' training counts, numbers the n-grams that are arcs, and answers
with their counts and numbers and with each context's number of arcs, sum of
counts and sum of the shorter n-grams' counts, all that its failure weight
needs.  An n-gram is sent only if the two n-grams one token shorter inside it
are arcs (words: seen often enough), for else it cannot be one.  Answers are
appended to a table bucketed like the blocks, so each crosses a shuffle once.
The shuffle files of the messages are removed before the answers cross theirs,
and the words' hashes, most of a block beside its tokens, after the first round.

A block thus gets all arcs, states and failure weights that its texts can
reach.  It builds that part of the automaton as arrays and traverses its texts
left to right, many places at once: texts are cut into runs, each of which
first reads the tokens before it that decide its state.  Texts longer than a
block are cut over blocks in the same way.

A frequent n-gram has one entry per block, not per occurrence.  Words are told
apart by 64-bit hashes (5e9 distinct ones make 0.7 equal pairs in the mean).

Cases: a null text counts as empty and has one token, its end; a null id
counts as training; a token unseen in training has count 0; without training
texts every token has probability 1; repeated rows are texts of their own; an
empty table gives an empty result; extra columns are ignored whatever their
names.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspark.session import scratch_path

from .common import materialize, sliced

ORDER = 3
#: Least count of an n-gram of two and more tokens that is an arc.
MIN_COUNT = 2
DISCOUNT = 0.5
#: Text bytes of a block, whose distinct n-grams are looked up once.
BLOCK_BYTES = 12 << 20
#: Tokens of the input per owner of n-grams, and tokens of a run of the traversal.
RANGE_TOKENS, RUN = 1 << 21, 256
#: The end token and the start of a text; white space is in no word.
END, START = b"\n", b"\n\n"
#: Distinct keys a task counts before it passes them on, and most buckets of the blocks.
COUNTER_KEYS, MAX_BUCKETS = 1 << 18, 99_999


def held_out(id_column: Column) -> Column:
    """Whether a text is kept from training: crc32 of its id as text, modulo 7, is 2."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def tokens(text: bytes | None) -> list[bytes]:
    return [*(text or b"").lower().split(), END]


def unigram_counts(train: DataFrame) -> DataFrame:
    """(``word``, ``c``) of all training tokens; ``train`` has a binary column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(
                list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in sliced(batches):
            for text in batch.column("text"):
                counts.update(tokens(text.as_py()))
                if len(counts) >= COUNTER_KEYS:
                    yield rows()
                    counts.clear()
        yield rows()

    return (train.select("text").mapInArrow(run, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("c")))


def _extended(train: DataFrame, ids: dict[bytes, int], levels: list[np.ndarray]) -> DataFrame:
    """Counts (``key``, ``n``) of the n-grams one token longer than ``levels[-1]``.

    ``levels[m]`` holds the sorted keys of the frequent (m + 2)-grams; a key is
    ``place of the first part among its level * len(ids) + last word``.
    """
    size = len(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        held_n: list[np.ndarray] = []

        def rows():
            keys, back = np.unique(np.concatenate(held), return_inverse=True)
            n = np.bincount(back, weights=np.concatenate(held_n), minlength=len(keys))
            held.clear()
            held_n.clear()
            return keys, n.astype(np.int64)

        for batch in sliced(batches):
            find = ids.get
            found = [ids[START]]
            for text in batch.column("text"):
                found += [find(w, -1) for w in tokens(text.as_py())]
                found.append(ids[START])
            word = np.array(found, np.int64)
            place = word  # of the gram that ends here, among the frequent of its length
            for level in levels:
                place = _places(place, word, level, size)
            last, after = place[:-1], word[1:]
            ok = (last >= 0) & (after >= 0) & (after != ids[START])
            keys, n = np.unique(last[ok] * size + after[ok], return_counts=True)
            held.append(keys)
            held_n.append(n)
            if sum(map(len, held)) >= COUNTER_KEYS:
                keys, n = rows()
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["key", "n"])
        if held:
            keys, n = rows()
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["key", "n"])

    return (train.select("text").mapInArrow(run, "key long, n long")
            .groupBy("key").agg(F.sum("n").alias("n")))


def _places(place: np.ndarray, word: np.ndarray, level: np.ndarray, size: int) -> np.ndarray:
    """Places in ``level`` of the grams ending at each token, from those one token shorter."""
    out = np.full(len(word), -1, np.int64)
    if len(level) and len(word) > 1:
        ok = (place[:-1] >= 0) & (word[1:] >= 0)
        keys = np.where(ok, place[:-1] * size + word[1:], -1)
        at = np.minimum(np.searchsorted(level, keys), len(level) - 1)
        out[1:] = np.where(ok & (level[at] == keys), at, -1)
    return out


class Automaton:
    """States ``(arcs, failure state, failure weight)``; state 0 is the empty context.

    An arc maps a token to (log10 probability, next state, log10 unigram probability).
    """

    def __init__(self, unigrams: dict[bytes, int], grams: list[dict[tuple, int]], total: int,
                 vocabulary: int, texts: int, discount: float = DISCOUNT):
        self.unseen = 1.0 / (total + vocabulary + 1) if total else 1.0
        self.single = {w: (c + 1) * self.unseen for w, c in unigrams.items()}
        count: dict[tuple, int] = {(w,): c for w, c in unigrams.items()} | {(START,): texts}
        following: dict[tuple, dict[bytes, int]] = {}
        for level in grams:
            for gram, c in level.items():
                count[gram] = c
                following.setdefault(gram[:-1], {})[gram[-1]] = c
        self.number = {(): 0} | {h: k + 1 for k, h in enumerate(
            sorted(following, key=lambda h: (len(h), h)))}
        self.prob: list[dict[bytes, float]] = [self.single]
        self.fail, self.weight = [-1], [1.0]
        for context in list(self.number)[1:]:
            back = self.number[self._known(context[1:])]
            own = {w: (c - discount) / count[context] for w, c in following[context].items()}
            rest = 1.0 - sum(self.probability(back, w) for w in own)
            self.prob.append(own)
            self.fail.append(back)
            self.weight.append((1.0 - sum(own.values())) / rest)
        log = math.log10
        self.states = []
        for context, k in self.number.items():
            arcs = {}
            for w, p in self.prob[k].items():
                arcs[w] = (log(p), self.number[self._known((*context, w))], log(self.single[w]))
            self.states.append((arcs, self.fail[k], log(self.weight[k]) if k else 0.0))
        self.start = self.number[self._known((START,))]

    def _known(self, context: tuple) -> tuple:
        while context not in self.number:
            context = context[1:]
        return context

    def probability(self, state: int, word: bytes) -> float:
        scale = 1.0
        while state >= 0:
            p = self.prob[state].get(word)
            if p is not None:
                return scale * p
            scale *= self.weight[state]
            state = self.fail[state]
        return scale * self.unseen


def traverse(words: list[bytes], states: list[tuple], start: int) -> tuple[float, float, list[bytes]]:
    """Log probabilities (model, unigram) of the tokens the automaton has, and the others."""
    total = base = 0.0
    rare: list[bytes] = []
    arcs, fail, weight = states[start]
    for w in words:
        hit = arcs.get(w)
        while hit is None and fail >= 0:
            total += weight
            arcs, fail, weight = states[fail]
            hit = arcs.get(w)
        if hit is None:
            rare.append(w)
        else:
            total += hit[0]
            base += hit[2]
            arcs, fail, weight = states[hit[1]]
    return total, base, rare


def train_automaton(train: DataFrame, order: int = ORDER, share: float = 0.0,
                    discount: float = DISCOUNT) -> tuple[Automaton, DataFrame, int]:
    """Count the training texts (binary column ``text``): automaton, unigram table, tokens.

    The automaton in one process: for small texts and to compare ``score_texts`` with.
    ``share`` leaves out arcs under that share of the tokens.
    """
    table = materialize(unigram_counts(train), "lm-unigrams")
    head = table.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"),
                     F.coalesce(F.sum(F.when(F.col("word") == F.lit(END), F.col("c"))),
                                F.lit(0)).alias("texts")).first()
    total, bar = head["n"], max(float(MIN_COUNT), share * head["n"])
    # at most 1 / share words and n-grams reach the bar
    frequent = {bytes(r.word): r.c for r in table.filter(F.col("c") >= bar).collect()}
    words = [*sorted(frequent), START]
    ids = {w: k for k, w in enumerate(words)}
    levels: list[np.ndarray] = []
    grams: list[dict[tuple, int]] = []
    known = [(w,) for w in words]
    for _ in range(2, order + 1):
        rows = _extended(train, ids, levels).filter(F.col("n") >= bar).orderBy("key").collect()
        levels.append(np.array([r.key for r in rows], np.int64))
        found = {(*known[r.key // len(ids)], words[r.key % len(ids)]): r.n for r in rows}
        known = list(found)
        grams.append(found)
        if not found:
            break
    return (Automaton(frequent, grams, total, head["v"], head["texts"], discount), table, total)


class _Numbers(dict):
    """Numbers words in the order of their first look-up."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _packed(values: np.ndarray) -> bytes:
    """Rows of 64-bit or 32-bit numbers by byte places, compressed."""
    places = np.ascontiguousarray(values.reshape(len(values), -1)).view(np.uint8).T if len(
        values) else np.zeros(0, np.uint8)
    return len(values).to_bytes(8, "little") + pa.compress(
        places.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind: type, width: int = 1) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize * width
    if not n:
        return np.zeros((0, width), kind)
    places = np.frombuffer(pa.decompress(data[8:], n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(places.reshape(size, n).T).view(kind)


#: Classes of numbers: each below ``_SINGLE`` has its own, the others go by their highest three
#: bits.  First number of a class, and the bits that follow in it.
_SINGLE, PACKED_AT_ONCE = 16, 1 << 16
_FIRST = np.array([*range(_SINGLE), *(t << k for k in range(2, 62) for t in range(4, 8))], np.uint64)
_BITS = np.array([0] * _SINGLE + [k for k in range(2, 62) for _ in range(4)], np.int64)


def _classed(values: np.ndarray) -> bytes:
    """Rows of 64-bit numbers by columns: the classes of the numbers, compressed, then the bits
    that tell the numbers of a class apart, as they are.  For numbers of very unlike sizes."""
    out = [len(values).to_bytes(8, "little")]
    for column in values.reshape(len(values), -1).T if len(values) else ():
        whole = column.astype(np.uint64)
        kinds = (np.searchsorted(_FIRST, whole, "right") - 1).astype(np.uint8)
        packed = pa.compress(kinds.tobytes(), codec="zstd", asbytes=True)
        out += [len(packed).to_bytes(8, "little"), packed]
        some = np.flatnonzero(kinds >= _SINGLE)
        for at in range(0, len(some), PACKED_AT_ONCE):
            part = some[at:at + PACKED_AT_ONCE]
            rest = whole[part] - _FIRST[kinds[part]]
            keep = _kept_bits(kinds[part])
            low = rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :keep.shape[1] // 8]
            out.append(np.packbits(np.unpackbits(low, axis=1, bitorder="little")[keep],
                                   bitorder="little").tobytes())
    return b"".join(out)


def _from_classed(data: bytes, width: int = 1) -> np.ndarray:
    n, at = int.from_bytes(data[:8], "little"), 8
    out = np.zeros((n, width), np.int64)
    for k in range(width if n else 0):
        end = at + 8 + int.from_bytes(data[at:at + 8], "little")
        kinds = np.frombuffer(pa.decompress(data[at + 8:end], n, codec="zstd", asbytes=True), np.uint8)
        at, whole = end, _FIRST[kinds]
        some = np.flatnonzero(kinds >= _SINGLE)
        for first in range(0, len(some), PACKED_AT_ONCE):
            part = some[first:first + PACKED_AT_ONCE]
            keep = _kept_bits(kinds[part])
            count = int(_BITS[kinds[part]].sum())
            bits = np.zeros(keep.shape, np.uint8)
            bits[keep] = np.unpackbits(np.frombuffer(data, np.uint8, -(-count // 8), at), count=count,
                                       bitorder="little")
            at += -(-count // 8)
            low = np.zeros((len(part), 8), np.uint8)
            low[:, :keep.shape[1] // 8] = np.packbits(bits, axis=1, bitorder="little")
            whole[part] += low.view("<u8")[:, 0]
        out[:, k] = whole.astype(np.int64)
    return out


def _kept_bits(kinds: np.ndarray) -> np.ndarray:
    """Which of the lowest bits, in whole bytes, tell the numbers of their classes apart."""
    bits = _BITS[kinds]
    return np.arange(-(-int(bits.max()) // 8) * 8) < bits[:, None]


def _steps(values: np.ndarray) -> bytes:
    """Sorted numbers by their differences."""
    return _packed(np.diff(values, prepend=values.dtype.type(0)))


def _from_steps(data: bytes, kind: type) -> np.ndarray:
    return np.cumsum(_unpacked(data, kind)[:, 0], dtype=kind)


def _steps_within(values: np.ndarray, sizes: np.ndarray) -> bytes:
    """Numbers in groups of ``sizes``, sorted inside them, by their differences there."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    steps[first] = values[first]
    return _classed(steps)


def _from_steps_within(data: bytes, sizes: np.ndarray) -> np.ndarray:
    steps, sizes = _from_classed(data)[:, 0], sizes[sizes > 0]
    total, first = np.cumsum(steps), np.cumsum(sizes) - sizes
    return total - np.repeat(total[first] - steps[first], sizes)


def _by_word(words: np.ndarray, counts: np.ndarray) -> bytes:
    """Counts that depend on the word only: one per distinct word, in the order of their
    numbers, which rise as counts fall, by zigzag differences."""
    _, some, _ = _distinct(words)
    steps = np.diff(counts[some], prepend=0)
    return _packed(steps << 1 ^ steps >> 63)


def _from_by_word(words: np.ndarray, data: bytes) -> np.ndarray:
    steps = _unpacked(data, np.int64)[:, 0]
    return np.cumsum(steps >> 1 ^ -(steps & 1))[_distinct(words)[2]]


def _sparse(rows: np.ndarray) -> bytes:
    """Rows of a context's sums, those without arcs left out; an arc is counted ``MIN_COUNT``
    times at least, and its n-gram one token shorter no less often, so only the rest is kept."""
    some = rows[:, 0] > 0
    arcs, count, low = rows[some].T
    rest = np.stack([arcs, count - MIN_COUNT * arcs, low - count], axis=1)
    return len(rows).to_bytes(8, "little") + np.packbits(some).tobytes() + _classed(rest)


def _from_sparse(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    rows, end = np.zeros((n, 3), np.int64), 8 + -(-n // 8)
    some = np.unpackbits(np.frombuffer(data[8:end], np.uint8), count=n).astype(bool)
    arcs, count, low = _from_classed(data[end:], 3).T
    count = count + MIN_COUNT * arcs
    rows[some] = np.stack([arcs, count, low + count], axis=1)
    return rows


def _arc_sums(context: np.ndarray, count: np.ndarray, low: np.ndarray, n: int) -> np.ndarray:
    """Per context its arcs, their counts and the counts of the n-grams one token shorter
    (exact below 2^53)."""
    return np.stack([np.bincount(context, w, n) for w in (np.ones(len(context)), count, low)],
                    axis=1).astype(np.int64)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, a place of each, and the number of each place's key."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.append(True, ordered[1:] != ordered[:-1]) if len(keys) else np.zeros(0, bool)
    back = np.empty(len(keys), np.int32)
    back[order] = np.cumsum(new) - 1
    return ordered[new], order[new], back


class Level:
    """The n-grams of one length in a block.

    ``at`` is the number of the n-gram that ends at each token (-1: none that may be an
    arc); per n-gram: ``context`` and ``suffix`` (numbers in the level below), ``word``,
    ``seen`` (training count in the block), and once answered ``id`` (-1: no arc) and
    ``count`` of the whole input, and as a context ``sums`` (arcs, their counts, and the
    counts of the n-grams one token shorter; only those of the block's own arcs where each
    token that follows has its arc there, for such a context never fails).
    """

    def __init__(self, at, context, suffix, word, seen):
        self.at, self.context, self.suffix, self.word, self.seen = at, context, suffix, word, seen
        n = len(seen)
        self.id, self.count = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        self.sums = np.zeros((n, 3), np.int64)


class Block:
    """A block's tokens and the levels of its n-grams answered so far."""

    def __init__(self, row: dict, answers: list[dict]):
        self.row = row
        if row["hashes"] is None:       # told by the first round, and not kept after it
            self.words, self.order0 = None, _hash_order(_unpacked(row["uses"], np.int64)[:, 0])
        else:
            self.words = np.frombuffer(row["hashes"], np.uint64)
            self.order0 = np.argsort(self.words, kind="stable")
        size = len(self.order0)
        self.lids = _unpacked(row["lids"], np.int32)[:, 0]
        sizes, lead = np.array(row["sizes"], np.int64), np.array(row["lead"], np.int64)
        self.starts, self.lead = np.cumsum(sizes) - sizes, lead
        self.place = np.arange(len(self.lids)) - np.repeat(self.starts, sizes)
        self.own = self.place >= np.repeat(lead, sizes)          # not read for context only
        trained = ~np.repeat(np.array(row["held_out"], bool), sizes)
        first = np.repeat(np.array(row["part"], np.int64) == 0, sizes)
        # the start of a text is counted with its first part, like a word
        counted = trained & (self.own | (first & (self.place == 0)))
        self.counted = counted
        seen = np.bincount(self.lids[counted], minlength=size)
        self.levels = [Level(self.lids, None, None, np.arange(size), seen)]
        by_level: dict[int, list[dict]] = {}
        for a in answers:
            by_level.setdefault(a["m"], []).append(a)
        for m in range(max(by_level, default=-1) + 1):
            if m:
                self.extend()
            self._answered(m, sorted(by_level.get(m, []), key=lambda a: a["range"]))

    def extend(self) -> None:
        """Add the level above: n-grams whose context and suffix are both arcs."""
        below, m = self.levels[-1], len(self.levels)
        can = np.flatnonzero(self.place[1:] >= m) + 1
        a, b = below.at[can - 1], below.at[can]
        fit = (a >= 0) & (b >= 0)
        fit[fit] = (below.id[a[fit]] >= 0) & (below.id[b[fit]] >= 0)
        can, a, b = can[fit], a[fit], b[fit]
        size = len(self.order0)
        _, some, back = _distinct(a.astype(np.int64) * size + self.lids[can])
        at = np.full(len(self.lids), -1, np.int32)
        at[can] = back
        seen = np.bincount(back[self.counted[can]], minlength=len(some))
        self.levels.append(Level(at, a[some], b[some], self.lids[can[some]], seen))

    def asked(self) -> np.ndarray:
        """Numbers of the contexts of the top level that the block's tokens meet."""
        below, m = self.levels[-2], len(self.levels) - 1
        ends = np.flatnonzero(self.place[1:] >= m)
        met = np.zeros(len(below.id), bool)
        a = below.at[ends]
        met[a[a >= 0]] = True
        return np.flatnonzero(met & (below.id >= 0))

    def open(self) -> np.ndarray:
        """Whether a context of the top level is followed by a token with no n-gram there."""
        below, top, m = self.levels[-2], self.levels[-1], len(self.levels) - 1
        ends = np.flatnonzero(self.place[1:] >= m)
        a = below.at[ends]
        out = np.zeros(len(below.id), bool)
        out[a[(a >= 0) & (top.at[ends + 1] < 0)]] = True
        return out

    def sent_order(self, ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Asked contexts by (owner, number), the top n-grams by (context, word), and how many
        n-grams each context has."""
        below, top = self.levels[-2], self.levels[-1]
        contexts = self.asked()
        ids = below.id[contexts]
        contexts = contexts[np.argsort((ids % ranges) << 44 | ids // ranges)]
        rank = np.zeros(len(below.id), np.int64)
        rank[contexts] = np.arange(len(contexts))
        own = rank[top.context]
        grams = np.argsort(own << 34 | self.levels[0].id[top.word])
        return contexts, grams, np.bincount(own, minlength=len(contexts))

    def messages(self, ranges: int) -> Iterator[dict]:
        """The top level's message to each owner."""
        below, top, m = self.levels[-2], self.levels[-1], len(self.levels) - 1
        contexts, grams, sizes = self.sent_order(ranges)
        ends, is_open = np.cumsum(sizes), self.open()
        owner = below.id[contexts] % ranges
        cut = np.searchsorted(owner, np.arange(ranges + 1))
        for r in range(ranges):
            c = slice(cut[r], cut[r + 1])
            if c.start == c.stop:
                continue
            g = grams[ends[c.start] - sizes[c.start]:ends[c.stop - 1]]
            words, low = self.levels[0].id[top.word[g]], below.count[top.suffix[g]]
            yield {"m": m, "range": r, "block": self.row["block"],
                   "contexts": _steps(below.id[contexts[c]] // ranges), "sizes": _packed(sizes[c]),
                   "open": np.packbits(is_open[contexts[c]]).tobytes(), "words": _steps_within(words, sizes[c]), "seen": _packed(top.seen[g]),
                   "low": _by_word(words, low) if m == 1 else _classed(low[top.seen[g] > 0])}

    def _answered(self, m: int, rows: list[dict]) -> None:
        """Fill a level from the owners' answers, which come in the order sent."""
        if not rows:
            return
        level = self.levels[m]
        count = np.concatenate([_unpacked(r["counts"], np.int64)[:, 0] for r in rows])
        ids = []
        for r in rows:
            own = np.full(int.from_bytes(r["counts"][:8], "little"), -1, np.int64)
            if r["ids"] is not None:        # the longest n-grams have no numbers
                arc = (_unpacked(r["counts"], np.int64)[:, 0] > 0 if m else
                       np.unpackbits(np.frombuffer(r["arcs"], np.uint8), count=len(own)).astype(bool))
                number = _from_steps(r["ids"], np.int64) if m else _unpacked(r["ids"], np.int64)[:, 0]
                own[arc] = number * r["ranges"] + r["range"]
            ids.append(own)
        if m == 0:
            order = self.order0
        else:
            contexts, order, _ = self.sent_order(rows[0]["ranges"])
        level.count[order], level.id[order] = count, np.concatenate(ids)
        if m:       # the owners' sums leave out the block's own arcs
            below, arc = self.levels[m - 1], np.flatnonzero(level.count > 0)
            low = below.count[level.suffix[arc]]
            below.sums = _arc_sums(level.context[arc], level.count[arc], low, len(below.id))
            below.sums[contexts] += np.concatenate([_from_sparse(r["sums"]) for r in rows])


def _stored(row: dict, answers: list[dict]) -> Block:
    """A block of the table, where hashes are stored by their differences."""
    return Block(row | {"hashes": _from_steps(row["hashes"], np.uint64).tobytes()}, answers)


def _uses(block: Block) -> bytes:
    """How often a block's words stand in it, in the order of their hashes (the start: 0)."""
    uses = np.bincount(block.lids, minlength=len(block.order0))
    uses[0] = 0
    return _packed(uses[block.order0])


def _hash_order(uses: np.ndarray) -> np.ndarray:
    """Numbers of a block's words in the order of their hashes, which ``_blocks`` gives by falling
    use and rising hash after the start."""
    number = np.empty(len(uses), np.int64)
    number[np.argsort(np.where(uses > 0, -uses, np.iinfo(np.int64).min), kind="stable")] = np.arange(len(uses))
    return number


def _removed(spark: SparkSession, path: str) -> None:
    """Remove a scratch table's files."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


_SENT = ("m int, range int, block long, contexts binary, sizes binary, open binary, words binary, "
         "seen binary, low binary")
_SENT_ARROW = pa.schema([("m", pa.int32()), ("range", pa.int32()), ("block", pa.int64()),
                         ("contexts", pa.binary()), ("sizes", pa.binary()), ("open", pa.binary()),
                         ("words", pa.binary()), ("seen", pa.binary()), ("low", pa.binary())])
_ANSWER = ("m int, range int, ranges int, block long, counts binary, arcs binary, ids binary, "
           "sums binary, known long")
_ANSWER_ARROW = pa.schema([("m", pa.int32()), ("range", pa.int32()), ("ranges", pa.int32()),
                           ("block", pa.int64()), ("counts", pa.binary()), ("arcs", pa.binary()),
                           ("ids", pa.binary()), ("sums", pa.binary()), ("known", pa.int64())])


def _words_sent(block: Block, ranges: int) -> Iterator[dict]:
    """Level 0: word hashes in order, cut into ranges of hashes."""
    order = block.order0
    hashes, seen = block.words[order], block.levels[0].seen[order]
    bounds = np.array([-(-(r << 64) // ranges) for r in range(ranges)], np.uint64)
    cut = np.append(np.searchsorted(hashes, bounds), len(hashes))
    for r in range(ranges):
        a, b = cut[r], cut[r + 1]
        if a < b:
            yield {"m": 0, "range": r, "block": block.row["block"], "contexts": None, "sizes": None,
                   "open": None, "words": _steps(hashes[a:b]), "seen": _packed(seen[a:b]), "low": None}


def _owned(table: pa.Table, ranges: int, bar: float, last: bool = False) -> pa.Table:
    """What the owner of a range answers to each block that sent to it; arcs of the ``last``
    round need no numbers."""
    table = table.sort_by("block")
    m, r = table.column("m")[0].as_py(), table.column("range")[0].as_py()
    rows = table.to_pylist()
    if m == 0:
        parts = [_from_steps(x["words"], np.uint64) for x in rows]
        keys = np.concatenate(parts)
        context = low = np.zeros(len(keys), np.int64)
    else:
        asked = [_from_steps(x["contexts"], np.int64) for x in rows]
        sizes = [_unpacked(x["sizes"], np.int64)[:, 0] for x in rows]
        names, _, every = _distinct(np.concatenate(asked))
        context = np.repeat(every, np.concatenate(sizes)).astype(np.int64)
        parts = [_from_steps_within(x["words"], n) for x, n in zip(rows, sizes, strict=True)]
        if any(len(p) and p.max() >= 1 << 34 for p in parts):
            raise ValueError("more than 2^34 words")
        keys = context << 34 | np.concatenate(parts)
    seen = np.concatenate([_unpacked(x["seen"], np.int64)[:, 0] for x in rows])
    distinct, some, back = _distinct(keys)
    if m == 1:
        low = np.concatenate([_from_by_word(p, x["low"]) for p, x in zip(parts, rows, strict=True)])
    elif m:     # told where seen in training, as every arc is somewhere
        told, known_low = np.flatnonzero(seen > 0), np.zeros(len(distinct), np.int64)
        known_low[back[told]] = np.concatenate([_from_classed(x["low"])[:, 0] for x in rows])
        low = known_low[back]
    total = np.bincount(back, seen, len(distinct)).astype(np.int64)      # exact below 2^53
    known = int((total > 0).sum())
    arc = total >= bar
    if m:
        number = np.cumsum(arc) - 1
        total[~arc] = 0
        of = context[some]
        sums = _arc_sums(of[arc], total[arc], low[some][arc], len(names))
    else:       # frequent words have small numbers
        number = np.empty(len(distinct), np.int64)
        number[np.argsort(-total, kind="stable")] = np.arange(len(distinct))
    coded = _steps if m else _packed
    ends = np.cumsum([len(p) for p in parts])
    spans = list(zip(ends - [len(p) for p in parts], ends, strict=True))
    out = {"counts": [_packed(total[back[a:b]]) for a, b in spans],
           "arcs": [None if m else np.packbits(arc[back[a:b]]).tobytes() for a, b in spans],
           "ids": [None if last else coded(number[back[a:b]][arc[back[a:b]]]) for a, b in spans]}
    if m:
        cuts = np.cumsum([len(x) for x in asked])
        out["sums"] = []
        for c, x, n, row, (a, b) in zip(cuts, asked, sizes, rows, spans, strict=True):
            # a block adds up its own arcs itself, and fails only where a token has no arc
            place, own = np.repeat(np.arange(len(x)), n), arc[back[a:b]]
            rest = sums[every[c - len(x):c]] - _arc_sums(
                place[own], total[back[a:b]][own], low[a:b][own], len(x))
            fails = np.unpackbits(np.frombuffer(row["open"], np.uint8), count=len(x)).astype(bool)
            fails[place[~own]] = True
            rest[~fails] = 0
            out["sums"].append(_sparse(rest))
    else:
        out["sums"] = [None] * len(rows)
    n = len(rows)
    return pa.table([table.column("m"), table.column("range"), pa.array([ranges] * n, pa.int32()),
                     table.column("block"),
                     *[pa.array(out[k], pa.binary()) for k in ("counts", "arcs", "ids", "sums")],
                     pa.array([known] + [0] * (n - 1), pa.int64())], schema=_ANSWER_ARROW)


class LocalAutomaton:
    """The part of the automaton that a block's texts can reach, as arrays.

    State 0 is the empty context.  ``fail``, ``weight`` (log10) and ``length`` are by state;
    an arc is an n-gram of the block: ``prob[m]`` (log10; NaN: no arc) and ``next[m]`` by its
    number in level ``m``, so the arc of a state of length ``m`` at a token is that
    of the level's n-gram that ends there.
    """

    def __init__(self, block: Block, order: int, mass: float, discount: float):
        zero = np.zeros(1)
        self.fail, self.weight, self.length = [zero.astype(np.int64)], [zero], [zero.astype(np.int64)]
        self.prob, self.next, n = [], [], 1
        for m, level in enumerate(block.levels):
            if m == 0:
                self.prob.append(np.log10((level.count + 1) / mass))
                shorter = np.zeros(len(level.count), np.int64)
            else:
                held = level.count > 0
                context = np.where(held, block.levels[m - 1].count[level.context], 1)
                self.prob.append(np.where(held, np.log10(np.where(held, level.count - discount, 1.0)
                                                         / context), np.nan))
                shorter = self.next[m - 1][level.suffix]
            state = shorter.copy()
            if m < order - 1:
                arcs, longer, lower = level.sums.T
                inner = np.flatnonzero(arcs > 0)
                state[inner] = n + np.arange(len(inner))
                n += len(inner)
                k, c = arcs[inner], level.count[inner]
                if m == 0:
                    rest = (mass - lower[inner] - k) / mass
                else:
                    c_short = block.levels[m - 1].count[level.suffix[inner]]
                    rest = (c_short - lower[inner] + discount * k) / c_short
                self.fail.append(shorter[inner])
                self.weight.append(np.log10((c - longer[inner] + discount * k) / c / rest))
                self.length.append(np.full(len(inner), m + 1))
            self.next.append(state)
        self.fail, self.weight, self.length = map(np.concatenate, (self.fail, self.weight, self.length))

    def traverse(self, block: Block, order: int, run: int = RUN) -> np.ndarray:
        """Log10 probability of every token (0 for those read for context only).

        Texts are cut into runs, walked side by side from left to right.  A run that starts
        inside a text starts ``order - 1`` tokens earlier, in the empty state: the
        longest context of its first own token is then its state."""
        sizes = np.diff(np.append(block.starts, len(block.lids)))
        begin, end, state = [], [], []
        runs = -(-(sizes - block.lead) // run)
        text = np.repeat(np.arange(len(sizes)), runs)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
        first = block.starts[text] + block.lead[text] + nth * run       # first own token
        end = np.minimum(first + run, block.starts[text] + sizes[text])
        # from the start of a text: the state after reading it; else the tokens before decide
        fresh = (nth == 0) & (np.array(block.row["part"], np.int64)[text] == 0)
        begin = np.where(fresh, first, np.maximum(first - (order - 1), block.starts[text]))
        # the start mark is read like a word, but never scored
        state = np.where(fresh, self.next[0][0] if len(self.next[0]) else 0, 0)
        longest = np.argsort(begin - end, kind="stable")
        first, begin, end, state = first[longest], begin[longest], end[longest], state[longest]
        length = end - begin
        out = np.zeros(len(block.lids))
        for step in range(int(length.max(initial=0))):
            live = int(np.searchsorted(-length, -step))                 # runs longer than step
            token, s = begin[:live] + step, state[:live]
            score, todo = np.zeros(live), np.arange(live)
            for m in range(min(order, len(block.levels)) - 1, -1, -1):
                here = todo[self.length[s[todo]] == m] if m else todo
                gram = block.levels[m].at[token[here]]
                p = self.prob[m][gram]
                hit = ~np.isnan(p) & (gram >= 0)
                done, missed = here[hit], here[~hit]
                score[done] += p[hit]
                s[done] = self.next[m][gram[hit]]
                score[missed] += self.weight[s[missed]]
                s[missed] = self.fail[s[missed]]
                if m:
                    left = np.ones(live, bool)
                    left[done] = False
                    todo = todo[left[todo]]
            own = token >= first[:live]
            out[token[own]] = score[own]
        return out


def _bucketed(df: DataFrame, buckets: int, name: str, path: str) -> DataFrame:
    """Append to a table bucketed by block, and read all of it."""
    (df.write.mode("append").bucketBy(buckets, "block").option("compression", "zstd")
     .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def _blocks(rows: DataFrame, block_bytes: int, part_bytes: int, order: int,
            path: str | None = None) -> tuple[DataFrame, int]:
    """Texts as blocks of word numbers, one row per block, word 0 is the start of a text; a
    table bucketed by block, and its number of buckets.  Each part of a text is led by the start, or by the tokens before
    it that its first state depends on."""
    kind = rows.schema["doc_id"].dataType

    def pieces(text: bytes) -> Iterator[list[bytes]]:
        """The words of a text in parts that no word crosses, then the end."""
        at = 0
        while len(text) - at > part_bytes:
            cut = at + part_bytes
            while cut < len(text) and text[cut] not in b" \t\n\x0b\x0c\r":
                cut += 1
            own = text[at:cut].lower().split()
            if own:
                yield own
            at = cut
        yield [*text[at:].lower().split(), END]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        block, row, id_type = task << 32, task << 36, None
        size, ids, held = 0, None, []

        def flush():
            nonlocal block, size, ids, held
            doc_ids, out, numbers, part, lead, lids = (list(x) for x in zip(*held, strict=True))
            n = [len(x) - k for x, k in zip(lids, lead, strict=True)]
            # frequent words get small numbers; among equal counts the hashes rise
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, ids), np.uint64, len(ids))
            every = np.concatenate(lids)
            order = np.lexsort((hashes[1:], -np.bincount(every, minlength=len(ids))[1:]))
            order = np.append(0, order + 1)
            number = np.empty(len(ids), np.int32)
            number[order] = np.arange(len(ids), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([doc_ids], pa.list_(id_type)),
                 pa.array([out], pa.list_(pa.bool_())), pa.array([numbers], pa.list_(pa.int64())),
                 pa.array([part], pa.list_(pa.int32())), pa.array([lead], pa.list_(pa.int32())),
                 pa.array([[len(x) for x in lids]], pa.list_(pa.int64())),
                 pa.array([sum(k for k, o in zip(n, out, strict=True) if not o)], pa.int64()),
                 pa.array([sum(not o and p == 0 for o, p in zip(out, part, strict=True))], pa.int64()),
                 pa.array([sum(n)], pa.int64()), pa.array([any(part)], pa.bool_()),
                 pa.array([_steps(hashes[order])], pa.binary()),
                 pa.array([_packed(number[every])], pa.binary())],
                names=["block", "doc_id", "held_out", "row", "part", "lead", "sizes", "train_tokens",
                       "train_texts", "tokens", "cut", "hashes", "lids"])
            block += 1
            size, ids, held = 0, None, []

        for batch in sliced(batches):
            id_type = batch.column("doc_id").type
            for doc_id, out, text in zip(*(batch.column(c) for c in ("doc_id", "held_out", "text")),
                                         strict=True):
                text, before = text.as_py() or b"", [START]
                for part, words in enumerate(pieces(text)):
                    if ids is None:
                        ids = _Numbers({START: 0})
                    words = [*before, *words]
                    held.append((doc_id.as_py(), out.as_py(), row, part, len(before),
                                 np.fromiter(map(ids.__getitem__, words), np.int32, len(words))))
                    size += sum(map(len, words)) if len(text) > part_bytes else len(text)
                    before = words[-(order - 1):] if order > 1 else []
                    if size >= block_bytes:
                        yield from flush()
                row += 1
        if held:
            yield from flush()

    id_kind = kind.simpleString()
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // (4 * BLOCK_BYTES) + 1)
    buckets = min(buckets, MAX_BUCKETS)
    schema = (f"block long, doc_id array<{id_kind}>, held_out array<boolean>, row array<long>, "
              "part array<int>, lead array<int>, sizes array<long>, train_tokens long, "
              "train_texts long, tokens long, cut boolean, hashes binary, lids binary")
    name = f"lm_blocks_{uuid.uuid4().hex[:12]}"
    return _bucketed(rows.mapInArrow(walk, schema), buckets, name,
                     path or scratch_path(spark, "lm-blocks")), buckets


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs run inside are removed when a job ends."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def score_texts(docs: DataFrame, order: int = ORDER, share: float = 0.0,
                discount: float = DISCOUNT, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES, part_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score`` (log10 probabilities of the text).

    Texts of more than ``part_bytes`` are cut over blocks."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       held_out(F.col(f"`{id_col}`")).alias("held_out"),
                       F.col(f"`{text_col}`").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    hashed = scratch_path(spark, "lm-blocks")
    blocks, buckets = _blocks(rows, block_bytes, part_bytes, order, hashed)
    head = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c)
                        for c in ("train_tokens", "train_texts", "tokens")],
                      F.coalesce(F.max("cut"), F.lit(False)).alias("cut")).first()
    total, ranges = head["train_tokens"], max(1, -(-head["tokens"] // RANGE_TOKENS))
    bar = max(float(MIN_COUNT), share * total)
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ranges // 2 + 1)
    texts = blocks.select("block", "doc_id", "held_out", "row", "part", "lead", "sizes", "hashes", "lids")

    name, path = f"lm_answers_{uuid.uuid4().hex[:12]}", scratch_path(spark, "lm-answers")

    def answered(sent: DataFrame, m: int) -> DataFrame:
        out = sent.repartition(owners, "range").groupBy("range").applyInArrow(
            lambda t: _owned(t, ranges, bar, m == order - 1), _ANSWER)
        with _shuffles_removed(spark):      # messages are off the disk before answers are dealt
            owned = scratch_path(spark, "lm-owned")
            out.write.option("compression", "zstd").parquet(owned)
            dealt = spark.read.schema(out.schema).parquet(owned).repartition(buckets, "block")
            table = _bucketed(dealt, buckets, name, path)
        _removed(spark, owned)
        return table

    def together(answers: DataFrame, fn, schema: str) -> DataFrame:
        return texts.groupBy("block").cogroup(
            answers.withColumnRenamed("block", "of").groupBy("of")).applyInArrow(fn, schema)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist(list(_words_sent(_stored(row, []), ranges)), _SENT_ARROW)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            for row in batch.to_pylist():
                uses = pa.array([_uses(_stored(row, []))], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [uses if c == "hashes" else batch.column(c) for c in batch.schema.names],
                    names=["uses" if c == "hashes" else c for c in batch.schema.names])

    def longer(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            block = Block(row | {"hashes": None}, right.to_pylist())
            block.extend()
            out += block.messages(ranges)
        return pa.Table.from_pylist(out, _SENT_ARROW)

    # starts are counted like words: their count is the number of training texts
    answers = answered(texts.mapInArrow(words, _SENT), 0)
    known = answers.agg(F.coalesce(F.sum("known"), F.lit(0)).alias("n")).first()["n"]
    vocabulary = known - (1 if head["train_texts"] else 0)
    mass = total + vocabulary + 1 if total else 1
    # the owners have numbered the words, so their hashes are needed no more
    kinds = ", ".join(f"{'uses' if f.name == 'hashes' else f.name} {f.dataType.simpleString()}"
                      for f in texts.schema)
    texts = _bucketed(texts.mapInArrow(numbered, kinds), buckets, f"lm_texts_{uuid.uuid4().hex[:12]}",
                      scratch_path(spark, "lm-texts"))
    _removed(spark, hashed)
    for m in range(1, order):
        answers = answered(together(answers, longer, _SENT), m)

    result = (f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double, row long")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            block = Block(row | {"hashes": None}, right.to_pylist())
            score = LocalAutomaton(block, order, mass, discount).traverse(block, order)
            single = block.levels[0].count[block.lids]
            base = np.where(block.own, np.log10((single + 1) / mass), 0.0)
            own = np.add.reduceat
            out.append(pa.table({
                "doc_id": pa.array(row["doc_id"], left.schema.field("doc_id").type.value_type),
                "held_out": pa.array(row["held_out"], pa.bool_()),
                "n_tokens": own(block.own.astype(np.int64), block.starts),
                "n_known": own(((single > 0) & block.own).astype(np.int64), block.starts),
                "train_tokens": np.full(len(block.starts), total, np.int64),
                "base_score": own(base, block.starts), "score": own(score, block.starts),
                "row": pa.array(row["row"], pa.int64())}))
        return pa.concat_tables(out)

    scored = together(answers, finish, result)
    if head["cut"]:      # parts of long texts are added up; the others are whole already
        one = [F.first(c).alias(c) for c in ("doc_id", "held_out")]
        scored = scored.groupBy("row").agg(
            *one, F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
            F.first("train_tokens").alias("train_tokens"), F.sum("base_score").alias("base_score"),
            F.sum("score").alias("score"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
