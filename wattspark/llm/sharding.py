"""Contiguous shards with the smallest possible capacity over atomic groups.

Rows with equal texts are one atomic group.  Groups are ordered by the XXH64
of their text, a seeded shuffle that any run repeats.  The smallest capacity
for which a greedy pass fits the ordered groups into the shards is found by
binary search; the cuts then stay within that capacity and lie as near to even
as it allows.

The group sizes stay on Spark.  The driver holds a histogram of them by hash
prefix (``2**FAN_BITS`` sums), which brackets the capacity from both sides;
only prefixes in which a cut may fall are refined by ``FAN_BITS`` more bits,
until the bracket closes on the exact answer.

A group as large as an even share of what is left takes a shard of its own
(at most one per shard), so it cannot leave later shards empty.

Cases: a null text has size 1 and belongs to the group of the empty text; null
ids sort first; repeated rows are rows of one group; an empty table gives an
empty result; extra columns are kept by ``write_shards`` (but one named ``shard``) and
ignored by ``shard_documents``.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, numbered, order_key

#: Hash bits by which one refinement step splits a prefix.
FAN_BITS = 10


@dataclass(frozen=True)
class Segment:
    """The groups under one hash prefix: ``[lo, lo + 2**(64 - bits))``."""

    lo: int
    bits: int
    size: int
    groups: int


def _histogram(groups: DataFrame, bits: int, parents: list[Segment] | None) -> list[Segment]:
    """Sizes by the first ``bits`` hash bits, under the given parent prefixes."""
    rows = groups
    if parents is not None:
        up = 64 - parents[0].bits
        spark = groups.sparkSession
        keys = spark.createDataFrame([(s.lo >> up,) for s in parents], "__p long")
        rows = rows.join(F.broadcast(keys), F.shiftright("g", up) == F.col("__p"), "left_semi")
    down = 64 - bits
    key = F.shiftright("g", down) if down else F.col("g")
    found = (rows.groupBy(key.alias("p"))
             .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect())
    return sorted((Segment(r.p << down, bits, r["size"], r.n) for r in found),
                  key=lambda s: s.lo)


class _Cuts:
    """Greedy passes over the known boundaries of the segments."""

    def __init__(self, segments: list[Segment], shards: int):
        self.segments, self.shards = segments, shards
        self.ends = [0]
        for s in segments:
            self.ends.append(self.ends[-1] + s.size)
        self.total = self.ends[-1]

    def floor(self, x: int) -> int:
        return self.ends[bisect_right(self.ends, x) - 1]

    def reach(self, capacity: int, sure: bool) -> list[int]:
        """Ends of the greedy shards: with known boundaries (``sure``), or an upper bound."""
        out, p = [], 0
        for _ in range(self.shards):
            x = p + capacity
            if x >= self.total:
                p = self.total
            else:
                k = bisect_right(self.ends, x) - 1
                p = self.ends[k] if sure or self.segments[k].groups == 1 else x
            out.append(p)
        return out

    def smallest(self, sure: bool) -> int:
        """Binary search for the smallest capacity whose greedy pass takes everything."""
        lo, hi = -(-self.total // self.shards), self.total
        while lo < hi:
            mid = (lo + hi) // 2
            if self.reach(mid, sure)[-1] >= self.total:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def open_segments(self, low: int, high: int) -> set[int]:
        """Segments with several groups in which a cut for these capacities, or an even cut, may fall."""
        spans = [(a, b) for a, b in zip(self.reach(low, True), self.reach(high, False), strict=True)]
        spans = [(a, min(self.total, b + high - low)) for a, b in spans]
        spans += [(self.total * i // self.shards,) * 2 for i in range(1, self.shards)]
        found = set()
        for a, b in spans:
            k = max(0, bisect_right(self.ends, a) - 1)
            while k < len(self.segments) and self.ends[k] <= b:
                if self.segments[k].groups > 1:
                    found.add(k)
                k += 1
        return found

    def even(self, capacity: int) -> list[int]:
        """Cuts within the capacity, each as near to its even place as the others allow."""
        back = [self.total]
        for _ in range(self.shards - 1):
            x = max(0, back[-1] - capacity)
            k = bisect_right(self.ends, x) - 1
            back.append(self.ends[k] if self.ends[k] == x else self.ends[k + 1])
        back = back[::-1]
        cuts, p = [], 0
        for i in range(1, self.shards):
            low, high = max(back[i - 1], p), self.floor(min(self.total, p + capacity))
            aim = min(max(self.total * i // self.shards, low), high)
            a = self.floor(aim)
            b = self.ends[min(bisect_right(self.ends, a), len(self.ends) - 1)]
            near = [c for c in (a, b) if low <= c <= high] or [high]
            p = min(near, key=lambda c: (abs(c - aim), c))
            cuts.append(p)
        return cuts


def minimax_cuts(groups: DataFrame, shards: int, fan_bits: int = FAN_BITS) -> tuple[int, list[int]]:
    """Smallest capacity over the groups (``g``, ``size``) in order of ``g``, and the
    first ``g`` of each shard but the first (``2**63`` where nothing is left)."""
    segments = _histogram(groups, fan_bits, None)
    if not segments:
        return 0, [1 << 63] * (shards - 1)
    while True:
        state = _Cuts(segments, shards)
        low, high = state.smallest(False), state.smallest(True)
        todo = state.open_segments(low, high)
        if not todo:
            break
        by_bits: dict[int, list[Segment]] = {}
        for k in todo:
            by_bits.setdefault(segments[k].bits, []).append(segments[k])
        kept = [s for k, s in enumerate(segments) if k not in todo]
        for bits, parents in sorted(by_bits.items()):
            kept += _histogram(groups, min(64, bits + fan_bits), parents)
        segments = sorted(kept, key=lambda s: s.lo)
    firsts = []
    for p in state.even(high):
        k = bisect_right(state.ends, p) - 1
        firsts.append(segments[k].lo if k < len(segments) else 1 << 63)
    return high, firsts


def group_key(text: Column) -> Column:
    """The atomic group of a text, by which groups are ordered."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def placement(groups: DataFrame, shards: int) -> Callable[[Column], Column]:
    """The shard of a group key, for the groups (``g``, ``size``)."""
    total = groups.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()["size"]
    # at most `shards` groups are as large as an even share
    left, own = total, []
    large = groups.filter(F.col("size") * shards >= total).orderBy(F.desc("size"), "g").collect()
    for r in large:
        if len(own) + 1 < shards and r["size"] * (shards - len(own)) >= left:
            own.append(r.g)
            left -= r["size"]
    rest = groups.filter(~F.col("g").isin(own)) if own else groups
    _, firsts = minimax_cuts(rest, shards - len(own))
    inner = [c for c in firsts if c < 1 << 63]

    def place(g: Column) -> Column:
        out = F.lit(len(own))
        if inner:
            out = out + F.size(F.filter(F.array(*[F.lit(c) for c in inner]), lambda c: c <= g))
        for k, x in enumerate(own):
            out = F.when(g == x, F.lit(k)).otherwise(out)
        return out.cast("int")

    return place


def _sized_rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows (``doc_id``, ``size``, ``text_crc32``, ``g``) and groups (``g``, ``size``, ``rows``)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = materialize(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), group_key(text).alias("g")), "shard-rows")
    return rows, materialize(rows.groupBy("g").agg(F.sum("size").alias("size"), F.count(F.lit(1))
                                                   .alias("rows")), "shard-groups")


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``size`` (UTF-8 bytes + 1), ``text_crc32``,
    ``shard``, ``slot`` (gapless from 0 in the shard) and ``g`` (the group's key)."""
    rows, groups = _sized_rows(docs, id_col, text_col)
    placed = rows.withColumn("shard", placement(groups, shards)(F.col("g")))
    total = groups.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()["rows"]
    spread = order_key(F.col("doc_id"), F.col("g"))
    return numbered(placed, ["shard"], [F.col("doc_id"), F.col("g")], spread, "slot", total)


def write_shards(docs: DataFrame, path: str, shards: int = 16, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Write the input rows (all columns) as ``<path>/shard=<n>/``, without a shuffle: the
    shard follows from the text alone."""
    _, groups = _sized_rows(docs, id_col, text_col)
    shard = placement(groups, shards)(group_key(F.col(f"`{text_col}`")))
    docs.drop("shard").withColumn("shard", shard).write.partitionBy("shard").parquet(path)
