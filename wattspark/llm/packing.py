"""Best-two-fit packing of token sequences.

Texts are tokenized, get an end token, and only those longer than ``capacity``
are cut into pieces of that length (the first may be shorter).  Pieces are
packed bin by bin: the bin is filled greedily with the largest pieces that
fit; then its smallest piece is replaced by the two unpacked pieces that fill
the expanded gap most tightly, if they fill it better than that piece does.  A
group in which greedy filling alone needs fewer bins is packed that way.

Packing works on counts of equal lengths.  Pieces are dealt by hash into
groups of about ``GROUP_PIECES``; each group is packed in one task, so a group
costs at most one bin that is not full.

The ids are those of the ``tokenizers`` vocabulary file.  ``tiktoken`` computes
them from the same vocabulary as ranks, about five times faster; a text that
holds the string of a special token goes through ``tokenizers`` itself.  Tests
compare both.

Cases: a null text counts as empty and is one piece, its end token; a text is
never dropped or shortened; repeated rows are packed one by one; an empty table
gives an empty result; extra columns are kept by ``pack`` and ignored by
``token_pieces``.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import sliced

CAPACITY = 1024
END_ID = 2
GROUP_PIECES = 1 << 15


def vocabulary_paths(name: str = "byte_bpe_50k") -> tuple[str, str]:
    """The vocabulary file and its ranks."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken")


def encoder(vocabulary: str, ranks: str) -> Callable[[str], bytes]:
    """A function from a text to its ids as little-endian unsigned 32-bit integers."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                             special_tokens={})

    def encode(text: str) -> bytes:
        if any(s in text for s in special):
            ids = tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = fast.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()

    return encode


def token_pieces(docs: DataFrame, paths: tuple[str, str] | None = None, capacity: int = CAPACITY,
                 end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces: ``doc_id``, ``piece``, ``start``, ``length``, ``ids`` (uint32 bytes) and
    ``row`` (a number of the input row, for spreading pieces)."""
    vocabulary, ranks = paths or vocabulary_paths()
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([
        T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("row", T.LongType())])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks)
        row = TaskContext.get().partitionId() << 36
        for batch in sliced(batches):
            take, piece, start, length, ids, no = [], [], [], [], [], []
            for k, text in enumerate(batch.column("text")):
                data = encode(text.as_py() or "") + end
                n, pos, part = len(data) // 4, 0, 0
                while pos < n:
                    size = (n % capacity or capacity) if part == 0 else capacity
                    take.append(k)
                    piece.append(part)
                    start.append(pos)
                    length.append(size)
                    ids.append(data[4 * pos:4 * (pos + size)])
                    no.append(row)
                    pos, part = pos + size, part + 1
                row += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(take, pa.int32())),
                 pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(no, pa.int64())], names=schema.names)

    return rows.mapInArrow(run, schema)


def best_two_fit(counts: np.ndarray, capacity: int, replace: bool = True) -> list[list[int]]:
    """Bins (lists of lengths) for ``counts[n]`` pieces of each length ``n``; without
    ``replace`` the bins are only filled greedily."""
    left = counts.tolist()
    mask = sum(1 << n for n, c in enumerate(left) if c and n)
    # bit (capacity - n) of the mirror is set where length n is left: sums become shifts
    mirror = sum(1 << (capacity - n) for n, c in enumerate(left) if c and n)
    bins = []

    def use(n: int) -> None:
        nonlocal mask, mirror
        left[n] -= 1
        if not left[n]:
            mask &= ~(1 << n)
            mirror &= ~(1 << (capacity - n))

    def give_back(n: int) -> None:
        nonlocal mask, mirror
        left[n] += 1
        mask |= 1 << n
        mirror |= 1 << (capacity - n)

    while mask:
        gap, own = capacity, []
        while fits := mask & ((1 << (gap + 1)) - 1):
            n = fits.bit_length() - 1
            use(n)
            own.append(n)
            gap -= n
        if replace and gap and mask:
            smallest = own[-1]
            room = gap + smallest
            for total in range(room, smallest, -1):
                # lengths a with a and total - a both left
                shift = capacity - total
                pairs = mask & (mirror >> shift if shift >= 0 else mirror << -shift)
                half = total // 2
                if total % 2 == 0 and left[half] < 2:
                    pairs &= ~(1 << half)
                if pairs:
                    a = pairs.bit_length() - 1
                    own.pop()
                    give_back(smallest)
                    use(a)
                    use(total - a)
                    own += [a, total - a]
                    break
        bins.append(own)
    return bins


def _place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece."""
    counts = np.bincount(lengths, minlength=capacity + 1)
    # in a small group the replacements can use up the short pieces too early
    bins = min((best_two_fit(counts, capacity, r) for r in (True, False)), key=len)
    flat = np.array([n for own in bins for n in own], np.int64)
    sizes = np.array([len(own) for own in bins], np.int64)
    number = np.repeat(np.arange(len(bins)), sizes)
    before = np.cumsum(flat) - flat
    offset = before - np.repeat(before[np.cumsum(sizes) - sizes], sizes)
    # the i-th slot of a length gets the i-th piece of this length
    slots, pieces = np.argsort(flat, kind="stable"), np.argsort(lengths, kind="stable")
    out_bin, out_offset = np.empty(len(flat), np.int64), np.empty(len(flat), np.int64)
    out_bin[pieces], out_offset[pieces] = number[slots], offset[slots]
    return out_bin, out_offset


def pack(pieces: DataFrame, total: int, capacity: int = CAPACITY,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (``row``, ``piece``, ``length`` and any others) with ``sequence_id`` and
    ``offset``; ``total`` is their number."""
    groups = max(1, round(total / group_pieces))
    rows = pieces.drop("sequence_id", "offset").withColumn(
        "__group", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).cast("int"))
    schema = T.StructType([f for f in rows.schema.fields if f.name != "__group"] + [
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("row", "ascending"),
                               ("piece", "ascending")])
        number, offset = _place(table.column("length").to_numpy(), capacity)
        group = table.column("__group")[0].as_py()
        return (table.drop_columns("__group")
                .append_column("sequence_id", pa.array(number + (group << 32)))
                .append_column("offset", pa.array(offset)))

    return rows.groupBy("__group").applyInArrow(run, schema)
