"""Quality scores by a factorisation machine.

Features of a text (the whole text is read):

* its words (white-space separated, A-Z lower-cased) hashed into ``BUCKETS``
  buckets, with value ``sqrt(count / words)``, so they have length one;
* structure statistics (:data:`STATISTICS`) and numeric metadata columns, each
  in one of ``BINS`` quantile bins of the training rows (a missing number has a
  bin of its own), all together of length one.

The score is ``sigmoid(w0 + <w, x> + sum over pairs <v_i, v_j> x_i x_j)``; the
pairs cost linear time by ``1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``.
The machine is fitted on at most ``train_docs`` labelled rows (the smallest
hashes of ids; documented bound of the fit only) in one task; the model has a fixed size,
and all rows are scored with it in one pass without a shuffle.

Defined results:

* null text counts as empty; empty texts are scored by their statistics;
* labels that are null or of a null id teach nothing; a document with several
  labels takes their majority, and teaches nothing at a draw;
* rows whose ``crc32(id) mod 3`` is 1 are held out and teach nothing; a null id
  is not held out and has no label;
* repeated rows each get a row; of a labelled id's rows each may teach;
* without labels of both classes every score is ``(positive + 1) / (labels + 2)``;
* other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, sliced

BUCKETS, BINS, RANK = 1 << 16, 8, 8
#: Most labelled rows the fit takes.
TRAIN_DOCS = 8_192
#: Bytes of a text whose words a task holds at once, and distinct words whose
#: buckets it remembers.
CHUNK, REMEMBERED = 1 << 22, 1 << 19

_UPPER = bytes(range(65, 91))
_LOWER = bytes.maketrans(_UPPER, bytes(range(97, 123)))
_SPACE = b" \t\n\x0b\x0c\r"
_MARKS = {"symbols": b"#*$%&|<>{}[]=_~^\\@/+", "digits": b"0123456789",
          "stops": b".,;:!?", "upper": _UPPER, "wide": bytes(range(128, 256))}
STATISTICS = ("words", "distinct words", "word length", *_MARKS, "lines", "line length",
              "repeated lines", "unended lines")


class _Buckets(dict):
    """Bucket of each word; forgets everything when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        out = self[word] = crc32(word) & (BUCKETS - 1)
        return out


def _chunks(text: bytes) -> Iterator[bytes]:
    """Parts of at least ``CHUNK`` bytes that no word crosses."""
    at = 0
    while len(text) - at > CHUNK:
        end = at + CHUNK
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def word_buckets(text: bytes, buckets: dict) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct word buckets of a text, their counts, and its number of words."""
    total, n = None, 0
    for part in _chunks(text):
        own = np.array([buckets[w] for w in part.translate(_LOWER).split()], np.int32)
        n += len(own)
        if len(text) <= CHUNK:
            return *np.unique(own, return_counts=True), n
        counts = np.bincount(own, minlength=BUCKETS)
        total = counts if total is None else total + counts
    index = np.flatnonzero(total)
    return index.astype(np.int32), total[index], n


def structure(text: bytes, n_words: int, n_distinct: int) -> list[float]:
    """The values of STATISTICS (shares of words, bytes or lines)."""
    size = max(len(text), 1)
    lines = [s for s in text.split(b"\n") if s and not s.isspace()]
    n = max(len(lines), 1)
    marks = [(len(text) - len(text.translate(None, m))) / size for m in _MARKS.values()]
    letters = len(text.translate(None, _SPACE))
    return [float(n_words), n_distinct / max(n_words, 1), letters / max(n_words, 1), *marks,
            float(len(lines)), len(text) / n, 1 - len(set(lines)) / n,
            sum(s.rstrip()[-1:] not in b".!?:" for s in lines) / n]


@dataclass
class Machine:
    bias: float
    linear: np.ndarray           # (features,)
    factors: np.ndarray          # (features, rank)
    edges: list[np.ndarray]      # bin edges per statistic and metadata column

    def features(self, words: list, numbers: np.ndarray) -> tuple[np.ndarray, ...]:
        """Rows of (buckets, counts, words) and numbers -> start, index, value arrays."""
        bins = binned(numbers, self.edges)
        return sparse_rows(words, bins)

    def raw(self, start: np.ndarray, index: np.ndarray, value: np.ndarray) -> np.ndarray:
        vx = self.factors[index] * value[:, None]
        total = np.add.reduceat(vx, start)
        square = np.add.reduceat((vx * vx).sum(1), start)
        return (self.bias + np.add.reduceat(self.linear[index] * value, start)
                + ((total * total).sum(1) - square) / 2)


def binned(numbers: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Feature numbers (after the word buckets) of the statistics' bins."""
    out = np.zeros(numbers.shape, np.int32)
    for k, e in enumerate(edges):
        missing = np.isnan(numbers[:, k])
        own = 1 + np.searchsorted(e, np.where(missing, 0, numbers[:, k]), side="right")
        out[:, k] = BUCKETS + k * (BINS + 1) + np.where(missing, 0, own)
    return out


def sparse_rows(words: list, bins: np.ndarray) -> tuple[np.ndarray, ...]:
    index, value, size = [], [], np.zeros(len(words), np.int64)
    unit = np.full(bins.shape[1], bins.shape[1] ** -0.5)
    for k, (own, counts, n) in enumerate(words):
        index += [own, bins[k]]
        value += [np.sqrt(counts / max(n, 1)), unit]
        size[k] = len(own) + len(unit)
    start = np.cumsum(size) - size
    return start, np.concatenate(index), np.concatenate(value)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_machine(words: list, numbers: np.ndarray, labels: np.ndarray, epochs: int = 12,
                rate: float = 0.1, penalty: float = 1e-5, batch: int = 64,
                seed: int = 13) -> Machine:
    """Logistic loss, AdaGrad on minibatches, rows in seeded order."""
    n, columns = len(labels), numbers.shape[1]
    size = BUCKETS + columns * (BINS + 1)
    rng = np.random.default_rng(seed)
    positive = int(labels.sum())
    prior = float(np.log((positive + 1) / (n - positive + 1)))
    edges = [np.unique(np.quantile(c[~np.isnan(c)], np.arange(1, BINS) / BINS))
             if (~np.isnan(c)).any() else np.zeros(0) for c in numbers.T]
    if not 0 < positive < n:
        return Machine(prior, np.zeros(size), np.zeros((size, RANK)), edges)
    m = Machine(prior, np.zeros(size), rng.normal(0, 0.05, (size, RANK)), edges)
    bins = binned(numbers, edges)
    seen_w, seen_v, seen_0 = np.full(size, 1e-3), np.full((size, RANK), 1e-3), 1e-3
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, batch):
            rows = order[at:at + batch]
            start, index, value = sparse_rows([words[r] for r in rows], bins[rows])
            doc = np.repeat(np.arange(len(rows)), np.diff(np.append(start, len(index))))
            g = (sigmoid(m.raw(start, index, value)) - labels[rows]) / len(rows)
            vx = m.factors[index] * value[:, None]
            total = np.add.reduceat(vx, start)
            touched, slot = np.unique(index, return_inverse=True)
            gw = np.bincount(slot, g[doc] * value) + penalty * m.linear[touched]
            gv = np.zeros((len(touched), RANK))
            np.add.at(gv, slot, (g[doc] * value)[:, None] * (total[doc] - vx))
            gv += penalty * m.factors[touched]
            seen_w[touched] += gw * gw
            seen_v[touched] += gv * gv
            seen_0 += g.sum() ** 2
            m.linear[touched] -= rate * gw / np.sqrt(seen_w[touched])
            m.factors[touched] -= rate * gv / np.sqrt(seen_v[touched])
            m.bias -= rate * g.sum() / np.sqrt(seen_0)
    return m


def _read(batch: pa.RecordBatch, metadata: Sequence[str],
          buckets: dict) -> tuple[list, np.ndarray]:
    """Words and numbers of the rows of a batch with a column ``__text``."""
    words, numbers = [], np.full((batch.num_rows, len(STATISTICS) + len(metadata)), np.nan)
    for k, text in enumerate(batch.column("__text").cast(pa.binary())):
        text = text.as_py() or b""
        words.append(word_buckets(text, buckets))
        numbers[k, :len(STATISTICS)] = structure(text, words[-1][2], len(words[-1][0]))
    for k in range(len(metadata)):
        numbers[:, len(STATISTICS) + k] = batch.column(f"__m{k}").to_numpy(zero_copy_only=False)
    return words, numbers


def _inputs(docs: DataFrame, id_col: str, text_col: str, metadata: Sequence[str]) -> list[Column]:
    numbers = [F.col(f"`{c}`").cast("double").alias(f"__m{k}") for k, c in enumerate(metadata)]
    return [F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("__text"), *numbers]


def fold(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 3


def train_machine(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "quality",
                  metadata: Sequence[str] = ("n_chars",), train_docs: int = TRAIN_DOCS) -> Machine:
    """Fit on at most ``train_docs`` labelled rows that are not held out."""
    spark = docs.sparkSession
    key, label = F.col(f"`{id_col}`"), F.col(f"`{label_col}`").cast("double")
    taught = (labels.select(key.alias("doc_id"), label.alias("y")).na.drop()
              .filter(fold(F.col("doc_id")) != 1)
              .groupBy("doc_id").agg(F.avg("y").alias("y")).filter("y <> 0.5")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
              .select(F.col("doc_id").alias("__id"), (F.col("y") > 0.5).cast("int").alias("__y")))
    taught = materialize(taught, "machine-labels")
    rows = (docs.select(*_inputs(docs, id_col, text_col, metadata))
            .join(F.broadcast(taught), F.col("doc_id") == F.col("__id")))   # train_docs at most

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _Buckets()
        for batch in sliced(batches):
            words, numbers = _read(batch, metadata, buckets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("__y"), pa.array([w.tobytes() for w, _, _ in words], pa.binary()),
                 pa.array([c.astype(np.int64).tobytes() for _, c, _ in words], pa.binary()),
                 pa.array([n for _, _, n in words], pa.int64()),
                 pa.array([x.tobytes() for x in numbers], pa.binary())],
                names=["y", "words", "counts", "n", "numbers"])

    table = rows.mapInArrow(features, "y int, words binary, counts binary, n long, numbers binary")
    table = materialize(table, "machine-rows")
    order = F.xxhash64("words", "counts", "numbers")
    table = table.orderBy(order, "words", "counts", "numbers", "y").limit(train_docs)
    columns = len(STATISTICS) + len(metadata)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, numbers, y = [], [], []
        for r in (r for b in batches for r in b.to_pylist()):
            words.append((np.frombuffer(r["words"], np.int32),
                          np.frombuffer(r["counts"], np.int64), r["n"]))
            numbers.append(np.frombuffer(r["numbers"]))
            y.append(r["y"])
        m = fit_machine(words, np.array(numbers).reshape(-1, columns), np.array(y, float))
        yield pa.RecordBatch.from_arrays(
            [pa.array([m.bias]), pa.array([m.linear.tobytes()], pa.binary()),
             pa.array([m.factors.tobytes()], pa.binary()),
             pa.array([[e.tobytes() for e in m.edges]], pa.list_(pa.binary()))],
            names=["bias", "linear", "factors", "edges"])

    # one task by design: the fit's rows are bounded by train_docs
    fitted = table.repartition(1).sortWithinPartitions(order, "words", "counts", "numbers", "y")
    row = materialize(fitted.mapInArrow(
        fit, "bias double, linear binary, factors binary, edges array<binary>"), "machine").first()
    if row is None:
        return fit_machine([], np.zeros((0, columns)), np.zeros(0))
    return Machine(row["bias"], np.frombuffer(bytes(row["linear"])),
                   np.frombuffer(bytes(row["factors"])).reshape(-1, RANK),
                   [np.frombuffer(bytes(e)) for e in row["edges"]])


def score_quality(docs: DataFrame, machine: Machine, id_col: str = "doc_id",
                  text_col: str = "text", metadata: Sequence[str] = ("n_chars",)) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    rows = docs.select(*_inputs(docs, id_col, text_col, metadata))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(machine)   # fixed size, 5 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, m = _Buckets(), shared.value
        for batch in sliced(batches):
            if not batch.num_rows:
                continue
            score = sigmoid(m.raw(*m.features(*_read(batch, metadata, buckets))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)],
                                             names=schema.names)

    return rows.mapInArrow(run, schema).select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
