"""Quality rules: text statistics and line labels from a linear-chain CRF.

Every line of a text that has a word is labelled content or boilerplate by
Viterbi decoding of a linear-chain conditional random field.  Its features are
shares of character classes, length, repetition and line ending.  A text is
kept if it passes the base rules and content lines hold at least ``min_share``
of its words.

The field is trained here on a bounded sample of labelled documents: at most
``train_docs`` documents (smallest hash of the id) and the first
``train_lines`` lines of each; every line carries its document's label.  Only
training is bounded, decoding covers all lines of all texts.

Cases: a null or blank text has no words and fails the base rules; without
labels of both classes every line is content; ids repeated in the labels train
once per row; repeated rows get equal results; an empty table gives an empty
result; extra columns are kept, a result column replaces an input column of
its name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import sliced

#: Documents and lines of each that training takes at most; longer texts give hashed runs of
#: lines from all their parts.  Labelling itself reads every line.
TRAIN_DOCS, TRAIN_LINES, TRAIN_RUNS = 2000, 64, 4
MIN_SHARE = 0.5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
CONTENT = 1
#: UTF-8 continuation bytes and ASCII white space: what is no code point of a word.
_NOT_POINTS = bytes(range(0x80, 0xC0)) + b" \t\n\x0b\x0c\r"
_CLASSES = (SYMBOLS, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?",
            b"@/\\_=+~^{}[]", b" \t\n\x0b\x0c\r")
N_FEATURES = len(_CLASSES) + 5

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()), T.StructField("base_failed", T.BooleanType()),
    T.StructField("content_share", T.DoubleType()), T.StructField("kept", T.BooleanType())])


@dataclass(frozen=True)
class LineField:
    """Weights of the chain: emission (features x 2), transition (2 x 2), start (2)."""

    emission: np.ndarray
    transition: np.ndarray
    start: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.scale) @ self.emission


def _all_content() -> LineField:
    """A field that labels every line content."""
    never = np.array([-1e9, 0.0])
    return LineField(np.zeros((N_FEATURES, 2)), np.array([never, never]), never,
                     np.zeros(N_FEATURES), np.ones(N_FEATURES))


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by windows of ``window`` words that occur twice or more."""
    n = len(words)
    if n <= window:
        return 0
    ids: dict[bytes, int] = {}
    seen = ids.setdefault
    a = np.fromiter((seen(w, len(ids)) for w in words), np.int64, n)
    base = len(ids)
    if base ** window < 1 << 62:
        key = a[:n - window + 1].copy()
        for k in range(1, window):
            key *= base
            key += a[k:n - window + 1 + k]
    else:  # join word by word, renumbering what was found
        key = a
        for k in range(1, window):
            key = np.unique(key[:n - k] * base + a[k:], return_inverse=True)[1].astype(np.int64)
    order = np.sort(key)
    if not (order[1:] == order[:-1]).any():
        return 0
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    edge = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(count[back] > 1)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def worded_lines(text: bytes) -> tuple[list[bytes], int]:
    """Lines with a word, and how many of them equal an earlier one."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return lines, len(lines) - len(set(lines))


def line_features(lines: list[bytes], starts: np.ndarray) -> np.ndarray:
    """Feature rows of the lines; ``starts`` are the first lines of the documents."""
    n = len(lines)
    out = np.zeros((n, N_FEATURES))
    if not n:
        return out
    size = np.fromiter(map(len, lines), np.int64, n)
    for k, chars in enumerate(_CLASSES):
        rest = np.fromiter((len(x.translate(None, chars)) for x in lines), np.int64, n)
        out[:, k] = (size - rest) / size
    k = len(_CLASSES)
    words = np.fromiter((len(x.split()) for x in lines), np.int64, n)
    out[:, k] = np.log1p(words)
    out[:, k + 1] = np.minimum(size / np.maximum(words, 1), 30.0)
    out[:, k + 2] = np.fromiter((x.rstrip()[-1:] in b".!?;:" for x in lines), bool, n)
    distinct = np.fromiter((len(set(x.split())) for x in lines), np.int64, n)
    out[:, k + 3] = distinct / np.maximum(words, 1)
    ends = np.append(starts[1:], n)
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        own: dict[bytes, int] = {}
        for x in lines[a:b]:
            own[x] = own.get(x, 0) + 1
        if len(own) < b - a:
            out[a:b, k + 4] = [own[x] > 1 for x in lines[a:b]]
    return out


def viterbi(scores: np.ndarray, starts: np.ndarray, field: LineField) -> np.ndarray:
    """Best label of each line; chains begin at ``starts`` and are decoded side by side."""
    n = len(scores)
    best = np.zeros((n, 2))
    back = np.zeros((n, 2), np.int8)
    label = np.zeros(n, np.int8)
    if not n:
        return label
    lengths = np.append(starts[1:], n) - starts
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    falling = -lengths
    best[starts] = field.start + scores[starts]
    active = lambda t: starts[:np.searchsorted(falling, -t, "left")]  # noqa: E731  chains longer than t
    for t in range(1, int(lengths[0])):
        at = active(t) + t
        step = best[at - 1][:, :, None] + field.transition
        back[at] = step.argmax(1)
        best[at] = step.max(1) + scores[at]
    last = starts + lengths - 1
    label[last] = best[last].argmax(1)
    for t in range(int(lengths[0]) - 1, 0, -1):
        at = active(t) + t
        label[at - 1] = back[at, label[at]]
    return label


def _forward_backward(scores, mask, start, transition):
    """Log partition, label and pair marginals of padded chains (batch x lines x 2)."""
    n, steps, _ = scores.shape
    alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
    alpha[:, 0] = start + scores[:, 0]
    for t in range(1, steps):
        new = np.logaddexp(alpha[:, t - 1, 0, None] + transition[0],
                           alpha[:, t - 1, 1, None] + transition[1]) + scores[:, t]
        alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
    for t in range(steps - 2, -1, -1):
        nxt = beta[:, t + 1] + scores[:, t + 1]
        new = np.logaddexp(nxt[:, 0, None] + transition[:, 0], nxt[:, 1, None] + transition[:, 1])
        beta[:, t] = np.where(mask[:, t + 1, None], new, beta[:, t + 1])
    z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
    single = np.exp(alpha + beta - z[:, None, None]) * mask[..., None]
    pair = np.exp(alpha[:, :-1, :, None] + transition + (beta + scores)[:, 1:, None, :]
                  - z[:, None, None, None]) * mask[:, 1:, None, None]
    return z, single, pair


def fit_field(features: list[np.ndarray], labels: list[np.ndarray], steps: int = 120,
              rate: float = 0.1, penalty: float = 1e-3) -> LineField:
    """Maximum-likelihood training by full-batch gradient steps (Adam), from zero weights."""
    features = [f for f in features if len(f)]
    labels = [x for x in labels if len(x)]
    if len({int(x) for y in labels for x in np.unique(y)}) < 2:
        return _all_content()
    flat = np.concatenate(features)
    mean, scale = flat.mean(0), flat.std(0)
    scale[scale < 1e-9] = 1.0
    n, long = len(features), max(map(len, features))
    x, y = np.zeros((n, long, N_FEATURES)), np.zeros((n, long), int)
    mask = np.zeros((n, long), bool)
    for k, (f, own) in enumerate(zip(features, labels, strict=True)):
        x[k, :len(f)], y[k, :len(f)], mask[k, :len(f)] = (f - mean) / scale, own, True
    gold = np.eye(2)[y] * mask[..., None]
    gold_pair = gold[:, :-1, :, None] * gold[:, 1:, None, :]
    # each class weighs the same, however rare it is
    share = np.array([(gold.sum((1, 2)) * (y[:, 0] == c)).sum() for c in (0, 1)])
    weight = (share.sum() / (2 * np.maximum(share, 1)))[y[:, 0]] / share.sum()
    w = [np.zeros((N_FEATURES, 2)), np.zeros((2, 2)), np.zeros(2)]
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    for i in range(1, steps + 1):
        _, single, pair = _forward_backward(x @ w[0], mask, w[2], w[1])
        d = (gold - single) * weight[:, None, None]
        grad = [np.einsum("nlf,nlc->fc", x, d),
                ((gold_pair - pair) * weight[:, None, None, None]).sum((0, 1)), d[:, 0].sum(0)]
        for k, g in enumerate(grad):
            g = g - penalty * w[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            w[k] = w[k] + rate * (m[k] / (1 - 0.9 ** i)) / (np.sqrt(v[k] / (1 - 0.999 ** i)) + 1e-9)
    return LineField(w[0], w[1], w[2], mean, scale)


def training_lines(key: Column, lines: Column, most: int, runs: int = TRAIN_RUNS) -> Column:
    """All lines up to ``most``; else a run of ``most / runs`` lines at a hashed place in each
    of ``runs`` equal parts of the text."""
    part, run = F.floor(F.size(lines) / runs).cast("int"), most // runs
    places = [k * part + 1 + F.pmod(F.xxhash64(key, F.lit(k)), (part - run + 1).cast("long")).cast("int")
              for k in range(runs)]
    return F.when(F.size(lines) <= most, lines).otherwise(
        F.concat(*[F.slice(lines, p, run) for p in places]))


def train_field(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", label_col: str = "quality",
                train_docs: int = TRAIN_DOCS, train_lines: int = TRAIN_LINES) -> LineField:
    """Fit the field on at most ``train_docs`` labelled documents."""
    order = F.xxhash64(F.col("__id"))
    picked = (labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__label"))
              .na.drop().orderBy(order, "__id", "__label").limit(train_docs))
    rows = (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
            .join(F.broadcast(picked), "__id")
            .select("__id", "__label", F.split("__text", "\n").alias("__lines"))
            .select("__id", "__label", training_lines(F.col("__id"), F.col("__lines"), train_lines)
                    .alias("__lines"))
            .orderBy(order, "__id", "__label").limit(train_docs).toArrow())
    features, gold = [], []
    for label, lines in zip(rows["__label"].to_pylist(), rows["__lines"].to_pylist(), strict=True):
        own = [x.encode() for x in lines or () if x]
        own = [x for x in own if not x.isspace()]
        features.append(line_features(own, np.zeros(1, np.int64)))
        gold.append(np.full(len(own), int(label)))
    return fit_field(features, gold)


def judge_texts(texts: list[bytes | None], field: LineField, min_share: float) -> list[list]:
    """The columns of RESULT for a batch of texts."""
    cols: list[list] = [[] for _ in RESULT]
    lines: list[bytes] = []
    starts, counts = [], []
    for text in texts:
        text = text or b""
        words = text.split()
        own, dup = worded_lines(text)
        repeat = repeat_words(words)
        failed = len(words) < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * len(words)
        for col, x in zip(cols, (len(words), len(text.translate(None, _NOT_POINTS)),
                                 len(text) - len(text.translate(None, SYMBOLS)), dup, repeat,
                                 failed), strict=False):
            col.append(x)
        starts.append(len(lines))
        counts.append(len(own))
        lines += own
    first, n = np.array(starts, np.int64), np.array(counts, np.int64)
    full = np.flatnonzero(n)
    share = np.zeros(len(texts))
    if len(full):
        begin = first[full]
        label = viterbi(field.scores(line_features(lines, begin)), begin, field)
        size = np.fromiter((len(x.split()) for x in lines), np.int64, len(lines))
        share[full] = (np.add.reduceat(size * (label == CONTENT), begin)
                       / np.add.reduceat(size, begin))
    cols[6] = share.tolist()
    cols[7] = [not f and s >= min_share for f, s in zip(cols[5], cols[6], strict=True)]
    return cols


def label_quality(docs: DataFrame, field: LineField, text_col: str = "text",
                  min_share: float = MIN_SHARE) -> DataFrame:
    """The input rows with the columns of RESULT."""
    added = {f.name for f in RESULT}
    keep = [c for c in docs.columns if c.lower() not in added]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = T.StructType([f for f in docs.schema.fields if f.name in keep] + RESULT.fields)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
        for part in sliced(batches):
            texts = part.column(text_col).cast(pa.binary()).to_pylist()
            cols = judge_texts(texts, field, min_share)
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in keep]
                + [pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                names=keep + [f.name for f in RESULT])

    return rows.mapInArrow(judge, schema)
