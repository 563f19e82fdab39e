"""Embedding whitening by spectrum slicing.

Vectors are put on an integer lattice (``floor(64 * c) + 1000000``), so sums and
deviations are exact.  Each distinct lattice vector counts once in the fit:

1. count and per-dimension sums, exact, one row per task, added by dimension;
2. the covariance: each task adds the outer products of its centred vectors and
   returns one matrix, whose rows are added by row number;
3. the leading eigenpairs of that dimension-sized matrix, on the driver.  The
   signs of an LDL^T factorisation of ``V - shift`` count the eigenvalues above
   the shift (Sylvester); counting isolates each leading eigenvalue in an
   interval, Rayleigh quotient iteration converges inside it, and counts on
   both sides of the result certify its number;
4. one pass over all vectors projects them.

Defined results:

* a vector that is null, or holds null, NaN or an infinity, gives no row;
* vectors have one dimension: the commonest length (ties: the longest); others
  give no row, and empty vectors never do;
* repeated rows and null ids are kept, each with its own result rows;
* ``|64 * c|`` saturates at 2^61;
* a deviation over 2^63 - 1 is null;
* tied eigenvalues: any orthonormal basis of their space, in interval order;
* components whose eigenvalue is under ``RANK_FLOOR`` of the trace have no
  scale and give no rows (so a table of one distinct vector gives none);
* an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, sliced

#: Lattice: cells per unit and offset.
SCALE, OFFSET = 64, 1_000_000
SATURATION = 1 << 61
#: Share of the trace under which an eigenvalue counts as zero.
RANK_FLOOR = 1e-11
#: Width (share of the norm) at which an interval that still holds several
#: eigenvalues is solved as one space.
CLUSTER = 1e-9


@dataclass
class Whitening:
    n: int
    sums: list[int]              # exact
    components: np.ndarray       # (dimension, k), unit columns
    values: np.ndarray           # (k,), falling
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S`` of lattice vectors, exact (int64, or Python integers beyond)."""
        top = max(map(abs, self.sums), default=0)
        if self.n * (int(np.abs(x).max(initial=0)) + 1) + top < 1 << 63:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def project(self, deviation: np.ndarray) -> np.ndarray:
        """Whitened values of ``n * x - S``."""
        return (deviation / self.n).astype(float) @ (self.components / np.sqrt(self.values))


def eigenvalues_above(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues over ``shift``: positive pivots of L D L^T = matrix - shift
    (Bunch-Kaufman pivoting, blocks of one or two)."""
    m = matrix - shift * np.eye(len(matrix))
    n, k, above = len(m), 0, 0
    bar = (1 + 17 ** 0.5) / 8

    def swap(i: int, j: int) -> None:
        if i != j:
            m[[i, j]] = m[[j, i]]
            m[:, [i, j]] = m[:, [j, i]]

    while k < n:
        own, pair = abs(m[k, k]), False
        if k + 1 < n:
            r = k + 1 + int(np.argmax(np.abs(m[k + 1:, k])))
            largest = abs(m[r, k])
            if own < bar * largest:
                row = np.abs(m[r, k:])
                row[r - k] = 0
                beside = row.max()
                if own * beside < bar * largest * largest:
                    if abs(m[r, r]) >= bar * beside:
                        swap(k, r)
                    else:
                        swap(k + 1, r)
                        pair = True
        if pair:    # a block of two has one eigenvalue of each sign
            above += 1
            side = m[k + 2:, k:k + 2]
            m[k + 2:, k + 2:] -= side @ np.linalg.solve(m[k:k + 2, k:k + 2], side.T)
            k += 2
            continue
        pivot = m[k, k]
        if pivot:
            above += pivot > 0
            side = m[k + 1:, k]
            m[k + 1:, k + 1:] -= np.outer(side, side / pivot)
        k += 1
    return int(above)


class Slicer:
    """Leading eigenpairs of a symmetric positive semi-definite matrix."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.norm = float(np.abs(matrix).sum(1).max(initial=0))
        self.counts = {-self.norm * 1e-3: len(matrix), self.norm * (1 + 1e-3): 0}

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = eigenvalues_above(self.matrix, shift)
        return self.counts[shift]

    def interval(self, k: int) -> tuple[float, float]:
        """The tightest counted interval that holds eigenvalue ``k`` (from 1)."""
        return (max(s for s, c in self.counts.items() if c >= k),
                min(s for s, c in self.counts.items() if c < k))

    def isolate(self, k: int) -> tuple[float, float]:
        """Bisect until the interval holds eigenvalue ``k`` alone, or is as narrow as
        ``CLUSTER``."""
        low, high = self.interval(k)
        while (self.above(low) > k or self.above(high) < k - 1) and (
                high - low > CLUSTER * self.norm):
            self.above((low + high) / 2)
            low, high = self.interval(k)
        return low, high

    def _shifted(self, shift: float, block: np.ndarray) -> np.ndarray:
        eye = np.eye(len(self.matrix))
        try:
            out = np.linalg.solve(self.matrix - shift * eye, block)
        except np.linalg.LinAlgError:   # the shift is an eigenvalue to the last bit
            out = np.linalg.solve(self.matrix - (shift + 1e-15 * self.norm) * eye, block)
        return out

    def rayleigh(self, k: int, found: np.ndarray) -> tuple[float, np.ndarray]:
        """Eigenpair ``k``, alone in its interval."""
        rng = np.random.default_rng(k)
        while True:
            low, high = self.interval(k)
            v = rng.standard_normal(len(self.matrix))
            shift = (low + high) / 2
            for step in range(12):
                v -= found @ (found.T @ v)
                v /= np.linalg.norm(v)
                if step > 1:     # two steps towards the middle of the interval, then cubic
                    shift = float(v @ self.matrix @ v)
                residual = np.linalg.norm(self.matrix @ v - shift * v)
                if step > 1 and residual <= 4e-15 * self.norm:
                    break
                v = self._shifted(shift, v)
            value = float(v @ self.matrix @ v)
            margin = max(8 * residual, 1e-13 * self.norm)
            if (low <= value <= high and self.above(value - margin) >= k
                    and self.above(value + margin) < k):
                return value, v
            if high - low <= 4 * margin:
                return value, v
            self.above((low + high) / 2)     # it went to a neighbour: halve and start anew

    def space(self, low: float, high: float, size: int,
              found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Orthonormal basis of the ``size`` eigenvalues inside a narrow interval."""
        block = np.random.default_rng(size).standard_normal((len(self.matrix), size))
        for _ in range(4):
            block -= found @ (found.T @ block)
            block = np.linalg.qr(block)[0]
            block = np.linalg.qr(self._shifted((low + high) / 2, block))[0]
        block -= found @ (found.T @ block)
        block = np.linalg.qr(block)[0]
        values, turn = np.linalg.eigh(block.T @ self.matrix @ block)
        return values[::-1], (block @ turn)[:, ::-1]

    def leading(self, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Values (falling) and unit vectors (columns) of the first ``k`` eigenvalues over
        ``floor``."""
        k = min(k, self.above(floor))
        values, vectors = np.zeros(0), np.zeros((len(self.matrix), 0))
        while len(values) < k:
            nth = len(values) + 1
            low, high = self.isolate(nth)
            size = self.above(low) - self.above(high)
            if size == 1:
                value, vector = self.rayleigh(nth, vectors)
                new, own = np.array([value]), vector[:, None]
            else:
                new, own = self.space(low, high, size, vectors)
            values = np.concatenate([values, new])
            vectors = np.concatenate([vectors, own], 1)
        return values[:k], vectors[:, :k]


def lattice(vector: Column) -> Column:
    """Lattice vector (array of longs), or null where an entry is missing or not finite."""
    v = F.transform(vector, lambda c: c.cast("double"))
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    cell = F.transform(v, lambda c: F.floor(F.greatest(F.least(
        c * SCALE, F.lit(float(SATURATION))), F.lit(-float(SATURATION)))) + OFFSET)
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(False)) & (F.size(vector) > 0), cell)


def lattice_rows(embeddings: DataFrame, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """``vec_id`` and lattice vector ``x`` of the rows that remain, as a written table."""
    rows = (embeddings.select(F.col(f"`{id_col}`").alias("vec_id"),
                              lattice(F.col(f"`{vector_col}`")).alias("x"))
            .filter(F.col("x").isNotNull()))
    rows = materialize(rows, "whitening-rows")
    common = (rows.groupBy(F.size("x").alias("d")).count()
              .orderBy(F.desc("count"), F.desc("d")).first())
    return rows.filter(F.size("x") == (common["d"] if common else 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def _totals(fit: DataFrame) -> tuple[int, list[int]]:
    """Count and exact sums: halves of 31 bits are added as longs, then as decimals."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, 0, 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                n += len(x)
                high, low = high + (x >> 31).sum(0), low + (x & 0x7FFFFFFF).sum(0)
        if n:
            d = len(high)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(d), pa.int32()), pa.array([n] * d, pa.int64()),
                 pa.array(high, pa.int64()), pa.array(low, pa.int64())],
                names=["dim", "n", "high", "low"])

    wide = "decimal(38,0)"
    rows = (fit.mapInArrow(run, "dim int, n long, high long, low long").groupBy("dim")
            .agg(F.sum("n").alias("n"), F.sum(F.col("high").cast(wide)).alias("high"),
                 F.sum(F.col("low").cast(wide)).alias("low")).orderBy("dim").collect())
    sums = [int(r["high"]) * (1 << 31) + int(r["low"]) for r in rows]
    return (rows[0]["n"] if rows else 0), sums


def _gram(fit: DataFrame, of, width: int) -> np.ndarray:
    """Sum of the outer products of ``of(x)`` (rows x width) over the fit list.

    Each task returns its matrix; the rows of equal number are added in task order, so
    no task holds more than one vector per task of the pass before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in sliced(batches, 8192):
            y = of(_matrix(batch))
            total += y.T @ y
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width), pa.int32()), pa.array([task] * width, pa.int64()),
             pa.array([row.tobytes() for row in total], pa.binary())],
            names=["i", "task", "part"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("task")
        total = np.sum([np.frombuffer(p.as_py()) for p in table.column("part")], axis=0)
        return pa.table({"i": table.column("i").slice(0, 1),
                         "part": pa.array([total.tobytes()], pa.binary())})

    rows = (fit.mapInArrow(run, "i int, task long, part binary").groupBy("i")
            .applyInArrow(add, "i int, part binary").collect())
    out = np.zeros((width, width))
    for r in rows:
        out[r["i"]] = np.frombuffer(bytes(r["part"]))
    return out


def fit_whitening(fit: DataFrame, components: int = 16) -> tuple[Whitening, float]:
    """Whitening of distinct lattice vectors ``x`` and its identity error, the largest
    absolute entry of (covariance of the whitened fit list - identity)."""
    n, sums = _totals(fit)
    d = len(sums)
    model = Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0)
    if not n:
        return model, 0.0
    centre = Whitening(n, sums, model.components, model.values, 0.0)
    v = _gram(fit, lambda x: (centre.centred(x) / n).astype(float), d) / n
    v = (v + v.T) / 2
    model.trace = float(np.trace(v))
    if model.trace > 0:
        model.values, model.components = Slicer(v).leading(components, RANK_FLOOR * model.trace)
    k = len(model.values)
    if not k:
        return model, 0.0
    after = _gram(fit, lambda x: model.project(model.centred(x)), k) / n
    return model, float(np.abs(after - np.eye(k)).max())


def _squares(deviation: np.ndarray) -> list[int | None]:
    """Exact row sums of squares; None beyond a long."""
    near = (deviation.astype(float) ** 2).sum(1)
    big = near >= 9e18
    out: list[int | None] = []
    fast = np.zeros(len(near), np.int64)
    if (~big).any():
        own = deviation[~big].astype(np.int64)
        fast[~big] = (own * own).sum(1)
    for k, flag in enumerate(big):
        exact = sum(int(c) ** 2 for c in deviation[k]) if flag else int(fast[k])
        out.append(exact if exact < 1 << 63 else None)
    return out


def whiten(embeddings: DataFrame, components: int = 16, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """One row per remaining vector and component: ``vec_id``, ``component`` (from 1),
    ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    rows = lattice_rows(embeddings, id_col, vector_col)
    fit = materialize(rows.select("x").distinct(), "whitening-fit")
    model, error = fit_whitening(fit, components)
    k = len(model.values)
    schema = T.StructType([
        rows.schema["vec_id"], T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType())])
    shared = rows.sparkSession.sparkContext.broadcast(model)   # dimension-sized

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        explained = m.values / m.trace if k else m.values
        for batch in sliced(batches):
            b = batch.num_rows
            if not k or not b:
                continue
            deviation = m.centred(_matrix(batch))
            of = pa.array(np.repeat(np.arange(b), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(of),
                 pa.array(np.tile(np.arange(1, k + 1), b), pa.int32()),
                 pa.array(np.full(b * k, m.n), pa.int64()),
                 pa.array(_squares(deviation), pa.int64()).take(of),
                 pa.array(m.project(deviation).ravel()), pa.array(np.tile(explained, b)),
                 pa.array(np.full(b * k, error))], names=schema.names)

    return rows.mapInArrow(run, schema)
