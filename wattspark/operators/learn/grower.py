"""Regression forests of unlimited depth.

A hybrid grower.  While a node holds more than ``finish_rows`` rows it is split from
histograms: tasks route their rows through the trees so far (a broadcast of the few
large nodes), add up (weight, weighted label) per bin, and one group per node adds the tasks'
histograms and picks the split.  A node of at most ``finish_rows`` rows is finished
exactly in one group: every threshold between neighbouring values of every feature is
tried, level by level over all its nodes at once, until labels or features are equal.

Splits minimise the squared error; ties go to the first feature, then to the lowest
threshold; a row goes left where ``x <= threshold``.  Bins of large nodes are quantiles of
the whole table; a large node that lies inside one bin of every feature gets equal-width
bins over its own range, so it is always split further or is a leaf.

The trees together have about as many leaves as the training set has rows, so the model is a
table of nodes, not a driver object: ``(tree, part, node)`` names a node, part -1 holds
the large nodes, other parts are subtrees finished in one group.  Bootstrap weights are
Poisson(1) draws from (seed, tree, row number); rows are numbered in the order of
their content, so equal input gives equal trees on any cluster.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspark.operators.learn.dense import list_matrix
from wattspark.operators.numbering import number_rows
from wattspark.operators.select import col
from wattspark.session import scratch_path

#: Largest node finished in one group, bins of a large node, trees grown in one pass, bytes
#: of histograms a task holds, and largest model (nodes) that is broadcast for scoring.
FINISH_ROWS, BINS, TREE_GROUP = 100_000, 256, 16
HISTOGRAM_BYTES, BROADCAST_NODES = 64 << 20, 1_000_000
TOP = -1
_NODES = ("tree int, part long, node long, feature int, threshold double, left_part long, "
          "left_node long, right_part long, right_node long, value double, weight double, "
          "gain double")


@dataclass
class GrownForest:
    """``nodes``: one row per node; ``feature`` is null at a leaf; ``gain`` is the fall of the
    squared error by a split."""

    nodes: DataFrame
    features: list[str]
    num_trees: int


def _weights(pos: np.ndarray, tree: int, seed: int, bootstrap: bool) -> np.ndarray:
    """Poisson(1) weight of each row in a tree (1 without bootstrap)."""
    if not bootstrap:
        return np.ones(len(pos))
    with np.errstate(over="ignore"):
        z = (pos.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
             + np.uint64((seed * 1_000_003 + tree + 1) % (1 << 64)) * np.uint64(0xD1B54A32D192ED03))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
        z ^= z >> np.uint64(31)
    u = (z >> np.uint64(11)).astype(float) / (1 << 53)
    term = np.exp(-1.0)
    steps = [term]
    for k in range(1, 16):
        term /= k
        steps.append(steps[-1] + term)
    return np.searchsorted(steps, u, side="right").astype(float)


def best_splits(xs, ws, wy, node, weight, total):
    """Best boundary per node of one feature: rows are sorted by (node, x).

    Returns (score, index of the row left of the boundary) per node; score -inf without one."""
    count = len(weight)
    starts = np.searchsorted(node, np.arange(count))
    cw, cy = np.cumsum(ws), np.cumsum(wy)
    base_w, base_y = (np.append(0.0, c)[starts] for c in (cw, cy))
    left_w, left_y = cw - base_w[node], cy - base_y[node]
    right_w, right_y = weight[node] - left_w, total[node] - left_y
    inside = np.append((node[1:] == node[:-1]) & (xs[1:] > xs[:-1]), False)
    score = np.full(len(xs), -np.inf)
    k = np.flatnonzero(inside)
    score[k] = left_y[k] ** 2 / left_w[k] + right_y[k] ** 2 / right_w[k]
    best = np.maximum.reduceat(score, starts)
    at = np.flatnonzero(inside & (score == best[node]))
    index = np.full(count, -1)
    owner, first = np.unique(node[at], return_index=True)
    index[owner] = at[first]
    return best, index


def grow_exact(x: np.ndarray, y: np.ndarray, w: np.ndarray,
               max_depth: int | None = None) -> dict[str, np.ndarray]:
    """The whole tree of one node's rows: arrays by node, root 0 (children -1 at a leaf)."""
    shift = np.rint(np.average(y, weights=w))      # whole, so sums of whole labels stay exact
    yc = y - shift
    out: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value",
                                            "weight", "gain")}
    orders = [np.argsort(x[:, f], kind="stable") for f in range(x.shape[1])]
    node, made, depth = np.zeros(len(y), np.int64), 1, 0
    while len(orders[0]) if orders else False:
        count = int(node.max()) + 1 if depth else 1
        act = orders[0]
        weight = np.bincount(node[act], w[act], count)
        total = np.bincount(node[act], w[act] * yc[act], count)
        low, high = np.full(count, np.inf), np.full(count, -np.inf)
        np.minimum.at(low, node[act], yc[act])
        np.maximum.at(high, node[act], yc[act])
        best = np.full(count, -np.inf)
        feature, threshold = np.full(count, -1), np.zeros(count)
        for f, rows in enumerate(orders):
            ids = node[rows].astype(np.uint16) if count <= 1 << 16 else node[rows]    # radix sort
            rows = orders[f] = rows[np.argsort(ids, kind="stable")]
            xs = x[rows, f]
            score, at = best_splits(xs, w[rows], w[rows] * yc[rows], node[rows], weight, total)
            take = np.flatnonzero((at >= 0) & (score > best))
            best[take], feature[take] = score[take], f
            a, b = xs[at[take]], xs[np.minimum(at[take] + 1, len(xs) - 1)]
            middle = a / 2 + b / 2
            threshold[take] = np.where((middle >= a) & (middle < b), middle, a)
        split = (feature >= 0) & (low < high)
        if max_depth is not None and depth >= max_depth:
            split[:] = False
        child = np.cumsum(split) - 1
        out["feature"].append(np.where(split, feature, -1))
        out["threshold"].append(threshold)
        out["left"].append(np.where(split, made + 2 * child, -1))
        out["right"].append(np.where(split, made + 2 * child + 1, -1))
        out["value"].append(shift + total / weight)
        out["weight"].append(weight)
        out["gain"].append(np.where(split, np.maximum(best - total ** 2 / weight, 0), 0.0))
        made += 2 * int(split.sum())
        keep = split[node]
        goes = np.zeros(len(y), np.int64)
        live = orders[0][keep[orders[0]]]
        own = node[live]
        goes[live] = 2 * child[own] + (x[live, feature[own]] > threshold[own])
        orders = [rows[keep[rows]] for rows in orders]
        node, depth = goes, depth + 1
    return {k: np.concatenate(v) for k, v in out.items()}


@dataclass
class _Top:
    """The large nodes of the trees: one list per tree, on the driver."""

    feature: dict[int, list] = field(default_factory=dict)
    threshold: dict[int, list] = field(default_factory=dict)
    children: dict[int, list] = field(default_factory=dict)    # (left, right); None: below is a part
    stats: dict[int, list] = field(default_factory=dict)       # (value, weight, gain)

    def add(self, tree: int) -> int:
        for d, v in ((self.feature, -1), (self.threshold, 0.0), (self.children, None),
                     (self.stats, (0.0, 0.0, 0.0))):
            d.setdefault(tree, []).append(v)
        return len(self.feature[tree]) - 1

    def route(self, tree: int, x: np.ndarray) -> np.ndarray:
        """The node of the tree's top that each row ends in."""
        at = np.zeros(len(x), np.int64)
        if tree not in self.feature:
            return at
        feature, cut = np.array(self.feature[tree]), np.array(self.threshold[tree])
        pairs = np.array([c or (0, 0) for c in self.children[tree]])
        live = np.flatnonzero(feature[at] >= 0)
        while len(live):
            own = at[live]
            at[live] = pairs[own, (x[live, feature[own]] > cut[own]).astype(int)]
            live = live[feature[at[live]] >= 0]
        return at


def _rows_by_node(at: np.ndarray, keep: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The kept rows of each node that has any, in order, without a pass over all rows per node."""
    kept = np.flatnonzero(keep)
    order = kept[np.argsort(at[kept], kind="stable")]
    nodes, first = np.unique(at[order], return_index=True)
    yield from zip(nodes.tolist(), np.split(order, first[1:]), strict=False)


def _histograms(rows: DataFrame, top: _Top, wanted: list[tuple], edges: np.ndarray, seed: int,
                bootstrap: bool) -> list:
    """The best binned split of each wanted (tree, node, own edges or None)."""
    spark, width = rows.sparkSession, len(edges)
    bins = edges.shape[1] + 1
    shared = spark.sparkContext.broadcast((top, wanted))
    flat = 2 * width * bins

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, wanted = shared.value
        total = np.zeros((len(wanted), flat + 2 * width))
        total[:, flat:flat + width], total[:, flat + width:] = np.inf, -np.inf
        slots: dict[int, dict[int, int]] = {}
        for k, (tree, node, _) in enumerate(wanted):
            slots.setdefault(tree, {})[node] = k
        seen = False
        for batch in batches:
            if not batch.num_rows:
                continue
            seen = True
            pos, x, y = (batch.column("pos").to_numpy(), list_matrix(batch.column("x")),
                         batch.column("y").to_numpy())
            common = [np.searchsorted(edges[f], x[:, f]) for f in range(width)]
            for tree, nodes in slots.items():
                w, at = _weights(pos, tree, seed, bootstrap), top.route(tree, x)
                for node, r in _rows_by_node(at, w > 0):
                    k = nodes.get(node)
                    if k is None:
                        continue
                    own, wr, wy = wanted[k][2], w[r], w[r] * y[r]
                    for f in range(width):
                        b = common[f][r] if own is None else np.searchsorted(own[f], x[r, f])
                        s = 2 * f * bins
                        total[k, s:s + bins] += np.bincount(b, wr, bins)
                        total[k, s + bins:s + 2 * bins] += np.bincount(b, wy, bins)
                    ends = total[k, flat:]
                    ends[:width] = np.minimum(ends[:width], x[r].min(0))
                    ends[width:] = np.maximum(ends[width:], x[r].max(0))
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(wanted)), pa.int32()),
                 pa.array([t.tobytes() for t in total], pa.binary())], names=["slot", "part"])

    def choose(table: pa.Table) -> pa.Table:
        slot = table.column("slot")[0].as_py()
        parts = np.array([np.frombuffer(p.as_py()) for p in table.column("part")])
        total = parts[:, :flat].sum(0)
        low = parts[:, flat:flat + width].min(0)
        high = parts[:, flat + width:].max(0)
        own = shared.value[1][slot][2]
        best, choice = -np.inf, None
        for f in range(width):
            hw, hy = total[2 * f * bins:2 * (f + 1) * bins].reshape(2, bins)
            cw, cy = np.cumsum(hw)[:-1], np.cumsum(hy)[:-1]
            weight, label = hw.sum(), hy.sum()
            cut = (edges if own is None else own)[f]
            for i in np.flatnonzero((cw > 0) & (weight - cw > 0)):
                score = cy[i] ** 2 / cw[i] + (label - cy[i]) ** 2 / (weight - cw[i])
                if score > best:
                    best, choice = score, (f, float(cut[i]), cw[i], cy[i], weight - cw[i], label - cy[i])
        weight, label = total[:bins].sum(), total[bins:2 * bins].sum()
        f, cut, *sides = choice or (-1, 0.0, 0.0, 0.0, 0.0, 0.0)
        gain = max(best - label ** 2 / weight, 0.0) if choice else 0.0
        return pa.table({"slot": pa.array([slot], pa.int32()), "feature": pa.array([f], pa.int32()),
                         "threshold": [cut], "left_w": [sides[0]], "right_w": [sides[2]],
                         "weight": [float(weight)], "label": [float(label)], "gain": [float(gain)],
                         "low": [low.tolist()], "high": [high.tolist()]})

    return (rows.mapInArrow(count, "slot int, part binary").groupBy("slot").applyInArrow(
        choose, "slot int, feature int, threshold double, left_w double, right_w double, weight double, "
                "label double, gain double, low array<double>, high array<double>").collect())


def _grow_top(rows: DataFrame, n: int, trees: list[int], width: int, seed: int, bootstrap: bool,
              finish_rows: int, bins: int, max_depth: int | None) -> _Top:
    """Split nodes of more than ``finish_rows`` rows; the rest hangs below as parts."""
    top = _Top()
    if n <= finish_rows:
        return top
    probabilities = (np.arange(1, bins) / bins).tolist()
    found = rows.agg(*[F.percentile_approx(F.col("x")[f], probabilities, 10_000).alias(f"q{f}")
                       for f in range(width)]).first()
    edges = np.array(found, float).reshape(width, bins - 1)
    open_nodes = [(t, top.add(t), None, 0) for t in trees]
    at_once = max(1, HISTOGRAM_BYTES // (16 * width * (bins + 1)))
    while open_nodes:
        now, open_nodes = open_nodes[:at_once], open_nodes[at_once:]
        for r in _histograms(rows, top, [o[:3] for o in now], edges, seed, bootstrap):
            tree, node, own, depth = now[r["slot"]]
            value = r["label"] / r["weight"] if r["weight"] else 0.0
            top.stats[tree][node] = (value, r["weight"], r["gain"])
            low, high = np.array(r["low"]), np.array(r["high"])
            if r["feature"] < 0:
                if (low < high).any() and own is None:     # inside one bin: finer bins of its own
                    share = np.arange(1, bins)[None, :] / bins
                    finer = low[:, None] + (high - low)[:, None] * share
                    open_nodes.append((tree, node, finer, depth))
                # else one point: a leaf, whatever its labels
                continue
            top.feature[tree][node], top.threshold[tree][node] = r["feature"], r["threshold"]
            top.children[tree][node] = (top.add(tree), top.add(tree))
            for child, weight in zip(top.children[tree][node], (r["left_w"], r["right_w"])):
                if weight > finish_rows and (max_depth is None or depth + 1 < max_depth):
                    open_nodes.append((tree, child, None, depth + 1))
                else:
                    top.children[tree][child] = None
                    top.stats[tree][child] = (0.0, -float(depth + 1), 0.0)    # a part below
    return top


def _finish(rows: DataFrame, top: _Top, trees: list[int], seed: int, bootstrap: bool,
            max_depth: int | None) -> DataFrame:
    """The nodes of all parts: rows are dealt by (tree, part), each group is one subtree."""
    shared = rows.sparkSession.sparkContext.broadcast(top)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = shared.value
        for batch in batches:
            pos, x = batch.column("pos").to_numpy(), list_matrix(batch.column("x"))
            for tree in trees:
                w, at = _weights(pos, tree, seed, bootstrap), top.route(tree, x)
                if tree in top.stats:     # rows that end in a finished leaf of the top stay out
                    weight = np.array([s[1] for s in top.stats[tree]])
                    w = np.where(weight[at] < 0, w, 0)
                r = pa.array(np.flatnonzero(w > 0))
                if len(r):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(r), tree), pa.int32()), pa.array(at).take(r),
                         pa.array(w).take(r), batch.column("pos").take(r),
                         batch.column("x").take(r), batch.column("y").take(r)],
                        names=["tree", "part", "w", "pos", "x", "y"])

    def grow(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos").combine_chunks()
        tree, part = table.column("tree")[0].as_py(), table.column("part")[0].as_py()
        top = shared.value
        left = None
        if max_depth is not None:
            left = max_depth - (int(-top.stats[tree][part][1]) if tree in top.stats else 0)
        x = list_matrix(table.column("x").chunk(0))
        t = grow_exact(x, table.column("y").to_numpy(), table.column("w").to_numpy(), left)
        n, inner = len(t["feature"]), t["feature"] >= 0
        own = np.full(n, part)
        return pa.table({
            "tree": pa.array(np.full(n, tree), pa.int32()), "part": pa.array(own),
            "node": pa.array(np.arange(n)), "feature": pa.array(t["feature"], pa.int32(), mask=~inner),
            "threshold": pa.array(t["threshold"], mask=~inner),
            "left_part": pa.array(own, mask=~inner), "left_node": pa.array(t["left"], mask=~inner),
            "right_part": pa.array(own, mask=~inner), "right_node": pa.array(t["right"], mask=~inner),
            "value": pa.array(t["value"]), "weight": pa.array(t["weight"]), "gain": pa.array(t["gain"])})

    dealt = rows.mapInArrow(
        deal, "tree int, part long, w double, pos long, x array<double>, y double")
    return dealt.groupBy("tree", "part").applyInArrow(grow, _NODES)


def _top_rows(top: _Top) -> list[tuple]:
    out = []
    for tree, features in top.feature.items():
        for node, f in enumerate(features):
            value, weight, gain = top.stats[tree][node]
            if weight < 0:      # the root of a part: its nodes are in the part
                continue
            ends: list = [None] * 4
            if f >= 0:
                ends = []
                for child in top.children[tree][node]:
                    part = top.stats[tree][child][1] < 0
                    ends += [child, 0] if part else [TOP, child]
            out.append((tree, TOP, node, f if f >= 0 else None, top.threshold[tree][node] if f >= 0 else None,
                        *ends, value, weight, gain))
    return out


def fit_grown_forest(df: DataFrame, features: Sequence[str], label: str, *, num_trees: int = 100,
                     seed: int = 42, bootstrap: bool = True, max_depth: int | None = None,
                     finish_rows: int = FINISH_ROWS, bins: int = BINS,
                     tree_group: int = TREE_GROUP) -> GrownForest:
    """Grow ``num_trees`` trees until leaves are pure (or ``max_depth``), all features tried
    at every split.  Rows with a missing feature or label are left out.  A group finishes at
    most ``FINISH_ROWS`` rows, also where ``finish_rows`` asks for more."""
    finish_rows = min(finish_rows, FINISH_ROWS)
    spark, features = df.sparkSession, list(features)
    data = df.select(F.array(*[col(c).cast("double") for c in features]).alias("x"),
                     col(label).cast("double").alias("y"))
    data = data.filter(F.col("y").isNotNull() & ~F.isnan("y")
                       & ~F.exists("x", lambda c: c.isNull() | F.isnan(c)))
    data = number_rows(data, [F.xxhash64("x", "y"), F.col("x"), F.col("y")])
    path = scratch_path(spark, "forest-rows")
    data.write.parquet(path)       # read by every pass
    rows = spark.read.schema(data.schema).parquet(path)
    n = rows.count()
    if not n:
        raise ValueError("no training rows")
    out = scratch_path(spark, "forest-nodes")
    for first in range(0, num_trees, tree_group):
        trees = list(range(first, min(first + tree_group, num_trees)))
        top = _grow_top(rows, n, trees, len(features), seed, bootstrap, finish_rows, bins, max_depth)
        _finish(rows, top, trees, seed, bootstrap, max_depth).write.mode("append").parquet(out)
        if top.feature:
            spark.createDataFrame(_top_rows(top), _NODES).write.mode("append").parquet(out)
    return GrownForest(spark.read.schema(_NODES).parquet(out), features, num_trees)


def save_forest(model: GrownForest, path: str) -> None:
    spark = model.nodes.sparkSession
    model.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    spark.createDataFrame([(model.features, model.num_trees)], "features array<string>, num_trees int"
                          ).coalesce(1).write.mode("overwrite").parquet(f"{path}/forest")


def load_forest(spark: SparkSession, path: str) -> GrownForest:
    meta = spark.read.parquet(f"{path}/forest").first()
    return GrownForest(spark.read.schema(_NODES).parquet(f"{path}/nodes"), list(meta["features"]),
                       meta["num_trees"])


def importances(model: GrownForest) -> DataFrame:
    """``feature, importance``: fall of the squared error per feature, each tree's shares
    averaged over the trees that split at all; they add up to 1."""
    spark = model.nodes.sparkSession
    per = (model.nodes.filter("feature is not null").groupBy("tree", "feature")
           .agg(F.sum("gain").alias("gain")))
    total = per.groupBy("tree").agg(F.sum("gain").alias("total")).filter("total > 0")
    share = (per.join(total, "tree").groupBy("feature")
             .agg(F.sum(F.col("gain") / F.col("total")).alias("share")).collect())   # one per feature
    by = {r["feature"]: r["share"] for r in share}
    whole = sum(by.values()) or 1.0
    return spark.createDataFrame([(name, float(by.get(k, 0.0) / whole))
                                  for k, name in enumerate(model.features)],
                                 "feature string, importance double")


class Linked:
    """Arrays of many nodes with children as positions: trees, or the subtrees of one part."""

    def __init__(self, table: pa.Table):
        c = {k: table.column(k).to_numpy() for k in ("tree", "part", "node", "value")}
        ends = {s: (table.column(f"{s}_part").to_numpy(), table.column(f"{s}_node").to_numpy())
                for s in ("left", "right")}
        feature = table.column("feature").to_numpy().astype(float)
        self.feature = np.where(np.isnan(feature), -1, feature).astype(np.int64)
        self.threshold = np.nan_to_num(table.column("threshold").to_numpy().astype(float))
        self.value = c["value"]
        place = {k: i for i, k in enumerate(zip(c["tree"].tolist(), c["part"].tolist(), c["node"].tolist()))}
        self.children = np.zeros((len(self.value), 2), np.int64)
        for side, (parts, nodes) in enumerate(ends.values()):
            for i in np.flatnonzero(self.feature >= 0):
                self.children[i, side] = place.get((int(c["tree"][i]), int(parts[i]), int(nodes[i])), -1)
        self.place = place

    def walk(self, start: int, x: np.ndarray) -> np.ndarray:
        at = np.full(len(x), start)
        live = np.flatnonzero(self.feature[at] >= 0)
        while len(live):
            own = at[live]
            at[live] = self.children[own, (x[live, self.feature[own]] > self.threshold[own]).astype(int)]
            live = live[self.feature[at[live]] >= 0]
        return at

    def root(self, tree: int) -> int:
        return self.place.get((tree, TOP, 0), self.place.get((tree, 0, 0)))


def predict_grown(df: DataFrame, model: GrownForest, out: str = "prediction",
                  broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """Mean of the trees' leaves; null where a feature is missing.

    A model of at most ``broadcast_nodes`` nodes (counted) is broadcast.  A larger one is
    met by a shuffle: rows are routed through the large nodes, dealt to the parts they
    reach, and their leaf values averaged.  Parts are small; a part's rows are dealt
    in shares of their number, each with a copy of the part."""
    spark = df.sparkSession
    x = F.array(*[col(c).cast("double") for c in model.features])
    full = ~F.exists(x, lambda c: c.isNull() | F.isnan(c))
    trees = model.num_trees
    if model.nodes.count() <= broadcast_nodes:
        shared = spark.sparkContext.broadcast(Linked(model.nodes.toArrow()))

        @F.arrow_udf("double")
        def leaf_mean(column: pa.Array) -> pa.Array:
            own, linked = list_matrix(column), shared.value
            total = np.zeros(len(own))
            for tree in range(trees):
                total += linked.value[linked.walk(linked.root(tree), own)]
            return pa.array(total / trees)

        zero = F.array(*[F.lit(0.0)] * len(model.features))
        return df.withColumn(out, F.when(full, leaf_mean(F.when(full, x).otherwise(zero))))

    path = scratch_path(spark, "forest-scored")
    df.withColumns({"__id": F.monotonically_increasing_id(), "__x": F.when(full, x)}
                   ).write.parquet(path)
    rows = spark.read.parquet(path)
    top = Linked(model.nodes.filter(F.col("part") == TOP).toArrow())    # the large nodes
    ends = {(r["tree"], r["part"], r["node"]): (r["left_part"], r["right_part"], r["left_node"], r["right_node"])
            for r in model.nodes.filter((F.col("part") == TOP) & F.col("feature").isNotNull()).collect()}
    shared = spark.sparkContext.broadcast((top, ends))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, ends = shared.value
        names = {i: k for k, i in top.place.items()}
        for batch in batches:
            own = list_matrix(batch.column("__x"))
            for tree in range(trees):
                part, value = np.zeros(len(own), np.int64), np.full(len(own), np.nan)
                start = top.place.get((tree, TOP, 0))
                if start is not None:
                    at = np.full(len(own), start)
                    live = np.arange(len(own))
                    while len(live):
                        here = at[live]
                        leaf = top.feature[here] < 0
                        value[live[leaf]], part[live[leaf]] = top.value[here[leaf]], TOP
                        live, here = live[~leaf], here[~leaf]
                        side = (own[live, top.feature[here]] > top.threshold[here]).astype(int)
                        to = top.children[here, side]
                        below = to < 0
                        for j in np.unique(here[below]):
                            both = ends[names[j]]
                            for s in (0, 1):
                                part[live[below & (here == j) & (side == s)]] = both[s]
                        at[live[~below]] = to[~below]
                        live = live[~below]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), tree), pa.int32()), pa.array(part), batch.column("__id"),
                     batch.column("__x"), pa.array(value, mask=np.isnan(value))],
                    names=["tree", "part", "__id", "__x", "value"])

    dealt = (rows.filter("__x is not null").select("__id", "__x")
             .mapInArrow(deal, "tree int, part long, __id long, __x array<double>, value double"))
    path = scratch_path(spark, "forest-dealt")
    dealt.write.parquet(path)
    dealt = spark.read.parquet(path)
    # only parts that many rows reach are copied
    large = (dealt.filter("value is null").groupBy("tree", "part").count()
             .filter(F.col("count") > FINISH_ROWS)
             .select("tree", "part", F.ceil(F.col("count") / FINISH_ROWS).alias("__shares")))
    shares = F.coalesce("__shares", F.lit(1).cast("long"))
    dealt = (dealt.join(large, ["tree", "part"], "left")
             .withColumn("share", F.pmod(F.xxhash64("__id"), shares)).drop("__shares"))
    parts = (model.nodes.filter(F.col("part") != TOP).join(large, ["tree", "part"], "left")
             .withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), shares - 1))).drop("__shares"))
    by = ["tree", "part", "share"]

    def walk(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"__id": pa.array([], pa.int64()), "value": pa.array([], pa.float64())})
        linked = Linked(right)
        root = linked.place[(left.column("tree")[0].as_py(), left.column("part")[0].as_py(), 0)]
        own = list_matrix(left.column("__x").combine_chunks())
        return pa.table({"__id": left.column("__id"), "value": pa.array(linked.value[linked.walk(root, own)])})

    reached = (dealt.filter("value is null").groupBy(*by).cogroup(parts.groupBy(*by))
               .applyInArrow(walk, "__id long, value double"))
    means = (reached.unionByName(dealt.filter("value is not null").select("__id", "value"))
             .groupBy("__id").agg((F.sum("value") / F.lit(float(trees))).alias(out)))
    return rows.join(means, "__id", "left").drop("__id", "__x")
