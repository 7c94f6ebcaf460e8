"""Decision trees and forests grown level by level from mergeable histograms.

Spark ML's forests know no minimum of samples per split. These do, and follow scikit-learn's rules: rows drawn into a tree
count once for ``min_split`` and ``min_leaf`` however often they are drawn, while the impurity is weighted by the draws; a node's
features are tried in a random order, ``max_features`` at a time, until one separates its rows; a split is the midpoint between two
neighbouring values of the node.

1. Each feature's values become bins once: one a value where there are at most ``max_bins`` distinct ones (then splits are exact),
   else quantile ranges. The binned rows are a written table.
2. For a level, each task runs its rows down the trees so far and adds them to histograms (tree, node, feature, bin) of counts and sums;
   these are summed by node over the tasks, and the best split of each node (a few numbers) comes back. A level
   whose histograms would exceed CELLS is done in several passes. All trees, of all folds and parameters, grow in the same passes.
3. A row's draws into a tree are Poisson(1) from a hash of its key, so that trees depend on the rows alone, not on how they
   are partitioned or retried.

The driver holds the trees (the model itself) and nothing that grows with the rows. A tree of a smaller depth, and a
forest of fewer trees, are prefixes of larger ones with the same draws, so a search grows the largest only.

Rows with a null label, or a null or NaN feature, are an error in training (as in assembling features, E5).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from autoprice.session import ensure_checkpoint_dir, scratch_dir

CELLS = 4_000_000  # histogram cells of a pass: 32 MB a task
CHUNK = 1 << 16  # rows that a task runs down the trees at a time
SHARED = 16  # draws of a chunk that are kept for further trees: about 30 MB a task at most
EPSILON = float(np.finfo(np.float64).eps)
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(13)])


@dataclass(frozen=True)
class Params:
    """``classes`` 0: regression; ``max_features``: how many features a node tries first; ``fold``: rows of it are left out."""
    classes: int = 0
    depth: int | None = None
    min_split: int = 2
    min_leaf: int = 1
    max_features: int | None = None
    bootstrap: bool = True
    fold: int | None = None


@dataclass
class Tree:
    """Nodes in order of growth: feature (-1: leaf), threshold, left and right child, rows, impurity, depth, and value (class
    weights, or the mean)."""
    params: Params
    seed: int
    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)
    weight: list[float] = field(default_factory=list)
    impurity: list[float] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    value: list[list[float]] = field(default_factory=list)
    tried: list[int] = field(default_factory=list)  # features tried so far
    path: list[int] = field(default_factory=list)   # 1 for the root, 2p and 2p + 1 for its children: the same in any order of growth

    def add(self, depth: int, stats: np.ndarray | None = None, path: int = 1) -> int:
        for column, v in ((self.feature, -1), (self.threshold, 0.0), (self.bin, -1), (self.left, -1), (self.right, -1), (self.rows, 0),
                          (self.weight, 0.0), (self.impurity, 0.0), (self.depth, depth), (self.value, []), (self.tried, 0), (self.path, path)):
            column.append(v)
        if stats is not None:
            self.describe(len(self.feature) - 1, stats)
        return len(self.feature) - 1

    def describe(self, node: int, stats: np.ndarray) -> None:
        """Set a node's numbers from its sums: (rows, class weights...) or (rows, weight, sum, sum of squares)."""
        self.rows[node] = int(stats[0])
        if self.params.classes:
            w = stats[1:]
            self.weight[node] = float(w.sum())
            share = w / max(w.sum(), EPSILON)
            self.impurity[node], self.value[node] = float(1 - (share ** 2).sum()), share.tolist()
        else:
            w, s, q = stats[1:]
            mean = s / w if w else 0.0
            self.weight[node], self.impurity[node], self.value[node] = float(w), max(float(q / w - mean * mean), 0.0) if w else 0.0, [float(mean)]

    def open(self, node: int) -> bool:
        """Whether the node may be split."""
        p = self.params
        flat = self.impurity[node] <= (EPSILON if p.classes else 1e-12 * (1 + self.value[node][0] ** 2))
        return not (flat or self.rows[node] < max(p.min_split, 2 * p.min_leaf) or p.depth is not None and self.depth[node] >= p.depth)

    def candidates(self, node: int, features: int) -> np.ndarray:
        """The next features to try at a node, in ascending order; all are tried in the end."""
        k = min(self.params.max_features or features, features)
        order = np.random.default_rng([self.seed, self.path[node]]).permutation(features) if k < features else np.arange(features)
        return np.sort(order[self.tried[node]:self.tried[node] + k])

    def leaf_of(self, x: np.ndarray, depth: int | None = None) -> np.ndarray:
        """The node that each row of feature values ends in (not below ``depth``)."""
        f, t, l, r, d = (np.array(c) for c in (self.feature, self.threshold, self.left, self.right, self.depth))
        at = np.zeros(len(x), np.int64)
        while True:
            go = np.flatnonzero((f[at] >= 0) & ((d[at] < depth) if depth is not None else True))
            if not len(go):
                return at
            node = at[go]
            at[go] = np.where(x[go, f[node]] <= t[node], l[node], r[node])

    def _node_of(self, bins: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The node that each of ``rows`` is in; ``bins`` has a row a feature."""
        f, b, l, r = (np.array(c) for c in (self.feature, self.bin, self.left, self.right))
        flat, n = bins.ravel(), bins.shape[1]
        child, base = np.stack([r, l], axis=1).ravel(), f * n
        at, go = np.zeros(len(rows), np.int64), np.arange(len(rows)) if f[0] >= 0 else np.zeros(0, np.int64)
        while len(go):
            whole = len(go) == len(rows)
            node, row = (at, rows) if whole else (at[go], rows[go])
            node = child[2 * node + (flat[base[node] + row] <= b[node])]
            at[go] = node
            inner = f[node] >= 0
            go = go if inner.all() else go[inner]
        return at


def draws(key: np.ndarray, seed: int, bootstrap: bool) -> np.ndarray:
    """How often each row (64-bit key hash) is drawn into the tree ``seed``: Poisson(1)."""
    if not bootstrap:
        return np.ones(len(key))
    z = key.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(by)
    return np.searchsorted(_POISSON, ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) / 2.0 ** 53, side="right").astype(np.float64)


# ------------------------------------------------------------------ bins

@dataclass
class Bins:
    """Per feature: upper limits of all bins but the last, and the single value of each bin (None: ranges)."""
    limits: list[np.ndarray]
    values: list[np.ndarray | None]

    def threshold(self, feature: int, left: int, right: int) -> float:
        """The midpoint between the bins ``left`` and ``right``, neighbours among those a node uses."""
        v, t = self.values[feature], self.limits[feature]
        return float((v[left] + v[right]) / 2) if v is not None else float((t[left] + t[right - 1]) / 2)


def _distinct(max_bins: int):
    """(feature, value) of each feature's distinct values in a task, or (feature, null) where they exceed ``max_bins``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray | None] = {}
        for b in batches:
            x = np.asarray(b.column(0).flatten()).reshape(b.num_rows, -1)
            for f in range(x.shape[1]):
                if held.get(f, ()) is not None:
                    v = np.union1d(held.get(f, ()), x[:, f])
                    held[f] = v if len(v) <= max_bins else None
        pairs = [(f, v) for f, vs in held.items() for v in ([None] if vs is None else vs.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int32()), pa.array([p[1] for p in pairs], pa.float64())], ["f", "v"])
    return run


def fit_bins(rows: DataFrame, features: int, max_bins: int = 64) -> Bins:
    """``rows`` has an array column ``x``. At most ``max_bins`` values a feature leave a task or reach the driver."""
    x = rows.select("x")
    found = x.mapInArrow(_distinct(max_bins), "f int, v double").distinct().groupBy("f").agg(
        F.count(F.lit(1)).alias("n"), F.bool_or(F.col("v").isNull()).alias("over"))
    few = [r.f for r in found.collect() if r.n <= max_bins and not r.over]
    values: list = [None] * features
    for r in x.mapInArrow(_distinct(max_bins), "f int, v double").where(F.col("f").isin(few)).groupBy("f").agg(F.collect_set("v").alias("v")).collect():
        values[r.f] = np.array(sorted(r.v))
    limits = [(v[1:] + v[:-1]) / 2 if v is not None else None for v in values]
    wide = [f for f in range(features) if values[f] is None]
    if wide:
        at = [i / max_bins for i in range(1, max_bins)]
        long = x.select(F.posexplode("x").alias("f", "v")).where(F.col("f").isin(wide))
        for r in long.groupBy("f").agg(F.percentile_approx("v", at, 20 * max_bins).alias("q")).collect():
            limits[r.f] = np.unique(r.q)
    none = np.zeros(0)
    return Bins([none if t is None else t for t in limits], values)


def binned(rows: DataFrame, bins: Bins) -> DataFrame:
    """(h, fold, y, b) of every row of (h, fold, y, x) as a written table: ``b`` holds the bin of each feature."""
    limits = bins.limits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.asarray(b.column("x").flatten()).reshape(b.num_rows, len(limits))
            out = np.stack([np.searchsorted(t, x[:, f], side="left") for f, t in enumerate(limits)], axis=1).astype(np.int16)
            yield pa.RecordBatch.from_arrays([b.column("h"), b.column("fold"), b.column("y"),
                                              pa.array([r.tobytes() for r in out], pa.binary())], ["h", "fold", "y", "b"])
    path = scratch_dir(rows.sparkSession, "binned")
    rows.mapInArrow(run, "h long, fold int, y double, b binary").write.parquet(path)
    return rows.sparkSession.read.parquet(path)


# ------------------------------------------------------------------ growth

def _stats(y: np.ndarray, w: np.ndarray, classes: int) -> np.ndarray:
    """Per row what a histogram cell sums: 1 and the weight at the row's class, or 1, w, w*y, w*y*y."""
    if classes:
        out = np.zeros((len(y), 1 + classes))
        out[np.arange(len(y)), 1 + y.astype(np.int64)] = w
    else:
        out = np.stack([w, w, w * y, w * y * y], axis=1)
    out[:, 0] = 1.0
    return out


def _chunks(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(h, fold, y, bins) of about CHUNK rows at a time; ``bins`` has a row a feature."""
    held: list[pa.RecordBatch] = []

    def joined() -> tuple[np.ndarray, ...]:
        t = pa.Table.from_batches(held).combine_chunks()
        bins = np.frombuffer(b"".join(t.column("b").to_pylist()), np.int16).reshape(-1, features)
        return *(t.column(c).to_numpy() for c in ("h", "fold", "y")), np.ascontiguousarray(bins.T)
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= CHUNK:
            yield joined()
            held = []
    if sum(x.num_rows for x in held):
        yield joined()


def _partial(trees: dict[int, Tree], wanted: dict[int, list[int]], features: int, sizes: list[int]):
    """Histograms of the wanted nodes of each tree over a task's rows: the cells that have rows, and their sums."""
    most = max(sizes, default=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        tried = {t: np.array([trees[t].candidates(n, features) for n in nodes]) for t, nodes in wanted.items()}
        for h, fold, y, bins in _chunks(batches, features):
            drawn: dict[tuple, tuple] = {}  # trees of several folds and grid points share their draws
            for t, nodes in wanted.items():
                p = trees[t].params
                same = (trees[t].seed, p.bootstrap, p.fold)
                if same not in drawn:
                    w = draws(h.view(np.uint64), trees[t].seed, p.bootstrap)
                    if p.fold is not None:
                        w = np.where(fold == p.fold, 0.0, w)
                    mine = np.flatnonzero(w > 0)
                    if len(drawn) >= SHARED:
                        drawn.clear()
                    drawn[same] = mine, _stats(y[mine], w[mine], p.classes)
                mine, stats = drawn[same]
                slot = np.full(len(trees[t].feature), -1)
                slot[nodes] = np.arange(len(nodes))
                s = slot[trees[t]._node_of(bins, mine)]
                if (s < 0).any():
                    keep = np.flatnonzero(s >= 0)
                    mine, stats, s = mine[keep], stats[keep], s[keep]
                if not len(mine):
                    continue
                k = tried[t].shape[1]
                if t not in held:
                    held[t] = np.zeros((stats.shape[1], len(nodes), k, most))
                columns = np.ascontiguousarray(stats.T)
                for j in range(k):
                    first = tried[t][0, j]
                    own = bins[first][mine] if (tried[t][:, j] == first).all() else bins[tried[t][s, j], mine]
                    cell = s * most + own
                    for c, column in enumerate(columns):
                        held[t][c, :, j] += np.bincount(cell, column, len(nodes) * most).reshape(-1, most)
        for t in list(held):
            sums = np.moveaxis(held.pop(t), 0, -1)
            cells, values = [], []
            for node in sums.reshape(len(sums), -1, sums.shape[-1]):
                some = np.flatnonzero(node[:, 0])
                cells.append(some.astype(np.int32))
                values.append(node[some].ravel())
            nodes = wanted[t]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(nodes), t, np.int32)), pa.array(np.array(nodes, np.int32)),
                                              pa.array(cells, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float64()))], ["t", "n", "at", "m"])
    return run


def best_split(cells: np.ndarray, classes: int, min_leaf: int) -> tuple[int, int, int] | None:
    """(candidate, left bin, next used bin) of the best split of (candidates, bins, sums) cells; ties: first candidate, lowest bin.
    A feature whose rows all share one bin gives none."""
    left = cells.cumsum(axis=1)
    right = left[:, -1:] - left
    ok = (left[..., 0] >= max(min_leaf, 1)) & (right[..., 0] >= max(min_leaf, 1)) & (cells[..., 0] > 0)
    if not ok.any():
        return None
    with np.errstate(all="ignore"):
        if classes:
            score = sum((side[..., 1:] ** 2).sum(axis=-1) / side[..., 1:].sum(axis=-1) for side in (left, right))
        else:
            score = sum(side[..., 2] ** 2 / side[..., 1] for side in (left, right))
    score = np.where(ok, score, -np.inf)
    best = score.max()
    # equal partitions may differ in the last bits where sums are not integers
    at = int(np.flatnonzero(score.ravel() >= best - 1e-12 * abs(best))[0])
    f, b = divmod(at, cells.shape[1])
    return f, b, b + 1 + int(np.flatnonzero(cells[f, b + 1:, 0])[0])


def _choose(params: dict[int, Params], widths: dict[int, int], most: int):
    """The best split of each node from its partial histograms, which stand next to each other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(key, m):
            t, n = key
            p = params[t]
            stats = 1 + p.classes if p.classes else 4
            cells = m.reshape(-1, most, stats)
            split = best_split(cells, p.classes, p.min_leaf)
            total = cells[0].sum(axis=0)
            left = cells[split[0], :split[1] + 1].sum(axis=0) if split else total
            # whether some candidate has two values here, were it not for the least leaf
            varied = bool(((cells[..., 0] > 0).sum(axis=1) > 1).any())
            return (t, n, *(split or (-1, -1, -1)), varied, total.tolist(), left.tolist())
        held, sums = None, None
        for b in batches:
            out = []
            for t, n, at, m in zip(b.column("t").to_pylist(), b.column("n").to_pylist(), b.column("at"), b.column("m")):
                if (t, n) != held:
                    if held is not None:
                        out.append(done(held, sums))
                    p = params[t]
                    held, sums = (t, n), np.zeros((widths[t] * most, 1 + p.classes if p.classes else 4))
                sums[np.asarray(at.values)] += np.asarray(m.values).reshape(-1, sums.shape[1])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(done(held, sums)), kinds)], names)
    kinds = [*[pa.int32()] * 5, pa.bool_(), pa.list_(pa.float64()), pa.list_(pa.float64())]
    names = ["t", "n", "f", "b", "next", "varied", "total", "left"]
    return run


def grow(rows: DataFrame, bins: Bins, trees: list[Tree]) -> list[Tree]:
    """Grow all ``trees`` over a table of ``binned`` rows, one level at a time."""
    features = len(bins.limits)
    sizes = [len(t) + 1 for t in bins.limits]
    most = max(sizes, default=1)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for t in trees:
        t.add(0)
    frontier = [(i, 0) for i in range(len(trees))]
    roots = True
    while frontier:
        later: list[tuple[int, int]] = []
        while frontier:
            room, wanted = CELLS, {}
            while frontier:
                i, n = frontier[-1]
                p = trees[i].params
                cost = len(trees[i].candidates(n, features)) * most * (1 + p.classes if p.classes else 4)
                if wanted and cost > room:
                    break
                room -= cost
                frontier.pop()
                wanted.setdefault(i, []).append(n)
            # candidates of a tree's nodes form one array: those that have fewer left go in another pass
            for i, nodes in list(wanted.items()):
                widths = [len(trees[i].candidates(n, features)) for n in nodes]
                if len(set(widths)) > 1:
                    keep = max(widths)
                    frontier += [(i, n) for n, k in zip(nodes, widths) if k != keep]
                    wanted[i] = [n for n, k in zip(nodes, widths) if k == keep]
            later += _grow_pass(rows, bins, trees, wanted, features, sizes, most, parts, roots)
        frontier, roots = later, False
    return trees


def _grow_pass(rows, bins: Bins, trees: list[Tree], wanted: dict[int, list[int]], features: int, sizes: list[int], most: int, parts: int,
               roots: bool) -> list[tuple[int, int]]:
    held = {i: trees[i] for i in wanted}
    widths = {i: len(trees[i].candidates(nodes[0], features)) for i, nodes in wanted.items()}
    partial = rows.mapInArrow(_partial(held, wanted, features, sizes), "t int, n int, at array<int>, m array<double>")
    together = partial.repartition(parts, "t", "n").sortWithinPartitions("t", "n")
    schema = "t int, n int, f int, b int, next int, varied boolean, total array<double>, left array<double>"
    found = together.mapInArrow(_choose({i: t.params for i, t in held.items()}, widths, most), schema).collect()
    opened = []
    for r in sorted(found, key=lambda r: (r.t, r.n)):
        tree, total = trees[r.t], np.array(r.total)
        if roots and not tree.rows[r.n]:
            tree.describe(r.n, total)
            if not tree.open(r.n):
                continue
        candidates = tree.candidates(r.n, features)
        if r.f < 0:
            tree.tried[r.n] += len(candidates)
            if not r.varied and tree.tried[r.n] < features:  # none of these separates the rows: the next ones
                opened.append((r.t, r.n))
            continue
        f, left = int(candidates[r.f]), np.array(r.left)
        tree.feature[r.n], tree.bin[r.n], tree.threshold[r.n] = f, r.b, bins.threshold(f, r.b, r.next)
        depth = tree.depth[r.n] + 1
        tree.left[r.n], tree.right[r.n] = tree.add(depth, left, 2 * tree.path[r.n]), tree.add(depth, total - left, 2 * tree.path[r.n] + 1)
        opened += [(r.t, c) for c in (tree.left[r.n], tree.right[r.n]) if tree.open(c)]
    return opened


# ------------------------------------------------------------------ forests

@dataclass
class Forest:
    """Trees of one fit. ``depth`` cuts them, where they were grown deeper."""
    trees: list[Tree]
    classes: int
    features: int
    depth: int | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Mean class shares (n, classes) or mean values (n, 1)."""
        out = np.zeros((len(x), max(self.classes, 1)))
        for t in self.trees:
            value = np.array([v or [0.0] * out.shape[1] for v in t.value])
            out += value[t.leaf_of(x, self.depth)]
        return out / max(len(self.trees), 1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        s = self.scores(x)
        return s.argmax(axis=1).astype(np.float64) if self.classes else s[:, 0]

    def transform(self, df: DataFrame, features: str = "features", out: str = "prediction") -> DataFrame:
        """``df`` with the prediction of its array column ``features``."""
        @F.pandas_udf(T.DoubleType())
        def predicted(x):
            import pandas as pd
            return pd.Series(self.predict(np.stack(x.to_numpy())) if len(x) else [], dtype="float64")
        return df.withColumn(out, predicted(F.col(features)))

    def importances(self) -> np.ndarray:
        """Mean weighted decrease of impurity by feature, normalised by tree and over trees."""
        total = np.zeros(self.features)
        for t in self.trees:
            own = np.zeros(self.features)
            for n, f in enumerate(t.feature):
                if f >= 0 and (self.depth is None or t.depth[n] < self.depth):
                    l, r = t.left[n], t.right[n]
                    own[f] += t.weight[n] * t.impurity[n] - t.weight[l] * t.impurity[l] - t.weight[r] * t.impurity[r]
            total += own / own.sum() if own.sum() > 0 else own
        return total / total.sum() if total.sum() > 0 else total

    def nodes(self, spark) -> DataFrame:
        """The model as a table: tree, node, depth, feature, threshold, left, right, rows, impurity, value."""
        rows = [(i, n, t.depth[n], t.feature[n], t.threshold[n], t.left[n], t.right[n], t.rows[n], t.impurity[n], t.value[n])
                for i, t in enumerate(self.trees) for n in range(len(t.feature))]
        return spark.createDataFrame(rows, "tree int, node int, depth int, feature int, threshold double, left int, right int, rows long, "
                                           "impurity double, value array<double>")

    @staticmethod
    def from_nodes(nodes: DataFrame, classes: int, features: int) -> Forest:
        trees: dict[int, Tree] = {}
        for r in nodes.orderBy("tree", "node").collect():
            t = trees.setdefault(r.tree, Tree(Params(classes), 0))
            n = t.add(r.depth)
            t.feature[n], t.threshold[n], t.left[n], t.right[n], t.rows[n], t.impurity[n], t.value[n] = (
                r.feature, r.threshold, r.left, r.right, r.rows, r.impurity, list(r.value))
        return Forest(list(trees.values()), classes, features)


def feature_count(rule: str | int | None, features: int) -> int:
    """How many features a node tries: "sqrt", "log2", a number, or None (all)."""
    if rule is None or rule == "all":
        return features
    if isinstance(rule, int):
        return max(1, min(rule, features))
    return max(1, int(math.sqrt(features) if rule == "sqrt" else math.log2(features)))


def _prepared(df: DataFrame, key: str, features: str, label: str, classes: int, max_bins: int, fold: str | None = None) -> tuple[DataFrame, Bins, int]:
    bad = F.col(features).isNull() | F.exists(features, lambda v: v.isNull() | F.isnan(v)) | F.col(label).isNull()
    if classes:
        bad = bad | ~F.col(label).cast("double").isin([float(c) for c in range(classes)])
    # computed once, in the partitions and order of ``df``: checking, bins and binning each read it
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.select(F.xxhash64(key).alias("h"), (F.lit(-1) if fold is None else F.col(fold)).cast("int").alias("fold"),
                     F.col(label).cast("double").alias("y"), F.col(features).alias("x"), bad.alias("bad")).checkpoint()
    facts = rows.agg(F.max(F.size("x")), F.min(F.size("x")), F.count_if("bad")).first()
    if facts[2] or facts[0] != facts[1]:
        raise ValueError("training rows need a label (of the stated classes) and equally many known features each")
    rows = rows.drop("bad")
    bins = fit_bins(rows, facts[0] or 0, max_bins)
    return binned(rows, bins), bins, facts[0] or 0


def fit_forest(df: DataFrame, key: str, features: str = "features", label: str = "label", classes: int = 0, trees: int = 100,
               depth: int | None = 10, min_split: int = 2, min_leaf: int = 1, max_features: str | int | None = None, bootstrap: bool = True,
               seed: int = 42, max_bins: int = 64) -> Forest:
    """M1 (``classes`` 0) or M3: a random forest over the array column ``features``; ``key`` identifies rows."""
    rows, bins, d = _prepared(df, key, features, label, classes, max_bins)
    p = Params(classes, depth, min_split, min_leaf, feature_count(max_features, d), bootstrap)
    return Forest(grow(rows, bins, [Tree(p, seed * 1_000_003 + i) for i in range(trees)]) if d else [], classes, d)


def search(df: DataFrame, key: str, grid: dict[str, list], features: str = "features", label: str = "label", fold: str = "fold", folds: int = 3,
           draws_: int | None = None, seed: int = 42, max_bins: int = 64) -> tuple[Forest, DataFrame]:
    """M5: the points of ``grid`` (trees, depth, min_split, min_leaf, max_features; ``draws_`` random ones, by default all), scored by the mean
    F1 of class 1 over the folds in ``fold``; returns the best point's forest on all rows and one row a point (parameters, f1, best).

    The trees of all points and folds grow together; points that differ in depth or number of trees share them."""
    import itertools
    import random
    names = ["trees", "depth", "min_split", "min_leaf", "max_features"]
    points = [dict(zip(names, v)) for v in itertools.product(*[grid[n] for n in names])]
    if draws_ is not None and draws_ < len(points):
        points = random.Random(seed).sample(points, draws_)
    rows, bins, d = _prepared(df, key, features, label, 2, max_bins, fold)
    deepest = None if None in grid["depth"] else max(grid["depth"])
    shared = lambda p: (p["min_split"], p["min_leaf"], p["max_features"])
    grown: dict[tuple, list[Tree]] = {}
    for s in dict.fromkeys(map(shared, points)):
        most = max(p["trees"] for p in points if shared(p) == s)
        for f in range(folds):
            params = Params(2, deepest, s[0], s[1], feature_count(s[2], d), True, f)
            grown[(*s, f)] = [Tree(params, seed * 1_000_003 + i) for i in range(most)]
    grow(rows, bins, [t for ts in grown.values() for t in ts])
    forests = {(i, f): Forest(grown[(*shared(p), f)][:p["trees"]], 2, d, p["depth"]) for i, p in enumerate(points) for f in range(folds)}
    counts = _confusion(df, forests, features, label, fold)
    mean = []
    for i in range(len(points)):
        f1 = [2 * tp / (2 * tp + fp + fn) if tp else 0.0 for tp, fp, fn in (counts.get((i, f), (0, 0, 0)) for f in range(folds))]
        mean.append(sum(f1) / folds)
    best = max(range(len(points)), key=lambda i: (mean[i], -i))
    p = points[best]
    final = fit_forest(df, key, features, label, 2, p["trees"], p["depth"], p["min_split"], p["min_leaf"], p["max_features"], True, seed, max_bins)
    table = df.sparkSession.createDataFrame(
        [(i, *(str(q[n]) if n == "max_features" else q[n] for n in names), mean[i], i == best) for i, q in enumerate(points)],
        "point int, trees int, depth int, min_split int, min_leaf int, max_features string, f1 double, best boolean")
    return final, table


def _confusion(df: DataFrame, forests: dict[tuple[int, int], Forest], features: str, label: str, fold: str) -> dict[tuple[int, int], tuple]:
    """(true positives, false positives, false negatives) of each forest on its own fold, in one pass over the rows. Trees that several
    forests share are walked once a depth."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            fold_of, y = b.column("fold").to_numpy(), b.column("y").to_numpy()
            x_all = np.asarray(b.column("x").flatten()).reshape(b.num_rows, -1)
            for f in np.unique(fold_of).tolist():
                mine = fold_of == f
                x, truth, sums = x_all[mine], y[mine] == 1, {}
                for (i, g), forest in forests.items():
                    if g != f:
                        continue
                    chain = (id(forest.trees[0]), forest.depth)
                    done, total = sums.get(chain, (0, np.zeros(len(x))))
                    if done > len(forest.trees):
                        done, total = 0, np.zeros(len(x))
                    for t in forest.trees[done:]:
                        share = np.array([v[1] if v else 0.0 for v in t.value])
                        total = total + share[t.leaf_of(x, forest.depth)]
                    sums[chain] = (len(forest.trees), total)
                    said = total / len(forest.trees) > 0.5
                    counts = np.array([(said & truth).sum(), (said & ~truth).sum(), (~said & truth).sum()])
                    held[i, f] = held.get((i, f), 0) + counts
        rows = [(i, f, *c.tolist()) for (i, f), c in held.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(5)], ["i", "f", "tp", "fp", "fn"])
    rows = df.select(F.col(fold).cast("int").alias("fold"), F.col(label).cast("double").alias("y"), F.col(features).alias("x"))
    found = rows.mapInArrow(run, "i long, f long, tp long, fp long, fn long").groupBy("i", "f").agg(F.sum("tp"), F.sum("fp"), F.sum("fn"))
    return {(r[0], r[1]): (r[2], r[3], r[4]) for r in found.collect()}
