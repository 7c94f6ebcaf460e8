"""Histogram forests against a plain recursive version that sorts raw values."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from autoprice.operators import forest as FO


def plain_tree(x, y, w, p, tree, node=0, depth=0, rows=None):
    """Recursive CART on raw values with weights ``w``: ("leaf", value) or (feature, threshold, left, right). Node numbers follow
    growth by level, which the random feature order needs: only used with all features tried, or checked by numbers."""
    rows = np.flatnonzero(w > 0) if rows is None else rows
    ww, yy = w[rows], y[rows]
    if p.classes:
        share = np.array([ww[yy == c].sum() for c in range(p.classes)]) / ww.sum()
        value, impurity = share.tolist(), 1 - (share ** 2).sum()
    else:
        mean = (ww * yy).sum() / ww.sum()
        value, impurity = [mean], (ww * (yy - mean) ** 2).sum() / ww.sum()
    leaf = ("leaf", np.round(value, 9).tolist(), len(rows))
    if impurity <= 1e-12 * (1 + value[0] ** 2) or len(rows) < max(p.min_split, 2 * p.min_leaf) or p.depth is not None and depth >= p.depth:
        return leaf
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[rows, f])
        for a, b in zip(values, values[1:]):
            left = x[rows, f] <= (a + b) / 2
            if left.sum() < p.min_leaf or (~left).sum() < p.min_leaf:
                continue
            score = 0.0
            for side in (left, ~left):
                if p.classes:
                    score += sum(ww[side & (yy == c)].sum() ** 2 for c in range(p.classes)) / ww[side].sum()
                else:
                    score += (ww[side] * yy[side]).sum() ** 2 / ww[side].sum()
            if best is None or score > best[0] + 1e-12 * abs(best[0]):
                best = (score, f, (a + b) / 2, left)
    if best is None:
        return leaf
    _, f, t, left = best
    return (f, round(float(t), 9), plain_tree(x, y, w, p, tree, 0, depth + 1, rows[left]), plain_tree(x, y, w, p, tree, 0, depth + 1, rows[~left]))


def shape(t, n=0):
    if t.feature[n] < 0:
        return ("leaf", np.round(t.value[n], 9).tolist(), t.rows[n])
    return (t.feature[n], round(t.threshold[n], 9), shape(t, t.left[n]), shape(t, t.right[n]))


def made(spark, n=90, d=5, classes=0, seed=1, levels=6, parts=3):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, levels, (n, d)).astype(float) * np.array([1, .5, 2, 1, 3])[:d]
    y = (x[:, 0] * 2 + x[:, 1] * x[:, 2] + rng.integers(0, 5, n)) if not classes else ((x[:, 0] + 2 * x[:, 1] + rng.integers(0, 3, n)) % classes)
    df = spark.createDataFrame([(i, r.tolist(), float(v)) for i, (r, v) in enumerate(zip(x, y))], "k long, features array<double>, label double").repartition(parts)
    h = {r.k: r.h for r in df.select("k", F.xxhash64("k").alias("h")).collect()}
    return df, x, y, np.array([h[i] for i in range(n)], np.int64).view(np.uint64)


@pytest.mark.parametrize("classes", [0, 2, 3])
@pytest.mark.parametrize("rules", [dict(depth=None), dict(depth=3), dict(depth=None, min_split=12), dict(depth=6, min_split=5, min_leaf=4)])
def test_trees_equal_the_plain_version(spark, classes, rules):
    df, x, y, h = made(spark, classes=classes, seed=classes + 1)
    for bootstrap in (False, True):
        got = FO.fit_forest(df, "k", classes=classes, trees=2, bootstrap=bootstrap, **rules)
        for t in got.trees:
            assert shape(t) == plain_tree(x, y, FO.draws(h, t.seed, bootstrap), t.params, t)


def test_partitions_and_passes_do_not_matter(spark, monkeypatch):
    df, *_ = made(spark, 150, classes=2, seed=5)
    a = FO.fit_forest(df, "k", classes=2, trees=4, depth=6, max_features="sqrt", min_split=4)
    monkeypatch.setattr(FO, "CELLS", 300)
    b = FO.fit_forest(df.repartition(7), "k", classes=2, trees=4, depth=6, max_features="sqrt", min_split=4)
    assert [shape(t) for t in a.trees] == [shape(t) for t in b.trees]
    assert len({f for t in a.trees for f in t.feature}) > 3


def test_constant_features_are_passed_over(spark):
    rows = [(i, [1.0, 1.0, 1.0, 1.0, float(i % 4)], float(i % 4 > 1)) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, features array<double>, label double")
    for t in FO.fit_forest(df, "k", classes=2, trees=5, max_features=1, bootstrap=False).trees:
        assert shape(t) == (4, 1.5, ("leaf", [1.0, 0.0], 20), ("leaf", [0.0, 1.0], 20))


def test_wide_features_use_ranges(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 3))
    y = 3 * (x[:, 0] > .3) + x[:, 1]
    df = spark.createDataFrame([(i, r.tolist(), float(v)) for i, (r, v) in enumerate(zip(x, y))], "k long, features array<double>, label double")
    m = FO.fit_forest(df, "k", trees=10, depth=8, max_bins=32, min_split=4)
    e = m.predict(x) - y
    assert 1 - (e ** 2).mean() / y.var() > .95
    assert m.importances()[0] > m.importances()[1] > m.importances()[2] and abs(m.importances().sum() - 1) < 1e-12
    back = FO.Forest.from_nodes(m.nodes(spark), 0, 3)
    assert np.array_equal(back.predict(x), m.predict(x))
    got = {r.k: r.prediction for r in m.transform(df).collect()}
    assert np.array_equal([got[i] for i in range(600)], m.predict(x))


def test_search_equals_separate_fits(spark):
    df, x, y, h = made(spark, 120, classes=2, seed=8)
    df = df.withColumn("fold", (F.col("k") % 3).cast("int"))
    grid = {"trees": [2, 4], "depth": [2, 5], "min_split": [2, 9], "min_leaf": [1, 3], "max_features": [None]}
    best, table = FO.search(df, "k", grid)
    rows = table.orderBy("point").collect()
    assert len(rows) == 16 and sum(r.best for r in rows) == 1 and max(r.f1 for r in rows) == next(r.f1 for r in rows if r.best)
    fold = np.arange(120) % 3
    for r in rows:
        f1 = []
        for k in range(3):
            p = FO.Params(2, r.depth, r.min_split, r.min_leaf)
            total = np.zeros((fold == k).sum())
            for i in range(r.trees):
                w = np.where(fold == k, 0, FO.draws(h, 42 * 1_000_003 + i, True))
                tree = plain_tree(x, y, w, p, None)

                def at(t, row):
                    while t[0] != "leaf":
                        t = t[2] if row[t[0]] <= t[1] else t[3]
                    return t[1][1]
                total += [at(tree, row) for row in x[fold == k]]
            said, truth = total / r.trees > .5, y[fold == k] == 1
            tp = (said & truth).sum()
            f1.append(2 * tp / (2 * tp + (said & ~truth).sum() + (~said & truth).sum()) if tp else 0.0)
        assert abs(r.f1 - np.mean(f1)) < 1e-12
    assert len(best.trees) == next(r.trees for r in rows if r.best)


def test_unknown_features_empty_and_pure_tables(spark):
    schema = "k long, features array<double>, label double"
    for row in ((1, [1.0, None], 1.0), (1, [1.0, float("nan")], 1.0), (1, None, 1.0), (1, [1.0, 2.0], None), (1, [1.0], 1.0)):
        with pytest.raises(ValueError):
            FO.fit_forest(spark.createDataFrame([(0, [1.0, 2.0], 0.0), row], schema), "k")
    with pytest.raises(ValueError):
        FO.fit_forest(spark.createDataFrame([(0, [1.0], 2.0), (1, [2.0], 0.0)], schema), "k", classes=2)
    assert FO.fit_forest(spark.createDataFrame([], schema), "k").trees == []
    pure = FO.fit_forest(spark.createDataFrame([(i, [float(i)], 1.0) for i in range(9)], schema), "k", classes=2, trees=3)
    assert all(t.feature == [-1] for t in pure.trees) and pure.predict(np.array([[4.0]])).tolist() == [1.0]


def test_training_reads_its_rows_once_and_passes_on_used_cells_only(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    d = spark.range(300).selectExpr("id", "array(cast(id as double), cast(id % 7 as double)) as features", "cast(id % 5 as double) as label")
    d = d.mapInArrow(counted, d.schema)
    assert len(FO.fit_forest(d, "id", trees=2, depth=3).trees) == 2
    assert seen.value == 300
    bins = [np.array([k, k % 2], np.int16).tobytes() for k in range(5)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(5), pa.int64()), pa.array([-1] * 5, pa.int32()), pa.array([1.0] * 5), pa.array(bins, pa.binary())],
                                      ["h", "fold", "y", "b"])
    tree = FO.Tree(FO.Params(bootstrap=False), 0)
    tree.add(0)
    part = next(FO._partial({0: tree}, {0: [0]}, 2, [64, 64])(iter([rows.slice(0, 2), rows.slice(2)])))
    assert part.column("at").to_pylist() == [[0, 1, 2, 3, 4, 64, 65]]
    assert part.column("m").to_pylist() == [[1.0] * 20 + [3.0] * 4 + [2.0] * 4]
