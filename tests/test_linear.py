"""Gram-based least squares against numpy fits of every fold and segment."""

import numpy as np
import pytest

from autoprice.operators import linear as LN


def _data(spark, n=400, d=6, seed=1, offset=0.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * np.logspace(-2, 3, d) + offset
    y = x @ rng.normal(size=d) / np.logspace(-2, 3, d).mean() + rng.normal(size=n) * .3 + 5
    names = [f"x{i}" for i in range(d)]
    df = spark.createDataFrame([(int(i), *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))],
                               "k long, " + ", ".join(f"{c} double" for c in names) + ", y double").repartition(5)
    return df, names, x, y


def _ols(x, y):
    a = np.column_stack([np.ones(len(x)), x])
    return np.linalg.lstsq(a, y, rcond=None)[0]


def _score(b, x, y):
    e = np.column_stack([np.ones(len(x)), x]) @ b - y
    return 1 - (e ** 2).mean() / y.var(), (e ** 2).mean() ** .5, np.abs(e).mean()


@pytest.mark.parametrize("offset", [0.0, 1e5])
def test_folds_equal_separate_fits(spark, offset):
    df, names, x, y = _data(spark, 403, offset=offset)
    got = {r.fold: r for r in LN.cross_validate_linear(df, "k", names, "y", 5).collect()}
    parts = np.array_split(np.arange(403), 5)
    scores = []
    for f, part in enumerate(parts):
        rest = np.setdiff1d(np.arange(403), part)
        b = _ols(x[rest], y[rest])
        r2, rmse, _ = _score(b, x[part], y[part])
        scores.append((r2, rmse))
        assert got[f].n == len(part) and np.allclose((got[f].r2, got[f].rmse), (r2, rmse), rtol=1e-6)
        assert np.allclose(got[f].coefficients, b[1:], rtol=1e-5, atol=1e-9)
    r2, rmse = np.array(scores).T
    assert np.allclose((got[0].cv_r2_mean, got[0].cv_r2_std, got[0].cv_rmse_mean, got[0].cv_rmse_std), (r2.mean(), r2.std(), rmse.mean(), rmse.std()), rtol=1e-6)


def test_segments_equal_separate_fits(spark):
    df, names, x, y = _data(spark, 300, 3, 2)
    got = {r.model: r for r in LN.time_ab_linear(df, "k", names, "y").collect()}
    for model, train, test in (("A", 180, 180), ("B", 180 + 84, 180 + 84)):
        want = _score(_ols(x[:train], y[:train]), x[test:], y[test:])
        r = got[model]
        assert (r.n_train, r.n_test) == (train, 300 - test) and np.allclose((r.r2, r.rmse, r.mae), want, rtol=1e-7)


def test_gram_adds_and_subtracts(spark):
    df, names, x, y = _data(spark, 200, 4, 3)
    by = LN.grams(df.selectExpr("*", "cast(k % 3 as int) AS g"), names, "y", "g")
    whole = by[0] + by[1] + by[2]
    assert whole.n == 200 and np.allclose((whole - by[1]).matrix, (by[0] + by[2]).matrix)
    assert np.allclose(LN.fit_linear(df, names, "y").coefficients, _ols(x, y)[1:], rtol=1e-6)


def test_many_features(spark):
    df, names, x, y = _data(spark, 500, 60, 4)
    m = LN.fit_linear(df, names, "y")
    assert np.allclose(m.coefficients, _ols(x, y)[1:], rtol=1e-4, atol=1e-9)


def test_nulls_constant_and_repeated_features(spark):
    rows = [(i, float(i), 7.0, float(2 * i), 3.0 * i + 1) for i in range(20)] + [(20, None, 7.0, 1.0, 9.0), (21, 1.0, 7.0, float("nan"), 9.0), (22, 1.0, 7.0, 2.0, None)]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double, y double")
    m = LN.fit_linear(df, ["a", "b", "c"], "y")
    assert m.coefficients[1] == 0 and abs(m.coefficients[0] + 2 * m.coefficients[2] - 3) < 1e-9 and abs(m.intercept - 1) < 1e-8
    cv = LN.cross_validate_linear(df, "k", ["a", "b", "c"], "y", 4).collect()
    assert [r.n for r in cv] == [5] * 4 and all(r.r2 > 1 - 1e-9 for r in cv)


def test_few_rows_and_empty(spark):
    schema = "k long, a double, y double"
    empty = spark.createDataFrame([], schema)
    assert LN.fit_linear(empty, ["a"], "y") is None
    assert LN.cross_validate_linear(empty, "k", ["a"], "y").collect() == []
    assert LN.time_ab_linear(empty, "k", ["a"], "y").collect() == []
    one = spark.createDataFrame([(1, 2.0, 3.0)], schema)
    m = LN.fit_linear(one, ["a"], "y")
    assert (m.intercept, m.coefficients) == (3.0, [0.0])
    assert LN.cross_validate_linear(one, "k", ["a"], "y").collect() == []
    same = spark.createDataFrame([(i, float(i), 4.0) for i in range(8)], schema)
    assert all(r.r2 == 1.0 and r.rmse == 0 for r in LN.cross_validate_linear(same, "k", ["a"], "y", 2).collect())
