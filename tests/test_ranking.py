"""Distributed order statistics against numpy, including a hot group."""

import numpy as np

from autoprice.operators.ranking import exact_quantiles, global_index


def test_exact_quantiles_with_hot_group(spark):
    rng = np.random.default_rng(0)
    hot = rng.normal(size=3000).round(3)
    rows = [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in rng.normal(size=7).round(2)] + [("nulls", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    out = {r.g: (r.q25, r.q50, r.q95) for r in exact_quantiles(df, "v", [0.25, 0.5, 0.95], ["q25", "q50", "q95"], ["g"],
                                                               num_partitions=7, small_rows=0).collect()}
    small = {r.g: (r.q25, r.q50, r.q95) for r in exact_quantiles(df, "v", [0.25, 0.5, 0.95], ["q25", "q50", "q95"],
                                                                 ["g"]).collect()}
    assert small.keys() == out.keys()
    assert small == out  # to the last bit, on either side of the size bound
    for g in ("hot", "cold"):
        vals = np.array([v for k, v in rows if k == g])
        exp = np.quantile(vals, [0.25, 0.5, 0.95])
        assert np.allclose(out[g], exp, atol=1e-12), (g, out[g], exp)
    assert "nulls" not in out


def test_global_quantile_single_value_and_duplicates(spark):
    df = spark.createDataFrame([(5.0,)] * 10 + [(1.0,)], "v double")
    for small_rows in (0, 1000):
        (r,) = exact_quantiles(df, "v", [0.0, 0.5, 1.0], ["a", "b", "c"], small_rows=small_rows).collect()
        assert (r.a, r.b, r.c) == (1.0, 5.0, 5.0)


def test_global_index_is_a_permutation_in_key_order(spark):
    df = spark.range(0, 5000).selectExpr("id * 7 % 5003 as k")
    idx, n = global_index(df, ["k"], "i", num_partitions=6, with_count=True)
    rows = sorted((r.k, r.i) for r in idx.collect())
    assert n == 5000
    assert [i for _, i in rows] == list(range(5000))


from hypothesis import given, settings, strategies as st


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(-50, 50)), min_size=1, max_size=60),
       st.sampled_from([0.0, 0.1, 0.5, 0.95, 1.0]))
def test_exact_quantiles_property(spark, rows, q):
    df = spark.createDataFrame([(g, float(v)) for g, v in rows], "g string, v double")
    got = {r.g: r.x for r in exact_quantiles(df, "v", [q], ["x"], ["g"], num_partitions=3, small_rows=0).collect()}
    for g in {g for g, _ in rows}:
        exp = float(np.quantile([float(v) for k, v in rows if k == g], q))
        assert abs(got[g] - exp) < 1e-9


def test_approx_quantiles_close_to_exact(spark):
    from autoprice.operators.ranking import quantiles
    df = spark.range(20000).selectExpr("cast(id % 3 as string) as g", "cast(id as double) * 0.5 as v")
    ex = {r.g: r.m for r in quantiles(df, "v", [0.5], ["m"], ["g"]).collect()}
    ap = {r.g: r.m for r in quantiles(df, "v", [0.5], ["m"], ["g"], approx=True).collect()}
    assert all(abs(ex[k] - ap[k]) <= 0.5 * 20000 / 10000 * 2 for k in ex)
