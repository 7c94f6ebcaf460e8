"""Mergeable summaries against exact results."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from autoprice.operators import sketch as SK


@pytest.mark.parametrize("alpha", [0.01, 0.05])
def test_quantiles_within_the_stated_error_after_merging(spark, alpha):
    rng = np.random.default_rng(1)
    groups = {"a": rng.lognormal(0, 3, 3000), "b": -rng.lognormal(2, 1, 500), "c": np.array([7.0]), "z": np.zeros(5), "t": np.array([1e-300, 1e300, 1e-5])}
    rows = [(g, float(v), i % 9) for g, vs in groups.items() for i, v in enumerate(vs)] + [("n", None, 0), ("n", float("nan"), 1)]
    df = spark.createDataFrame(rows, "g string, v double, part int").repartition(5)
    parts = SK.sketch(df, "v", ["g", "part"], alpha)
    qs = [0.0, 0.1, 0.5, 0.95, 1.0]
    got = {r.g: r for r in SK.sketch_quantiles(SK.merge(parts, ["g"]), qs, [f"q{i}" for i in range(5)], ["g"], alpha).collect()}
    assert set(got) == set(groups)
    for g, v in groups.items():
        for i, q in enumerate(qs):
            exact = float(np.quantile(v, q))
            assert abs(got[g][f"q{i}"] - exact) <= alpha * abs(exact) * (1 + 1e-9) + SK.TINY, (g, q)
    whole = SK.sketch_quantiles(SK.merge(parts), [0.5], ["m"], alpha=alpha).first().m
    assert abs(whole - np.median(np.concatenate(list(groups.values())))) <= alpha * 2 + 1e-9


def test_infinite_values_and_empty_tables(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (1.0,)], "v double")
    r = SK.sketch_quantiles(SK.sketch(df, "v"), [0.0, 0.5, 1.0], ["a", "b", "c"]).first()
    assert r.a < -1e300 and abs(r.b - 1) <= .01 and r.c > 1e300
    assert SK.sketch(df.where("false"), "v").count() == 0


def test_top_values_without_counting_all(spark, monkeypatch):
    rng = np.random.default_rng(2)
    values = [f"u{i}" for i in range(20000)] + ["hot"] * 3000 + ["warm"] * 2000 + ["tie1"] * 900 + ["tie0"] * 900
    rng.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 4000, "v string").repartition(4)
    monkeypatch.setattr(SK, "all_counts", lambda d: pytest.fail("counted all values"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        got = [tuple(r) for r in SK.top_values(df, "v", 4, counters=60).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert got == [("hot", 3000), ("warm", 2000), ("tie0", 900), ("tie1", 900)]


def test_flat_counts_are_counted_exactly(spark):
    df = spark.range(3000).selectExpr("id % 1000 as v")
    assert [tuple(r) for r in SK.top_values(df, "v", 3, counters=5).collect()] == [(0, 3), (1, 3), (2, 3)]
    few = spark.createDataFrame([(1.5,), (None,), (1.5,), (2.5,)], "v double")
    assert [tuple(r) for r in SK.top_values(few, "v", 5).collect()] == [(1.5, 2), (2.5, 1)]
    assert SK.top_values(few.where("false"), "v").collect() == [] and SK.top_values(few.where("v is null"), "v").collect() == []


def test_merged_panes_equal_one_sketch(spark):
    df = spark.range(2000).selectExpr("id % 7 as pane", "cast(id * id % 977 as double) - 100 as v")
    a = SK.merge(SK.sketch(df, "v", ["pane"])).orderBy("bucket").collect()
    assert a == SK.sketch(df, "v").orderBy("bucket").collect()
    assert df.select(F.abs(SK.bucket_value(SK.log_bucket("v")) - F.col("v")) <= 0.01 * F.abs("v") + 1e-12).distinct().collect() == [(True,)]
