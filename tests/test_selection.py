"""Radix selection: every cut equals the sorted order, for each kind of key, with small digits and leaves."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from autoprice.operators import selection as SEL
from autoprice.operators import split as S


def _segments_of(rows, key, cuts):
    order = sorted(rows, key=key)
    return {r[0]: sum(i >= c for c in cuts) for i, r in enumerate(order)}


def _check(spark, rows, schema, order, key, cuts, leaf=2, digit=None, monkeypatch=None):
    if digit:
        monkeypatch.setattr(SEL, "DIGIT", digit)
    df = spark.createDataFrame(rows, schema).repartition(3)
    got, n = SEL.segments(df, order, lambda n: cuts, "seg", leaf=leaf)
    assert n == len(rows) and got.columns == [*df.columns, "seg"]
    assert {r[0]: r.seg for r in got.collect()} == _segments_of(rows, key, cuts)


NULLS_FIRST = lambda *at: lambda r: [(r[i] is not None, r[i]) for i in at]


@pytest.mark.parametrize("digit", [3, 16])
def test_long_keys(spark, monkeypatch, digit):
    rng = random.Random(1)
    values = {rng.choice([-1, 1]) * rng.getrandbits(rng.choice([3, 20, 62])) for _ in range(150)} | {-(1 << 63), (1 << 63) - 1, 0, -1}
    rows = [(i, v) for i, v in enumerate(values)]
    n = len(rows)
    _check(spark, rows, "id long, k long", ["k"], NULLS_FIRST(1), [0, 1, n // 3, n // 2, n // 2 + 1, n - 1, n, n + 5], 2, digit, monkeypatch)


@pytest.mark.parametrize("leaf", [0, 3])
def test_text_keys(spark, leaf):
    rng = random.Random(2)
    texts = {"", "a", "ab", "a\x00", "é", "日本", "z" * 40} | {"common/prefix/" + "".join(rng.choice("abé\x01") for _ in range(rng.randint(0, 6))) for _ in range(120)}
    rows = list(enumerate(texts))
    n = len(rows)
    _check(spark, rows, "id long, k string", ["k"], lambda r: r[1].encode(), [1, 7, n // 2, n - 1], leaf)


def test_several_columns_with_hot_values_and_nulls(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, 5, 5, 5, 5, 7, -2]), rng.choice([None, "x", "x", "x", "y"]), i * 37 % 400 if i % 50 else i * 1000) for i in range(400)]
    _check(spark, rows, "id long, a int, b string, c long", ["a", "b", "c"], NULLS_FIRST(1, 2, 3), [1, 50, 51, 200, 201, 399], 4)


def test_dates_times_and_booleans(spark):
    t0 = dt.datetime(1960, 1, 1)
    rows = [(i, i % 3 == 0, dt.date(1950, 1, 1) + dt.timedelta(days=i * 13 % 211 * 100), t0 + dt.timedelta(microseconds=i * 7919 % 211 * 10 ** 10 + i)) for i in range(211)]
    _check(spark, rows, "id long, f boolean, d date, t timestamp", ["f", "t"], NULLS_FIRST(1, 3), [10, 100, 150], 1)
    _check(spark, rows, "id long, f boolean, d date, t timestamp", ["d", "id"], NULLS_FIRST(2, 0), [10, 100, 150], 1)


def test_repeated_keys_and_other_types_are_ranked_by_position(spark):
    df = spark.createDataFrame([(i, float(i % 7), 1) for i in range(50)], "id long, x double, same int")
    for order, cut in ((["x", "id"], 20), (["same"], 20)):
        got, n = SEL.segments(df, order, lambda n: [cut], "seg", leaf=1)
        assert n == 50 and sorted(r.seg for r in got.collect()) == [0] * 20 + [1] * 30
    # equal keys on one side of a cut are no tie
    twice = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k long")
    cols = SEL.digit_form(twice, [F.col("k")])
    assert SEL.Selection(twice, cols, leaf=0).keys([2]) == {2: (2,)}


def test_empty_and_one_row(spark):
    for rows in ([], [(4,)]):
        df = spark.createDataFrame(rows, "k long")
        got, n = SEL.segments(df, ["k"], lambda n: [0, 1], "seg")
        assert n == len(rows) and [r.seg for r in got.collect()] == [1] * len(rows)
        assert S.sample_fraction(df, "k", 0.5, exact=True).count() == 0
        assert S.kfold_assign(df, "k", 3).where("fold is not null").count() == 0


def test_splits_do_not_shuffle_rows(spark):
    df = spark.range(5000).selectExpr("id AS k", "id * 2 AS v")
    for d in (S.sample_fraction(df, "k", 0.3, exact=True), S.split_random(df, "k", 0.2, exact=True), S.split_small_guarded(df, "k"),
              S.split_time_ordered(df, "k"), S.kfold_assign(df, "k", 5)):
        plan = d._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan and "Scan ExistingRDD" not in plan, plan


def test_sample_equals_sorting_by_draw(spark):
    df = spark.range(3000).withColumnRenamed("id", "k")
    want = {r.k for r in df.withColumn("u", S.draw("k", 42)).orderBy("u", "k").limit(900).collect()}
    assert {r.k for r in S.sample_fraction(df, "k", 0.3, exact=True).collect()} == want
