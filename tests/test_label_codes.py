"""Label codes of several columns from one dictionary, small and large."""

import datetime as dt

import pytest

from autoprice.operators import features as FE


@pytest.mark.parametrize("small", [200_000, 0])
def test_codes_follow_each_types_own_order(spark, monkeypatch, small):
    monkeypatch.setattr(FE, "SMALL_DICTIONARY", small)
    rows = [(i, ["b", "a", None, "é"][i % 4], [10, 9, -3, None][i % 4], [0.5, 10.25, -1.0, 2.0][i % 4], i % 3 == 0, dt.date(2020, 1 + i % 4, 1)) for i in range(24)]
    df = spark.createDataFrame(rows, "id long, s string, n int, x double, f boolean, d date")
    cols = ["s", "n", "x", "f", "d"]
    got = {r.id: r for r in FE.label_encode(df, cols).collect()}
    for j, c in enumerate(cols, 1):
        values = sorted({r[j] for r in rows} - {None})
        assert all(got[r[0]][f"{c}_code"] == (values.index(r[j]) if r[j] is not None else len(values)) for r in rows)
    other = spark.createDataFrame([(1, "zz", 9, 0.5, True, None)], df.schema)
    (r,) = FE.label_encode(other, cols, FE.fit_label_encoders(df, cols)).collect()
    assert (r.s_code, r.n_code, r.x_code, r.f_code, r.d_code) == (3, 1, 1, 1, 4)
    assert FE.label_encode(df.where("false"), cols).collect() == []


def test_no_shuffle_of_rows_with_small_dictionaries(spark):
    df = spark.range(1000).selectExpr("id", "cast(id % 7 as string) as a", "cast(id % 5 as string) as b")
    plan = FE.label_encode(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2


def test_one_hot_refuses_too_many_categories(spark, monkeypatch):
    monkeypatch.setattr(FE, "MAX_CATEGORIES", 50)
    df = spark.range(200).selectExpr("cast(id as string) as wide", "cast(id % 3 as string) as narrow")
    with pytest.raises(ValueError, match="wide"):
        FE.one_hot(df, ["wide"])
    assert len(FE.one_hot(df, ["narrow"]).columns) == 5
