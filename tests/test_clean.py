"""Cleaning operators: golden rows, null / tie / empty edge cases, idempotence."""

import math

from pyspark.sql import functions as F

from autoprice.operators import clean as C

GOLDEN = [  # FIXTURES.md golden rows (as-of year 2025, +1 rule)
    ("ritz", 2014, 27000, 11, 2250.000000), ("sx4", 2013, 43000, 12, 3307.692308),
    ("ciaz", 2017, 6900, 8, 766.666667), ("wagon r", 2011, 5200, 14, 346.666667),
    ("swift", 2014, 42450, 11, 3537.500000), ("vitara brezza", 2018, 2071, 7, 258.875000),
    ("ciaz", 2015, 18796, 10, 1708.727273), ("s cross", 2015, 33429, 10, 3039.000000),
]


def test_golden_age_and_kms_per_year(spark):
    df = spark.createDataFrame([(n, y, k) for n, y, k, _, _ in GOLDEN], "car_name string, year int, kms_driven int")
    out = df.withColumn("car_age", C.car_age(as_of_year=2025)).withColumn("kpy", C.kms_per_year_plus1()).collect()
    for row, (_, _, _, age, kpy) in zip(out, GOLDEN):
        assert row.car_age == age
        assert math.isclose(round(row.kpy, 6), kpy, abs_tol=1e-9)


def test_mode_is_most_frequent_non_null_smallest_on_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), (None,), (None,), ("b",), ("a",)], "c string")
    out = C.impute_mode(df, ["c"]).collect()
    assert [r.c for r in out] == ["b", "a", "a", "a", "a", "b", "a"]


def test_all_null_columns_fall_back(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "x double, c string")
    out = C.impute_mean_mode(df, ["x"], ["c"]).collect()
    assert all(r.x == 0.0 and r.c == "unknown" for r in out)


def test_mean_and_mode_on_empty_table(spark):
    df = spark.createDataFrame([], "x double, c string")
    assert C.impute_mean_mode(df, ["x"], ["c"]).count() == 0


def test_median_even_count_is_midpoint(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (10.0,), (4.0,)], "year double")
    out = [r.year for r in C.impute_median(df, ["year"]).collect()]
    assert out[2] == 3.0


def test_kms_imputation_is_noop_after_outlier_filter(spark):
    df = spark.createDataFrame([(2.0, None, 2010), (3.0, 100, 2011)], "selling_price double, kms_driven long, year long")
    f = C.filter_outliers(C.drop_null_target(df))
    assert f.count() == 1 and C.impute_mean_mode(f, ["kms_driven"], []).where("kms_driven is null").count() == 0


def test_cleaning_filters_are_idempotent(spark):
    from autoprice.plans.fixtures import view
    from conftest import SF_SMALL
    raw = view(spark, SF_SMALL, "cars_raw")
    once = C.filter_year(C.filter_outliers(C.drop_null_target(raw)), as_of_year=2015)
    twice = C.filter_year(C.filter_outliers(C.drop_null_target(once)), as_of_year=2015)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_zero_id_filter_drops_null_and_malformed(spark):
    df = spark.createDataFrame([("1", "2"), ("0", "2"), ("bad", "3"), (None, "4"), ("5", "6")], "terminal_id string, customer_id string")
    assert [r.terminal_id for r in C.filter_zero_ids(df).collect()] == ["1", "5"]


def test_malformed_date_gives_null_not_error(spark):
    df = spark.createDataFrame([("2024-01-02 10:00:00",), ("not-a-date",)], "t string")
    assert [r.d for r in df.select(C.derive_date("t").alias("d")).collect()][1] is None


def test_new_columns(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = a.withColumn("y", F.lit(1)).withColumn("z", F.lit(2))
    assert C.new_columns(a, b) == ["y", "z"]
