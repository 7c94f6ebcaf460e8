"""Metrics, bootstrap, t-test and decision ladders on hand-made edge cases."""

import math

from pyspark.sql import functions as F

from autoprice.functions.stats import t_critical, t_two_sided_p
from autoprice.operators import abtest as AB
from autoprice.operators import metrics as M


def test_regression_metrics_small_and_constant(spark):
    one = spark.createDataFrame([(1.0, 2.0)], "y double, yhat double")
    (r,) = M.regression_metrics(one).collect()
    assert r.n == 1 and r.mae == 1.0 and r.r2 is None
    (r0,) = M.regression_metrics(one, small_r2="zero").collect()
    assert r0.r2 == 0.0
    const = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "y double, yhat double")
    assert M.regression_metrics(const).first().r2 == 1.0


def test_classification_metrics_undefined_are_zero_and_auc_null(spark):
    d = spark.createDataFrame([(0, 0), (0, 0)], "y int, yhat int")
    (r,) = M.classification_metrics(d).collect()
    assert (r.precision, r.recall, r.f1) == (0.0, 0.0, 0.0) and r.auc is None


def test_auc_of_hard_labels(spark):
    d = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 1), (0, 0)], "y int, yhat int")
    (r,) = M.classification_metrics(d).collect()
    assert math.isclose(r.auc, (0.5 + 2 / 3) / 2)


def test_p_value_matches_published_t_table():
    # two-sided 5 % critical values: df=10 -> 2.228, df=30 -> 2.042; 1 % at df=120 -> 2.617
    assert abs(t_two_sided_p(2.228, 10) - 0.05) < 2e-4
    assert abs(t_two_sided_p(2.042, 30) - 0.05) < 2e-4
    assert abs(t_critical(0.01, 120) - 2.617) < 1e-3
    assert t_two_sided_p(0.0, 50) == 1.0


def test_poisson_bootstrap_weights_average_one(spark):
    df = spark.range(2000).selectExpr("id as k", "cast(id % 2 as int) as y", "cast(id % 3 = 0 as int) as p")
    b = AB.bootstrap_confusion_poisson(df, "k", "y", {"m": "p"}, iterations=50)
    tot = b.select((F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n"))
    mean = tot.agg(F.avg("n")).first()[0]
    assert abs(mean / 2000 - 1) < 0.01


def test_multinomial_bootstrap_keeps_size_and_pairs(spark):
    df = spark.range(500).selectExpr("cast(id % 2 as int) as y", "cast(id % 3 = 0 as int) as a", "cast(id % 5 = 0 as int) as b")
    out = AB.bootstrap_confusion_multinomial(df, "y", {"a": "a", "b": "b"}, iterations=20, seed=1)
    sizes = {r.n for r in out.select((F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n")).collect()}
    assert sizes == {500}
    again = AB.bootstrap_confusion_multinomial(df, "y", {"a": "a", "b": "b"}, iterations=20, seed=1)
    assert out.exceptAll(again).count() == 0


def test_validation_ladders(spark):
    rows = [(0.5, 0.6, 100, 50), (0.5, 0.49, 100, 50), (0.5, 0.1, 100, 50), (0.0, 0.3, 3, 1), (-0.2, -0.1, 100, 1)]
    df = spark.createDataFrame(rows, "a double, b double, n_old long, n_new long")
    imp = AB.improvement_pct(F.col("a"), F.col("b"))
    text, code = AB.validation_status(imp)
    skip = AB.validation_skip(F.col("n_old") + F.col("n_new"), F.col("n_old"), F.col("n_new"))
    out = df.select(imp.alias("imp"), F.coalesce(skip, text).alias("status"), code.alias("code")).collect()
    assert out[0].status == AB.STATUS_IMPROVED and out[0].code == 1
    assert out[1].status == AB.STATUS_NO_DEGRADATION
    assert out[2].status == AB.STATUS_DEGRADED and out[2].code == 0
    assert out[3].status == AB.STATUS_SKIPPED and out[3].imp == 0.0
    assert out[4].status == AB.STATUS_SKIPPED_SPLIT and out[4].imp < 0  # sign flip when r2_a < 0


def test_quality_grade_null_never_passes(spark):
    df = spark.createDataFrame([(0.9, 0.8, "PASSED"), (0.9, None, "PASSED"), (None, None, "SKIPPED - x"),
                                (0.7, 0.6, "FAILED - y")], "r2 double, cv double, s string")
    g = [r.q for r in df.select(AB.quality_grade(F.col("r2"), F.col("cv"), F.col("s")).alias("q")).collect()]
    assert g == ["EXCELLENT", "SATISFACTORY", "LOW + VALIDATION SKIPPED", "GOOD + VALIDATION FAILED"]


def test_final_summary_formats_like_python(spark):
    df = spark.createDataFrame([(5.19225, 0.1, "PASSED", "GOOD"), (None, None, "SKIPPED", "LOW")],
                               "r2 double, cv_r2 double, validation_status string, quality string")
    out = [r.status for r in AB.final_summary(df, "r").collect()]
    assert out == [f"GOOD - R2: {5.19225:.4f}", "LOW - R2: N/A"]
