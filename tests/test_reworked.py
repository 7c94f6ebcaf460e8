"""Results do not depend on layout, size or what is missing: the cases of the first round's review."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from autoprice.operators import metrics as M
from autoprice.operators import models as MD
from autoprice.operators import profile as PR
from autoprice.plans import jobs as J
from autoprice.sources import readers as RD


def cars(spark, n, seed=1):
    import random
    rng = random.Random(seed)
    rows = [(i, f"model {i % 7}", 2000 + i % 15, 1.5 + 7 * rng.random(), 2 + 8 * rng.random(), 1000 + i * 37, "Petrol" if i % 3 else "Diesel",
             "Dealer", "Manual" if i % 2 else "Automatic", i % 3, 15 - i % 15, 100.0 + i) for i in range(n)]
    return spark.createDataFrame(rows, "car_id long, car_name string, year int, selling_price double, present_price double, kms_driven int, "
                                       "fuel_type string, seller_type string, transmission string, owner int, car_age int, kms_per_year double")


def test_forest_does_not_depend_on_the_input_layout(spark):
    d = cars(spark, 300)
    got = []
    for parts in (1, 8, 64):
        model = J.fit_price(d.repartition(parts), trees=5, depth=4)
        got.append(sorted((r.car_id, r.prediction) for r in model.transform(d).select("car_id", "prediction").collect()))
    assert got[0] == got[1] == got[2]


def test_metrics_use_known_pairs_only(spark):
    d = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.5), (100.0, None)], "y double, yhat double")
    r = M.regression_metrics(d).first()
    assert r.n == 3 and r.r2 == 1 - (0.5 / 3) / (2 / 3)


def test_least_squares_of_large_values(spark):
    d = spark.range(50).select((F.lit(1e9) + F.col("id")).alias("x"), (3 * (F.lit(1e9) + F.col("id")) + 1).alias("y"))
    d = d.union(spark.createDataFrame([(None, 5.0), (7.0, None)], "x double, y double"))
    fit = MD.ols_fit(d, "x", "y").first()
    assert fit.n == 50 and abs(fit.slope - 3) < 1e-9
    constant = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "x double, y double")
    assert tuple(MD.ols_fit(constant, "x", "y").first()) == (2, 0.0, 2.0)


def test_describe_keeps_columns_without_values(spark):
    d = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    for approx in (False, True):
        got = {r.column_name: (r["count"], r.mean) for r in PR.describe_numeric(d, approx=approx).collect()}
        assert got == {"a": (2, 2.0), "b": (0, None)}


def test_group_median_keeps_groups_without_values(spark):
    d = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("y", None), (None, 3.0)], "k string, v double")
    assert [tuple(r) for r in PR.group_median(d, "k", "v").collect()] == [("x", 1.5), ("y", None)]


@pytest.mark.parametrize("n,folds", [(4, 3), (5, 3), (6, 5), (12, 5)])
def test_validation_with_few_rows(spark, n, folds):
    summary, importances, ab = J.train_validate_price(cars(spark, n), spark, trees=2, depth=2, cv_folds=folds)
    s = summary.first()
    assert s.run_id == "run-0001" and importances.count() == 3
    assert s.validation_status.startswith("SKIPPED") == (n < 6)
    assert ab.count() == (0 if n < 6 else 2)


def test_validation_needs_four_rows(spark):
    with pytest.raises(ValueError):
        J.train_validate_price(cars(spark, 3), spark, trees=2, depth=2)


def test_validation_fits_side_by_side_on_rows_computed_once(spark, monkeypatch):
    """The folds' rows stand in a table, and cross-validation and the A/B forests each wait here for the other to run."""
    import threading
    want = [r.asDict() for r in J.train_validate_price(cars(spark, 60), spark, trees=3, depth=3)[0].collect()]
    meet, met, plans, real_cv, real_layout = threading.Barrier(2, timeout=60), [], [], MD.cross_validate, MD.training_layout

    def cv(estimator, train, *rest):
        plans.append(train._jdf.queryExecution().toString())
        meet.wait()
        return real_cv(estimator, train, *rest)

    def layout(*args):
        if threading.current_thread() is not threading.main_thread() and not met:
            met.append(True)
            meet.wait()
        return real_layout(*args)
    monkeypatch.setattr(MD, "cross_validate", cv)
    monkeypatch.setattr(MD, "training_layout", layout)
    got = J.train_validate_price(cars(spark, 60), spark, trees=3, depth=3)[0]
    assert [r.asDict() for r in got.collect()] == want
    assert met and "RepartitionBy" not in plans[0]


def test_forest_does_not_depend_on_the_groups_of_nodes(spark):
    from autoprice.operators.features import assemble_features
    d = assemble_features(cars(spark, 2000), ["year", "present_price", "kms_driven"])
    d = MD.training_layout(d.select("car_id", "features", F.col("selling_price").alias("label")), "car_id").checkpoint()
    trees = [MD.rf_regressor(trees=20, depth=7, **x).fit(d).toDebugString.split("\n", 1)[1] for x in ({}, {"group_mb": 1})]
    assert trees[0] == trees[1]


def test_cross_validation_folds(spark):
    from autoprice.operators.features import assemble_features
    d = assemble_features(cars(spark, 40), ["year", "present_price"]).select("car_id", "features", F.col("selling_price").alias("label"))
    lin = MD.linear_regression()
    for k in (2, 5):
        r2, r2_std, rmse, rmse_std = MD.cross_validate(lin, d, "car_id", k)
        assert rmse > 0 and r2_std >= 0 and rmse_std >= 0 and r2 < 1
    assert MD.cross_validate(lin, d.limit(3), "car_id", 3) is None


def test_search_uses_balanced_folds(spark):
    d = spark.range(60).select("id", F.when(F.col("id") % 6 == 0, 1.0).otherwise(0.0).alias("label"),
                               (F.col("id") % 6).cast("double").alias("x"))
    from autoprice.operators.features import assemble_features
    cv = MD.random_search(MD.rf_classifier(), assemble_features(d, ["x"]), {"numTrees": [2, 3], "maxDepth": [2]}, "id", folds=3)
    assert len(cv.avgMetrics) == 2 and min(cv.avgMetrics) == 1.0


def test_training_job_writes_the_registry(spark, tmp_path):
    from autoprice.operators import registry as RG
    path = str(tmp_path / "registry")
    for run in ("r1", "r2"):
        J.train_price(cars(spark, 60), trees=2, depth=2, registry=path, run_id=run)
    stages = {r.version: (r.run_id, r.stage) for r in RG.versions(spark, path).collect()}
    assert stages == {1: ("r1", "Archived"), 2: ("r2", "Production")}
    log = RG.compare_runs(spark.read.parquet(f"{path}/runs"), ["r2", "rmse"]).collect()
    assert {r.run_id for r in log} == {"r1", "r2"} and all(r.rmse > 0 for r in log)
    champion = RG.resolve_alias(RG.versions(spark, path), RG.alias_events(spark, path), "champion").first()
    assert champion.resolved_version == 2


def test_car_files_by_header_name(spark, tmp_path):
    d = cars(spark, 50).drop("car_age", "kms_per_year")
    p = str(tmp_path / "cars")
    d.select(F.lit("x").alias("Extra"), *[F.col(c).alias(c.title()) for c in reversed(d.columns) if c != "car_id"]) \
     .write.option("header", True).csv(p)
    stats = J.run_clean_cars(spark, p, str(tmp_path / "out.parquet"), "mean", 2015).first()
    assert stats.original_records == 50 and stats.processed_records > 0
    d.drop("year").write.option("header", True).csv(str(tmp_path / "short"))
    with pytest.raises(ValueError, match="year"):
        J.run_clean_cars(spark, str(tmp_path / "short"), str(tmp_path / "o2"), "mean", 2015)


def test_dated_file_by_header_name(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.createDataFrame([("2001-01-01", 5.0, 0.25, "A"), ("2002-01-01", 7.0, 0.35, "A")],
                          "dt string, AverageTemperature double, AverageTemperatureUncertainty double, Country string") \
         .write.option("header", True).csv(p)
    assert [tuple(r) for r in J.run_temperature_etl(spark, p, str(tmp_path / "o")).collect()] == [("A", 6.0)]
    with pytest.raises(ValueError, match="average_temperature"):
        RD.read_dated_csv(spark, str(tmp_path / "o"))


def test_streams_read_a_table_of_many_files(spark, tmp_path):
    from autoprice.plans import q_stream as Q
    from autoprice.streaming import scoring as SC
    rows = spark.range(400).select("id", F.col("id").cast("string").alias("v"))
    for name, parts in (("many", 7), ("one", 1)):
        rows.repartition(parts).write.parquet(str(tmp_path / f"{name}.parquet"))
        s = Q._stream_table(spark, str(tmp_path), name)
        got = SC.run_to_table(s, Q._name(name), str(tmp_path / f"ckpt-{name}"))
        assert got.count() == 400


def test_late_rows_are_not_dropped_in_silence(spark, tmp_path):
    from autoprice.streaming import scoring as SC
    src = str(tmp_path / "src")
    hour = lambda h: dt.datetime(2024, 1, 1, h)
    schema = "k long, ts timestamp"
    for k, h in ((1, 10), (3, 11), (2, 5)):
        spark.createDataFrame([(k, hour(h))], schema).coalesce(1).write.mode("append").parquet(src)
    read = lambda: SC.dedupe_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src), "k", "ts")
    with pytest.raises(SC.LateRows, match="1 row"):
        SC.run_to_table(read(), "late1", str(tmp_path / "c1"))
    assert SC.run_to_table(read(), "late2", str(tmp_path / "c2"), allow_late=True).count() == 2
