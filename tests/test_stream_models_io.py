"""Streaming equals batch, model tolerances and I/O behaviour."""

import os

import pytest
from pyspark.sql import functions as F

from autoprice.operators import clean as C
from autoprice.plans.fixtures import view
from autoprice.sources import readers as RD
from autoprice.sources import sinks as SK
from conftest import SF_SMALL


def test_stream_scoring_equals_batch(spark):
    from autoprice.plans.registry import QUERIES, load_all
    from autoprice.streaming import scoring as SC
    load_all()
    streamed = QUERIES["stream_score"](spark, SF_SMALL)
    batch = SC.score_stream(view(spark, SF_SMALL, "requests"), SC.formula_price_model(spark)).select("car_id", "status", "value")
    assert streamed.count() == view(spark, SF_SMALL, "cars_raw").count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_parse_request_rejects_malformed(spark):
    from autoprice.streaming.scoring import parse_request
    df = spark.createDataFrame([("not json",), ('{"Year": 2015}',)], "value string")
    assert [r.status for r in parse_request(df).collect()] == ["rejected", "rejected"]


def test_forest_beats_mean_and_save_load_is_identical(spark, tmp_path):
    from autoprice.operators.models import load_model, save_model
    from autoprice.plans.jobs import fit_price
    clean = C.clean_cars_mean(view(spark, "/root/testdata/sf0.01", "cars_raw"), as_of_year=2015)
    train, test = clean.randomSplit([0.8, 0.2], seed=1)
    model = fit_price(train, trees=20, depth=6)
    pred = model.transform(test)
    mse = pred.agg(F.avg((F.col("prediction") - F.col("selling_price")) ** 2)).first()[0]
    mean_y = train.agg(F.avg("selling_price")).first()[0]
    mse0 = test.agg(F.avg((F.lit(mean_y) - F.col("selling_price")) ** 2)).first()[0]
    assert mse < mse0
    path = save_model(model, str(tmp_path / "m"))
    again = load_model(path).transform(test).select("car_id", F.col("prediction").alias("p2"))
    j = pred.select("car_id", "prediction").join(again, "car_id")
    assert j.where(F.col("prediction") != F.col("p2")).count() == 0
    with pytest.raises(FileNotFoundError):
        load_model(str(tmp_path / "missing"))


def test_linear_regression_matches_normal_equations(spark):
    import numpy as np
    from autoprice.plans.jobs import train_linear_baseline
    raw = view(spark, SF_SMALL, "cars_raw")
    model, _ = train_linear_baseline(raw)
    d = C.drop_any_null(raw.select("car_id", "year", "present_price", "kms_driven", "selling_price"))
    from autoprice.operators.split import split_random
    tr = split_random(d, "car_id", 0.2, 42).where("split = 'train'").toPandas()
    X = np.column_stack([tr.year, tr.present_price, tr.kms_driven, np.ones(len(tr))]).astype(float)
    coef = np.linalg.lstsq(X, tr.selling_price.to_numpy(float), rcond=None)[0]
    assert np.allclose(list(model.coefficients) + [model.intercept], coef, rtol=1e-6, atol=1e-9)


def test_positional_csv_routes_ragged_lines(spark, tmp_path):
    p = str(tmp_path / "x")
    spark.createDataFrame([("a,b",), ("c",), ("# note",), ("d,e,f",), ("g,",)], "value string").write.text(p)
    good, bad = RD.split_corrupt(RD.read_csv_positional(spark, p, ["x", "y"], corrupt=True))
    assert sorted((r.x, r.y or "") for r in good.collect()) == [("a", "b"), ("g", "")]
    assert sorted(r.value for r in bad.collect()) == ["c", "d,e,f"]
    with pytest.raises(Exception):
        RD.read_csv_positional(spark, p, ["x", "y"]).collect()


def test_stats_path_rule():
    assert SK.stats_path("out/cars.parquet") == "out/cars_stats.parquet"


def test_checkpoint_dir_is_set(spark):
    assert spark.sparkContext.getCheckpointDir()
    assert os.path.isdir(spark.sparkContext.getCheckpointDir().replace("file:", ""))


def test_replayed_epoch_is_idempotent(spark, tmp_path):
    from autoprice.streaming.scoring import parse_request, route_batches
    batch = parse_request(spark.createDataFrame([("not json",), ('{"Year": 2015}',), (
        '{"Year":2015,"Present_Price":9.0,"Kms_Driven":100,"Owner":0,"Car_Age":1,"Kms_Per_Year":100,'
        '"Fuel_Type":"Petrol","Seller_Type":"Dealer","Transmission":"Manual"}',)], "value string"))
    run = route_batches(str(tmp_path / "good"), str(tmp_path / "dead"))
    run(batch, 7)
    run(batch, 7)   # the same micro-batch delivered again after a failure
    run(batch, 8)
    good, dead = spark.read.parquet(str(tmp_path / "good")), spark.read.parquet(str(tmp_path / "dead"))
    assert good.count() == 2 and dead.count() == 4


def test_end_to_end_job_runners(spark, tmp_path):
    from autoprice.plans import jobs as J
    from autoprice.plans.fixtures import view
    cars_csv, tx_csv, temps_csv = (str(tmp_path / n) for n in ("cars", "tx", "temps"))
    raw = view(spark, SF_SMALL, "cars_raw")
    raw.toDF(*[c.title() if c != "car_id" else c for c in raw.columns]).write.option("header", True).csv(cars_csv)
    stats = J.run_clean_cars(spark, cars_csv, str(tmp_path / "out" / "cars.parquet"), "mean", 2015).first()
    expected = C.clean_cars_mean(raw, as_of_year=2015).count()
    assert stats.processed_records == expected and stats.original_records == raw.count()
    assert spark.read.parquet(str(tmp_path / "out" / "cars_stats.parquet")).count() == 1
    view(spark, SF_SMALL, "tx_raw").write.option("header", False).csv(tx_csv)
    prof = {(r.column_name, r.kind): r["count"] for r in J.run_clean_transactions(spark, tx_csv + "/*.csv", str(tmp_path / "tx_out")).collect()}
    assert prof[("terminal_id", "zero")] > 0
    assert spark.read.parquet(str(tmp_path / "tx_out")).count() == C.clean_transactions(view(spark, SF_SMALL, "tx_raw")).count()
    t = view(spark, SF_SMALL, "temps").select("dt", "average_temperature", "country")
    t.write.option("header", True).csv(temps_csv)
    assert J.run_temperature_etl(spark, temps_csv, str(tmp_path / "temps_out")).count() == \
        C.temperature_etl(view(spark, SF_SMALL, "temps")).count()


def test_forest_training_is_repeatable(spark):
    from autoprice.operators import features as FE
    from autoprice.operators.models import rf_regressor
    clean = C.clean_cars_mean(view(spark, SF_SMALL, "cars_raw"), as_of_year=2015)
    d = FE.assemble_features(clean, ["year", "present_price", "kms_driven", "owner"]).select("car_id", "features", "selling_price")
    p1 = rf_regressor("features", "selling_price", 10, 4, seed=7).fit(d).transform(d).select("car_id", F.col("prediction").alias("a"))
    p2 = rf_regressor("features", "selling_price", 10, 4, seed=7).fit(d).transform(d).select("car_id", F.col("prediction").alias("b"))
    assert p1.join(p2, "car_id").where("a <> b").count() == 0


def test_price_fit_reads_its_rows_once(spark):
    from autoprice.plans import jobs as J
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    numeric = ", ".join(f"cast((id * 7 + {i}) % 23 as double) as {c}" for i, c in enumerate(J.PRICE_NUMERIC))
    kinds = ", ".join(f"cast(id % 3 as string) as {c}" for c in J.PRICE_CATEGORICAL)
    d = spark.range(200).selectExpr("id as car_id", *numeric.split(", "), *kinds.split(", "), "cast(id % 11 as double) as selling_price")
    model = J.fit_price(d.mapInArrow(counted, d.schema), trees=2, depth=2)
    assert seen.value == 200 and model.transform(d).count() == 200
