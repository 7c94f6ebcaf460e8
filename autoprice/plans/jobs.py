"""Composite user-level jobs as functions DataFrame -> DataFrame, plus the
runners that add the I/O steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autoprice.operators import monitor as MO


def monitor_predictions(log: DataFrame, width: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """Requests, errors + status, exact p95 latency and rate per sliding window, all from one
    checkpointed histogram (pane, outcome, latency): the log is scanned once."""
    panes = MO.latency_panes(log, "latency_s", "ts", slide, ["ok"])
    n = F.col("_c")
    per_pane = panes.groupBy("_pane").agg(F.sum(n).alias("n"), F.sum(F.when(~F.col("ok"), n).otherwise(0)).alias("bad"))
    counts = MO.in_windows(per_pane, "_pane", width, slide).groupBy("window_start", "window_end") \
        .agg(F.sum("n").alias("requests"), F.sum("bad").alias("errors"))
    secs = float(MO._seconds(width))
    counts = counts.withColumn("status", F.when(F.col("errors") >= 1, "red").otherwise("green")) \
                   .withColumn("rate_per_s", F.col("requests") / secs)
    p95 = MO.pane_quantile(panes, 0.95, "latency_p95", width, slide)
    return counts.join(p95, ["window_start", "window_end"], "left")


def monitor_alerts(log: DataFrame, thresholds: dict[str, float], width: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """J10 with W10: the alert transitions of the monitored series (any of requests, errors, latency_p95, rate_per_s), all from
    one pass over the log. ``streaming.stateful.alert_stream`` gives the transitions on a stream."""
    from autoprice.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(log.sparkSession)
    windows = monitor_predictions(log, width, slide).checkpoint()
    out = None
    for metric, threshold in thresholds.items():
        a = MO.threshold_alerts(windows.select("window_start", F.col(metric).cast("double").alias(metric)), metric, metric, threshold, slide)
        out = a if out is None else out.unionByName(a)
    return out


# ------------------------------------------------------------------ model jobs

# The feature columns of the price models and the label mapping of the URL model.
PRICE_NUMERIC = ["year", "present_price", "kms_driven", "owner", "car_age", "kms_per_year"]
PRICE_CATEGORICAL = ["fuel_type", "seller_type", "transmission"]
NAME_CATEGORICAL = ["car_name", *PRICE_CATEGORICAL]
URL_LABELS = {"bad": 1, "good": 0}
# Histograms of the nodes that a pass of J6's forests grows (MB): small enough to stay near the processor. Its 50 trees of depth 8
# take 16 passes instead of 8.
PRICE_GROUP_MB = 8
# The search grid (minimum samples per split has no Spark counterpart and is dropped; "no
# feature limit" maps to "all").
URL_GRID = {"numTrees": [30, 40], "maxDepth": [8, 10], "minInstancesPerNode": [1, 2],
            "featureSubsetStrategy": ["sqrt", "log2", "all"]}
# The whole grid, for the forests that know a minimum of samples per split (``operators.forest``).
URL_GRID_FULL = {"trees": [30, 40], "depth": [8, 10], "min_split": [2, 5], "min_leaf": [1, 2], "max_features": ["sqrt", "log2", None]}


def price_pipeline(train: DataFrame, trees: int = 50, depth: int = 8, seed: int = 42, scale: bool = True):
    """E2 + E3 + E5 + M1 as one Spark ML pipeline: one-hot categoricals, standardised numerics (mean and
    population standard deviation of ``train``, a zero deviation replaced by 1), assembled, random-forest
    regression on ``selling_price``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler

    from autoprice.operators.models import rf_regressor
    idx = StringIndexer(inputCols=PRICE_CATEGORICAL, outputCols=[f"{c}_idx" for c in PRICE_CATEGORICAL],
                        stringOrderType="alphabetAsc", handleInvalid="keep")
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in PRICE_CATEGORICAL],
                        outputCols=[f"{c}_ohe" for c in PRICE_CATEGORICAL], dropLast=True)
    numeric, scaler = PRICE_NUMERIC, []
    if scale:
        # one row of statistics; persisted as literals of a SQL stage
        st = train.agg(*[F.avg(c).alias(f"m_{c}") for c in PRICE_NUMERIC],
                       *[F.stddev_pop(c).alias(f"s_{c}") for c in PRICE_NUMERIC]).first()
        z = [f"(cast({c} as double) - {float(st[f'm_{c}'] or 0)!r}D) / {float(st[f's_{c}'] or 1)!r}D as {c}_z" for c in PRICE_NUMERIC]
        scaler, numeric = [SQLTransformer(statement=f"SELECT *, {', '.join(z)} FROM __THIS__")], [f"{c}_z" for c in PRICE_NUMERIC]
    asm = VectorAssembler(inputCols=[*numeric, *[f"{c}_ohe" for c in PRICE_CATEGORICAL]], outputCol="features",
                          handleInvalid="error")
    return Pipeline(stages=[idx, ohe, *scaler, asm, rf_regressor("features", "selling_price", trees, depth, 1, seed)])


def fit_price(clean: DataFrame, key: str = "car_id", trees: int = 50, depth: int = 8, seed: int = 42):
    """The price pipeline fitted on ``clean``, laid out by key for training and computed once: every stage and the forest read it
    again."""
    from autoprice.operators.models import training_layout
    from autoprice.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(clean.sparkSession)
    train = training_layout(clean, key).checkpoint()
    return price_pipeline(train, trees, depth, seed).fit(train)


def record_model(spark, registry: str, model: str, run_id: str, params: dict, metrics: DataFrame, description: str) -> int:
    """G1 + G2 + G4 + G5 in one commit: append the run's parameters and known metrics (Q4) to the run log, register the
    next version and make it the champion (earlier champions count as archived). Returns the version."""
    from autoprice.operators import registry as RG
    values = {k: str(v) for k, v in params.items()}
    row = metrics.select([F.col(c).cast("string").alias(c) for c in metrics.columns])
    rows = row.select("*", *[F.lit(v).alias(f"param_{k}") for k, v in values.items()])
    run = RG.run_log_rows(rows, F.lit(run_id), {k: f"param_{k}" for k in values}, {c: c for c in metrics.columns}, model=F.lit(model))
    run = run.where(F.col("value").isNotNull()).checkpoint()
    return RG.register_version(spark, registry, model, run_id, description, alias="champion", run=run)


def train_price(clean: DataFrame, key: str = "car_id", test_frac: float = 0.2, seed: int = 42,
                trees: int = 50, depth: int = 8, registry: str | None = None, run_id: str = "run-0001"):
    """Split (O5) -> pipeline fit on train (E2, E3, M1) -> Q1 on test (-> G1, G2, G5 with a ``registry``
    folder). Returns (model, metrics, scored)."""
    from autoprice.operators.metrics import regression_metrics
    from autoprice.operators.split import split_random
    sp = split_random(clean, key, test_frac, seed)
    train, test = sp.where("split = 'train'"), sp.where("split = 'test'")
    model = fit_price(train, key, trees, depth, seed)
    scored = model.transform(test).select(key, F.col("selling_price").alias("y"), F.col("prediction").alias("yhat"))
    metrics = regression_metrics(scored, "y", "yhat")
    if registry:
        record_model(clean.sparkSession, registry, "price", run_id, {"trees": trees, "depth": depth, "seed": seed},
                     metrics, f"price forest, {trees} trees of depth {depth}")
    return model, metrics, scored


def train_linear_baseline(raw: DataFrame, key: str = "car_id", test_frac: float = 0.2, seed: int = 42):
    """Drop rows with any NULL (F2) -> features Year, Present_Price, Kms_Driven (P9) -> split
    -> ordinary least squares (M2) -> RMSE on test (Q1)."""
    from pyspark.ml.feature import VectorAssembler

    from autoprice.operators.clean import drop_any_null
    from autoprice.operators.metrics import regression_metrics
    from autoprice.operators.models import linear_regression
    from autoprice.operators.split import split_random
    d = drop_any_null(raw.select(key, "year", "present_price", "kms_driven", "selling_price"))
    d = VectorAssembler(inputCols=["year", "present_price", "kms_driven"], outputCol="features").transform(d)
    sp = split_random(d, key, test_frac, seed)
    model = linear_regression("features", "selling_price").fit(sp.where("split = 'train'"))
    scored = model.transform(sp.where("split = 'test'")).select(key, F.col("selling_price").alias("y"),
                                                                F.col("prediction").alias("yhat"))
    return model, regression_metrics(scored, "y", "yhat").select("n", "rmse")


def train_validate_price(clean: DataFrame, spark, key: str = "car_id", run_id: str = "run-0001", trees: int = 50,
                         depth: int = 8, seed: int = 42, cv_folds: int = 3, report_path: str | None = None,
                         registry: str | None = None):
    """E1 -> P9 -> O6 -> M1 -> Q1 -> M4 -> E6 -> B6..B11 (-> G1, G2, K6).

    Cross-validation falls back to two folds, then to none, where rows are few; the A/B validation is
    decided from the row counts (B9) before any forest is fitted for it, and a skipped one has improvement
    0. Returns (summary row, top-3 feature importances, A/B metrics rows).

    The model's forest grows alone, since its table of drawn rows is the largest; then the forests of cross-validation
    and those of the A/B validation grow side by side, so that one's tasks fill the cores that the other's last ones leave."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    from autoprice.operators import abtest as AB
    from autoprice.operators.features import assemble_features, assembled_names, feature_importance, label_encode
    from autoprice.operators.metrics import regression_aggs, regression_from_aggs
    from autoprice.operators.models import cross_validate, rf_regressor, training_layout
    from autoprice.operators.split import split_small_guarded, split_time_ordered
    enc = label_encode(clean, NAME_CATEGORICAL)
    feats = assemble_features(enc, PRICE_NUMERIC + [f"{c}_code" for c in NAME_CATEGORICAL]) \
        .select(key, "features", F.col("selling_price").alias("label"))
    names = assembled_names(feats)
    feats = training_layout(feats, key).checkpoint()
    sp = split_small_guarded(feats, key, seed)
    # computed once: the model's forest, the cuts of the folds and every fold read it again
    train, test = training_layout(sp.where("split = 'train'"), key).checkpoint(), sp.where("split = 'test'")
    rf = rf_regressor("features", "label", trees, depth, 1, seed, group_mb=PRICE_GROUP_MB)
    model = rf.fit(train)
    m = model.transform(test).agg(*regression_aggs("label", "prediction")).select(*regression_from_aggs("null")).first()
    importances = feature_importance(spark, model, names, 3)
    # B9 from the counts alone, then B6 with the forest
    seg = split_time_ordered(feats, key).checkpoint()
    size = {r.segment: r["count"] for r in seg.groupBy("segment").count().collect()}
    n_old, n_b = size.get("old", 0), size.get("new_test", 0)
    n_new = size.get("new_train", 0) + n_b
    ab_schema = "model string, n_test bigint, r2 double, mae double, rmse double"
    skipped = n_old + n_new < AB.LEAST_ROWS or n_old < AB.LEAST_SIDE or n_new < AB.LEAST_SIDE

    def validate() -> list[tuple]:
        rows = []
        for name, tr, te in (("A", seg.where("segment = 'old'"), seg.where("segment <> 'old'")),
                             ("B", seg.where("segment <> 'new_test'"), seg.where("segment = 'new_test'"))):
            r = (rf.fit(training_layout(tr, key)).transform(te).agg(*regression_aggs("label", "prediction"))
                 .select(*regression_from_aggs("zero")).first())
            rows.append((name, r.n, r.r2, r.mae, r.rmse))
        return rows
    beside = inheritable_thread_target(spark)
    with ThreadPoolExecutor(2) as pool:
        folds = pool.submit(beside(lambda: cross_validate(rf, train, key, cv_folds)))
        segments = None if skipped else pool.submit(beside(validate))
        cv = folds.result() or (None,) * 4
        ab_rows = segments.result() if segments else []
    ab = spark.createDataFrame(ab_rows, ab_schema)
    of = {r[0]: r for r in ab_rows}
    pick = lambda name, i: float(of[name][i]) if name in of and of[name][i] is not None else None
    values = {"r2": m.r2, "mae": m.mae, "rmse": m.rmse, "cv_r2": cv[0], "cv_r2_std": cv[1], "cv_rmse": cv[2], "cv_rmse_std": cv[3],
              **{f"{c}_{x.lower()}": pick(x, i) for x in "AB" for i, c in ((2, "r2"), (3, "mae"), (4, "rmse"))}}
    row = spark.range(1).select(*[F.lit(v).cast("double").alias(c) for c, v in values.items()],
                                *[F.lit(v).cast("bigint").alias(c) for c, v in (
                                    ("n_old", n_old), ("n_new", n_new), ("n_test_b", n_b), ("n_features", len(names)))])
    row = AB.validated(row)
    row = row.withColumn("quality", AB.quality_grade(F.col("r2"), F.col("cv_r2"), F.col("validation_status")))
    summary = AB.final_summary(row, run_id)
    if registry:
        record_model(spark, registry, "price-validated", run_id, {"trees": trees, "depth": depth, "cv_folds": cv_folds},
                     row.select(*values, "improvement_pct"), "validated price forest")
    if report_path:
        from autoprice.sources.sinks import write_final_report, write_report
        write_report(row, report_path, run_id)
        write_final_report(row, importances, f"{report_path.rstrip('/')}_final", run_id)
    return summary, importances, ab


def url_features(pages: DataFrame, key: str = "page_id", test_frac: float = 0.3, seed: int = 42):
    """P8 -> O5 -> E4: (train, test) with character counts, the train side laid out for training."""
    from autoprice.functions.scalar import label_map
    from autoprice.operators.features import char_count_vector, fit_char_vectorizer
    from autoprice.operators.models import training_layout
    from autoprice.operators.split import split_random
    d = pages.withColumn("label", label_map("label", URL_LABELS).cast("double")).where(F.col("label").isNotNull())
    sp = split_random(d, key, test_frac, seed, exact=True)
    train, test = sp.where("split = 'train'"), sp.where("split = 'test'")
    vec = fit_char_vectorizer(train, "url")
    return training_layout(char_count_vector(train, vec, "url"), key), char_count_vector(test, vec, "url")


def ab_test_url(pages: DataFrame, spark, key: str = "page_id", sample_frac: float = 1.0, test_frac: float = 0.3,
                seed: int = 42, draws: int = 50, iterations: int = 100, alpha: float = 0.01, registry: str | None = None,
                run_id: str = "run-0001"):
    """O3 -> P8 -> O5 -> E4 -> M3 (champion) and M5 (candidate) -> Q2/Q3 -> B1/B2 (multinomial,
    paired) -> B3/B4 -> B5 (-> G1, G2, G5: with a ``registry`` folder both runs are logged, and the candidate is
    registered as the champion if the decision is to deploy it). Returns (decision row, comparison rows,
    test metrics of both models)."""
    from autoprice.operators import abtest as AB
    from autoprice.operators import registry as RG
    from autoprice.operators.metrics import classification_metrics
    from autoprice.operators.models import random_search, rf_classifier
    from autoprice.operators.split import sample_fraction
    d = sample_fraction(pages, key, sample_frac, seed, exact=True) if sample_frac < 1.0 else pages
    train_v, test_v = url_features(d, key, test_frac, seed)
    champion = rf_classifier("features", "label").fit(train_v)
    candidate = random_search(rf_classifier("features", "label"), train_v, URL_GRID, key, draws, 3, seed).bestModel
    scored = champion.transform(test_v).select(key, F.col("label").cast("int").alias("y"),
                                               F.col("prediction").cast("int").alias("yhat_prod"))
    cand = candidate.transform(test_v).select(key, F.col("prediction").cast("int").alias("yhat_cand"))
    # both sides are the same test rows keyed by the unique id: an equi-join on the key
    scored = scored.join(cand, key)
    metrics = classification_metrics(scored, "y", "yhat_prod").select(F.lit("prod").alias("model"), "*") \
        .unionByName(classification_metrics(scored, "y", "yhat_cand").select(F.lit("cand").alias("model"), "*"))
    boot = AB.bootstrap_confusion_multinomial(scored, "y", {"prod": "yhat_prod", "cand": "yhat_cand"}, iterations, seed)
    comp = AB.t_test(boot, "prod", "cand", ["f1", "precision"], alpha)
    decision = AB.deploy_decision(comp)
    if registry:
        decision = decision.checkpoint()
        kept = ["precision", "recall", "f1", "auc"]
        logged = [RG.run_log_rows(metrics.where(F.col("model") == m).select(*kept).withColumn("candidate", F.lit(str(m == "cand"))),
                                  F.lit(f"{run_id}-{m}"), {"candidate": "candidate"}, {c: c for c in kept}, model=F.lit("url"))
                  for m in ("prod", "cand")]
        run = logged[0].unionByName(logged[1]).where(F.col("value").isNotNull()).checkpoint()
        deployed = decision.first().decision == AB.DECISION_DEPLOY
        RG.register_version(spark, registry, "url", f"{run_id}-cand", "URL forest of the parameter search", "Staging",
                            alias="champion" if deployed else None, run=run)
    return decision, comp, metrics


# ------------------------------------------------------------------ end-to-end runners with I/O

def run_clean_cars(spark, input_path: str, output_path: str, rules: str = "mean", as_of_year: int | None = None,
                   infer: bool = False, processing_date: str | None = None) -> DataFrame:
    """J2 (``rules='mean'``, Spark rule set) or J1 (``'median'``, pandas rule set) as a job: header CSV
    (S1, columns by name; the id is optional) -> cleaning -> snappy Parquet (K1) + one-row run statistics
    beside it (K4). Returns the statistics row."""
    import datetime as _dt

    from autoprice.operators import clean as C
    from autoprice.sources import readers as RD
    from autoprice.sources import sinks as SK
    raw = RD.read_csv_header(spark, input_path, infer=infer, required=RD.CAR_REQUIRED)
    cleaned = (C.clean_cars_mean if rules == "mean" else C.clean_cars_median)(raw, as_of_year)
    return SK.write_with_stats(raw, cleaned, output_path, processing_date or _dt.datetime.now().isoformat())


def run_clean_transactions(spark, input_glob: str, output_path: str) -> DataFrame:
    """J3 as a job: headerless CSV files (S2) -> de-dup (D1) -> null / zero profiles (A2, A3) ->
    zero-id filter (F5) -> ``tx_date`` (P6) -> date-partitioned Parquet (K2).

    Ragged lines go to ``<output>_rejected``. The de-duplicated rows are checkpointed once and profiled by one
    aggregate. Returns (column_name, kind, count): ``null`` and ``zero`` per column, and for the whole input
    ``input`` rows, ``rejected`` lines, ``duplicate`` rows removed."""
    from autoprice.operators import clean as C
    from autoprice.operators import profile as PR
    from autoprice.session import ensure_checkpoint_dir
    from autoprice.sources import readers as RD
    from autoprice.sources import sinks as SK
    ensure_checkpoint_dir(spark)
    good, bad = RD.split_corrupt(RD.read_csv_positional(spark, input_glob, corrupt=True))
    rejected = f"{output_path.rstrip('/')}_rejected"
    bad.select("value").write.mode("overwrite").text(rejected)
    counted = C.dedupe_rows_counted(good).checkpoint()
    deduped = counted.drop(C.COPIES)
    n_rows, n_distinct = counted.agg(F.coalesce(F.sum(C.COPIES), F.lit(0)), F.count(F.lit(1))).first()
    n_bad = spark.read.text(rejected).count()
    profiles = PR.null_profile(deduped).select("column_name", F.lit("null").alias("kind"),
                                               F.col("null_count").alias("count")) \
        .unionByName(PR.zero_profile(deduped).select("column_name", F.lit("zero").alias("kind"),
                                                     F.col("zero_count").alias("count")))
    whole = spark.createDataFrame([("", "input", n_rows + n_bad), ("", "rejected", n_bad), ("", "duplicate", n_rows - n_distinct)],
                                  "column_name string, kind string, count bigint")
    kept = C.filter_zero_ids(deduped).withColumn("tx_date", C.derive_date("tx_datetime"))
    SK.write_partitioned(kept, output_path, "tx_date")
    return profiles.unionByName(whole)


def run_temperature_etl(spark, input_path: str, output_path: str, min_year: int = 2000) -> DataFrame:
    """J4 as a job: dated CSV (S4, columns by name) -> year filter -> median per country -> CSV (K3)."""
    from autoprice.operators import clean as C
    from autoprice.sources import readers as RD
    from autoprice.sources import sinks as SK
    out = C.temperature_etl(RD.read_dated_csv(spark, input_path), min_year)
    SK.write_csv(out, output_path)
    return out


def main(argv: list[str] | None = None) -> int:
    """Command line: ``python -m autoprice.plans.jobs <job> --input PATH --output PATH [...]``."""
    import argparse

    from autoprice.session import get_spark
    ap = argparse.ArgumentParser(prog="autoprice.plans.jobs")
    ap.add_argument("job", choices=["clean-cars", "clean-transactions", "temperature-etl"])
    ap.add_argument("--input", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--rules", default="mean", choices=["mean", "median"])
    ap.add_argument("--as-of-year", type=int, default=None)
    ap.add_argument("--min-year", type=int, default=2000)
    ap.add_argument("--infer-schema", action="store_true")
    a = ap.parse_args(argv)
    spark = get_spark()
    if a.job == "clean-cars":
        run_clean_cars(spark, a.input, a.output, a.rules, a.as_of_year, a.infer_schema).show(truncate=False)
    elif a.job == "clean-transactions":
        run_clean_transactions(spark, a.input, a.output).show(truncate=False)
    else:
        run_temperature_etl(spark, a.input, a.output, a.min_year).show(truncate=False)
    return 0


if __name__ == "__main__":
    import sys
    sys.exit(main())
