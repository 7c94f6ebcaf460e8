"""Models and model-validation jobs.

Two families:

* Spark ML estimators for the reference's forests and least squares (M1-M3, M5-M7): distributed
  training, ``PipelineModel`` persistence, ``CrossValidator`` for the search.
* A one-variable least-squares *formula model* fitted by one aggregate over centred sums
  (``regr_slope``), for all folds at once in cross-validation. It backs the SQL-checkable forms of the
  validation workflow (B6-B11, M4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autoprice.operators.metrics import regression_aggs, regression_from_aggs
from autoprice.operators.split import kfold_assign, kfold_stratified, split_time_ordered


# ------------------------------------------------------------------ formula model (least squares, one variable)

def ols_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: n, slope, intercept, over the rows where both are known. ``regr_slope`` works on centred
    sums, so large values do not cancel. A constant x gives slope 0 and the mean as intercept."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    xc, yc = F.col(x).cast("double"), F.col(y).cast("double")
    slope = F.coalesce(F.regr_slope(yc, xc), F.lit(0.0))
    s = both.agg(F.count(F.lit(1)).alias("n"), slope.alias("slope"), F.avg(xc).alias("mx"), F.avg(yc).alias("my"))
    return s.select("n", F.when(F.col("n") > 0, F.col("slope")).alias("slope"),
                    (F.col("my") - F.col("slope") * F.col("mx")).alias("intercept"))


def ols_predict(df: DataFrame, fit: DataFrame, x: str, out: str = "yhat") -> DataFrame:
    """Apply a fitted row (as a scalar subquery: no join, no driver round trip)."""
    m = fit.select(F.struct("slope", "intercept").alias("m")).scalar()
    # attach the fitted row once (one subquery), then use its fields
    d = df.withColumn("_m", m)
    return d.withColumn(out, F.col("_m.intercept") + F.col("_m.slope") * F.col(x)).drop("_m")


def time_ab_metrics(df: DataFrame, order_key: str, x: str, y: str) -> DataFrame:
    """Model A trained on the old segment and tested on all new rows; model B trained on old
    plus the first 70 % of new and tested on the last 30 %. The test sets differ (as in the
    reference), so both row counts are reported. Fewer than 2 test rows -> R^2 = 0."""
    seg = split_time_ordered(df.select(order_key, x, y), order_key)
    old = seg.where(F.col("segment") == "old")
    a_train, a_test = old, seg.where(F.col("segment") != "old")
    b_train, b_test = seg.where(F.col("segment") != "new_test"), seg.where(F.col("segment") == "new_test")
    rows = []
    for name, tr, te in (("A", a_train, a_test), ("B", b_train, b_test)):
        fit = ols_fit(tr, x, y)
        scored = ols_predict(te, fit, x)
        n_train = tr.agg(F.count(F.lit(1))).scalar()
        m = scored.agg(*regression_aggs(y, "yhat")).select(*regression_from_aggs(small_r2="zero"))
        rows.append(m.select(F.lit(name).alias("model"), n_train.alias("n_train"), F.col("n").alias("n_test"),
                             "r2", "mae", "rmse"))
    return rows[0].unionByName(rows[1])


def cross_validate_ols(df: DataFrame, key: str, x: str, y: str, k: int = 3) -> DataFrame:
    """M4 for the formula model: contiguous k folds (O10) over the rows where x and y are known; each fold
    is scored by the model fitted on the other folds. Returns per-fold R^2 and RMSE plus the mean and
    population standard deviation of both across folds."""
    folds = kfold_assign(df.select(key, x, y).where(F.col(x).isNotNull() & F.col(y).isNotNull()), key, k)
    # every row trains the k - 1 models of the other folds: one aggregate, k rows
    others = folds.select(x, y, F.explode(F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: i != F.col("fold"))).alias("fold"))
    xc, yc = F.col(x).cast("double"), F.col(y).cast("double")
    models = others.groupBy("fold").agg(F.coalesce(F.regr_slope(yc, xc), F.lit(0.0)).alias("slope"), F.avg(xc).alias("mx"),
                                        F.avg(yc).alias("my")).withColumn("intercept", F.col("my") - F.col("slope") * F.col("mx"))
    # k rows (k is the fold count parameter): a bounded broadcast.
    scored = folds.join(F.broadcast(models), "fold").withColumn("yhat", F.col("intercept") + F.col("slope") * F.col(x))
    per = scored.groupBy("fold").agg(*regression_aggs(y, "yhat")).select("fold", *regression_from_aggs("null"))
    # k fold rows: gathered with their means and deviations in one aggregate, then unfolded
    spread = [f(c).alias(f"cv_{c}_{n}") for c in ("r2", "rmse") for n, f in (("mean", F.avg), ("std", F.stddev_pop))]
    agg = per.agg(F.collect_list(F.struct("fold", "r2", "rmse")).alias("_f"), *spread)
    names = ["cv_r2_mean", "cv_r2_std", "cv_rmse_mean", "cv_rmse_std"]
    return agg.select(F.explode("_f").alias("f"), *names).select("f.fold", "f.r2", "f.rmse", *names)


def cross_validate(estimator, train: DataFrame, key: str, k: int = 3, label: str = "label") -> tuple | None:
    """M4 for any estimator: contiguous folds over ``train``, one fit per fold; returns (mean R^2, its
    deviation, mean RMSE, its deviation) over the folds, or None where there are too few rows.

    Fewer than 2k rows fall back to two folds, fewer than four to none (O10).
    """
    folds = kfold_assign(train, key, k)
    per = []
    for f in sorted(r.fold for r in folds.select("fold").distinct().collect() if r.fold is not None):
        model = estimator.fit(folds.where(F.col("fold") != f))
        m = model.transform(folds.where(F.col("fold") == f)).agg(*regression_aggs(label, "prediction"))
        per.append(m.select(*regression_from_aggs("null")).first())
    if not per:
        return None
    r2, rmse = ([getattr(m, c) for m in per if getattr(m, c) is not None] for c in ("r2", "rmse"))
    mean = lambda v: sum(v) / len(v) if v else None
    std = lambda v: (sum((x - mean(v)) ** 2 for x in v) / len(v)) ** 0.5 if v else None
    return mean(r2), std(r2), mean(rmse), std(rmse)


# ------------------------------------------------------------------ Spark ML estimators (M1-M3, M5-M7)

#: Partitions of a training table. Forests draw their samples by partition, so this number is part of the
#: model's definition: it does not follow the cluster or the layout of the input. Raise it with the data.
TRAINING_PARTITIONS = 16


def training_layout(df: DataFrame, key: str, partitions: int = TRAINING_PARTITIONS) -> DataFrame:
    """The rows dealt by hash of ``key`` into a fixed number of partitions and sorted by it: the same
    rows give the same partitions, and so the same model, however the input is split."""
    return df.repartition(partitions, key).sortWithinPartitions(key)


def rf_regressor(features: str = "features", label: str = "label", trees: int = 100, depth: int | None = 10,
                 min_leaf: int = 1, seed: int = 42, max_bins: int = 64, group_mb: int = 256):
    """M1: random forest regression with every feature considered at each split (scikit-learn's
    default). An unbounded depth maps to Spark's maximum of 30. ``max_bins`` bounds the split
    candidates per feature and must be at least the categories of a categorical one. ``group_mb`` bounds the
    histograms that a pass over the rows fills; with every feature considered, the forest does not depend on it."""
    from pyspark.ml.regression import RandomForestRegressor
    return RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=trees,
                                 maxDepth=min(depth if depth is not None else 30, 30), minInstancesPerNode=min_leaf,
                                 featureSubsetStrategy="all", seed=seed, maxBins=max_bins, maxMemoryInMB=group_mb)


def linear_regression(features: str = "features", label: str = "label"):
    """M2: ordinary least squares (no regularisation, normal equations)."""
    from pyspark.ml.regression import LinearRegression
    return LinearRegression(featuresCol=features, labelCol=label, regParam=0.0, elasticNetParam=0.0, solver="normal")


def rf_classifier(features: str = "features", label: str = "label", trees: int = 35, depth: int = 9, seed: int = 42):
    """M3: random forest classifier, sqrt(features) per split."""
    from pyspark.ml.classification import RandomForestClassifier
    return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=trees, maxDepth=depth,
                                  featureSubsetStrategy="sqrt", seed=seed)


def random_search(estimator, train: DataFrame, grid: dict, key: str, draws: int = 30, folds: int = 3, seed: int = 42,
                  label: str = "label", parallelism: int = 4):
    """M5: ``draws`` random points of the parameter grid (the whole grid when draws >= its size),
    scored by F1 of class 1 with k class-balanced folds (O11), best refit on all training rows."""
    import itertools
    import random

    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator
    keys = list(grid)
    points = list(itertools.product(*[grid[k] for k in keys]))
    rnd = random.Random(seed)
    chosen = points if draws >= len(points) else rnd.sample(points, draws)
    maps = [{getattr(estimator, k): v for k, v in zip(keys, p)} for p in chosen]
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0)
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=ev, numFolds=folds, foldCol="fold",
                        parallelism=parallelism)
    return cv.fit(training_layout(kfold_stratified(train, key, label, folds, seed), key))


def batch_predict(model, df: DataFrame, out: str = "prediction") -> DataFrame:
    """M6: score a table with a fitted (pipeline) model."""
    return model.transform(df).withColumnRenamed("prediction", out) if out != "prediction" else model.transform(df)


def save_model(model, path: str) -> str:
    """M7: persist (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """M7: reload a ``PipelineModel``; a missing path (asked of the path's own file system) raises
    ``FileNotFoundError``."""
    from pyspark.ml import PipelineModel
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        raise FileNotFoundError(f"no model at {path}")
    return PipelineModel.load(path)
