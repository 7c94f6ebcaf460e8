"""Model metrics as one-pass aggregates.

No metric collects predictions: every value is a sum over rows, so partial aggregation runs on
the map side and only a handful of numbers per group are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def regression_aggs(y: str, yhat: str) -> list[Column]:
    """Aggregates over the rows where target and prediction are both known."""
    e = F.col(yhat) - F.col(y)
    return [F.count(e).alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
            F.var_pop(F.when(e.isNotNull(), F.col(y))).alias("_var_y")]


def regression_from_aggs(small_r2: str = "null") -> list[Column]:
    """MAE, MSE, RMSE, R^2 from the aggregate columns. R^2 follows scikit-learn: constant y gives
    1 for a perfect fit and 0 otherwise; fewer than 2 rows give NULL (``small_r2='null'``) or 0."""
    r2 = F.when(F.col("_var_y") == 0, F.when(F.col("mse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))) \
          .otherwise(1 - F.col("mse") / F.col("_var_y"))
    small = F.lit(None).cast("double") if small_r2 == "null" else F.lit(0.0)
    r2 = F.when(F.col("n") < 2, small).otherwise(r2)
    return [F.col("n"), F.col("mae"), F.col("mse"), F.sqrt("mse").alias("rmse"), r2.alias("r2")]


def regression_metrics(df: DataFrame, y: str = "y", yhat: str = "yhat", group_cols: list[str] | None = None,
                       small_r2: str = "null") -> DataFrame:
    """Q1: n, MAE, MSE, RMSE, R^2 (optionally per group)."""
    g = list(group_cols or [])
    agg = df.groupBy(*g).agg(*regression_aggs(y, yhat)) if g else df.agg(*regression_aggs(y, yhat))
    return agg.select(*g, *regression_from_aggs(small_r2))


def confusion_aggs(y: str, yhat: str, weight: Column | None = None, prefix: str = "") -> list[Column]:
    w = weight if weight is not None else F.lit(1)
    yc, pc = F.col(y), F.col(yhat)
    cell = lambda a, b: F.sum(F.when((yc == a) & (pc == b), w).otherwise(F.lit(0))).cast("bigint")
    return [cell(1, 1).alias(f"{prefix}tp"), cell(0, 1).alias(f"{prefix}fp"),
            cell(1, 0).alias(f"{prefix}fn"), cell(0, 0).alias(f"{prefix}tn")]


def classification_from_counts(prefix: str = "") -> list[Column]:
    """Q2 + Q3 from tp/fp/fn/tn: precision, recall, F1 for class 1 (0 when undefined), and AUC of
    hard labels = (TPR + TNR) / 2 (NULL when a class is absent)."""
    tp, fp, fn, tn = (F.col(f"{prefix}{c}") for c in ("tp", "fp", "fn", "tn"))
    precision = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    recall = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0))
    auc = (F.try_divide(tp, tp + fn) + F.try_divide(tn, tn + fp)) / 2
    return [precision.cast("double").alias("precision"), recall.cast("double").alias("recall"),
            f1.cast("double").alias("f1"), auc.cast("double").alias("auc")]


def classification_metrics(df: DataFrame, y: str = "y", yhat: str = "yhat",
                           group_cols: list[str] | None = None) -> DataFrame:
    """Q2 / Q3: confusion counts and metrics, one row (per group)."""
    g = list(group_cols or [])
    agg = df.groupBy(*g).agg(*confusion_aggs(y, yhat)) if g else df.agg(*confusion_aggs(y, yhat))
    return agg.select(*g, "tp", "fp", "fn", "tn", *classification_from_counts())


def non_null_metrics(metrics_row: DataFrame, id_cols: list[str] | None = None) -> DataFrame:
    """Q4: long (metric, value) rows, dropping NULL / NaN metrics (what gets logged)."""
    ids = list(id_cols or [])
    vals = [c for c in metrics_row.columns if c not in ids]
    long = metrics_row.select(*ids, *[F.col(c).cast("double").alias(c) for c in vals]) \
                      .unpivot(ids, vals, "metric", "value")
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))
