"""Catalogue entries: model metrics (Q1-Q4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from autoprice.operators import metrics as M
from autoprice.plans.fixtures import view, with_views
from autoprice.plans.registry import register

R6 = lambda c: F.round(F.col(c), 6).alias(c)


def reg_sql(src: str, y: str = "y", yhat: str = "yhat", small: str = "null") -> str:
    """DuckDB form of ``regression_metrics`` over a relation (returns n, mae, mse, rmse, r2)."""
    return f"""select n, mae, mse, sqrt(mse) as rmse,
  case when n < 2 then {small} when v = 0 then (case when mse = 0 then 1.0 else 0.0 end) else 1 - mse / v end as r2
from (select count(*) as n, avg(abs({yhat} - {y})) as mae, avg(({yhat} - {y}) * ({yhat} - {y})) as mse,
             var_pop({y}) as v from {src})"""


def cls_sql(src: str, y: str, p: str) -> str:
    return f"""select tp, fp, fn, tn,
  coalesce(tp / nullif(tp + fp, 0), 0.0) as precision, coalesce(tp / nullif(tp + fn, 0), 0.0) as recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) as f1,
  (tp / nullif(tp + fn, 0) + tn / nullif(tn + fp, 0)) / 2 as auc
from (select cast(count_if({y} = 1 and {p} = 1) as bigint) as tp, cast(count_if({y} = 0 and {p} = 1) as bigint) as fp,
             cast(count_if({y} = 1 and {p} = 0) as bigint) as fn, cast(count_if({y} = 0 and {p} = 0) as bigint) as tn
      from {src})"""


@register("regression_metrics", with_views(
    f"select n, round(mae, 6) as mae, round(mse, 6) as mse, round(rmse, 6) as rmse, round(r2, 6) as r2 "
    f"from ({reg_sql('scored')})", "scored"))
def q_regression_metrics(spark, sf_dir):
    m = M.regression_metrics(view(spark, sf_dir, "scored"), "y", "yhat")
    return m.select("n", R6("mae"), R6("mse"), R6("rmse"), R6("r2"))


@register("classification_metrics", with_views(
    "select tp, fp, fn, tn, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, "
    f"round(auc, 6) as auc from ({cls_sql('preds', 'y', 'yhat_prod')})", "preds"))
def q_classification_metrics(spark, sf_dir):
    m = M.classification_metrics(view(spark, sf_dir, "preds"), "y", "yhat_prod")
    return m.select("tp", "fp", "fn", "tn", R6("precision"), R6("recall"), R6("f1"), R6("auc"))


@register("auc_hard_labels", with_views(
    f"select 'prod' as model, round(auc, 6) as auc from ({cls_sql('preds', 'y', 'yhat_prod')}) "
    f"union all select 'cand', round(auc, 6) from ({cls_sql('preds', 'y', 'yhat_cand')}) "
    f"union all select 'positives_only', round(auc, 6) from ({cls_sql('(select * from preds where y = 1)', 'y', 'yhat_prod')})",
    "preds"))
def q_auc(spark, sf_dir):
    p = view(spark, sf_dir, "preds")
    # one aggregate of both models' confusion counts; the positives-only row (one class, AUC
    # undefined -> NULL) is the prod counts restricted to y = 1: tp and fn, no fp or tn
    c = p.agg(*M.confusion_aggs("y", "yhat_prod", prefix="p_"), *M.confusion_aggs("y", "yhat_cand", prefix="c_"))
    zero = F.lit(0).cast("bigint")
    cells = F.array(
        F.struct(F.lit("prod").alias("model"), *[F.col(f"p_{k}").alias(k) for k in ("tp", "fp", "fn", "tn")]),
        F.struct(F.lit("cand").alias("model"), *[F.col(f"c_{k}").alias(k) for k in ("tp", "fp", "fn", "tn")]),
        F.struct(F.lit("positives_only").alias("model"), F.col("p_tp").alias("tp"), zero.alias("fp"),
                 F.col("p_fn").alias("fn"), zero.alias("tn")))
    rows = c.select(F.explode(cells).alias("r")).select("r.*")
    return rows.select("model", *M.classification_from_counts()).select("model", R6("auc"))


@register("non_null_metrics", with_views(f"""
, r as ({reg_sql('scored')}),
c as ({cls_sql('preds', 'y', 'yhat_prod')}),
o as ({cls_sql('(select * from preds where y = 1)', 'y', 'yhat_prod')}),
l as (select 'mae' as metric, (select mae from r) as value union all select 'rmse', (select rmse from r)
  union all select 'r2', (select r2 from r) union all select 'f1', (select f1 from c)
  union all select 'auc', (select auc from c) union all select 'auc_positives_only', (select auc from o))
select metric, round(value, 6) as value from l where value is not null and not isnan(value)""", "scored", "preds"))
def q_non_null_metrics(spark, sf_dir):
    reg = M.regression_metrics(view(spark, sf_dir, "scored"), "y", "yhat")
    p = view(spark, sf_dir, "preds")
    c = M.classification_metrics(p, "y", "yhat_prod")
    o = M.classification_metrics(p.where("y = 1"), "y", "yhat_prod")
    row = reg.select("mae", "rmse", "r2", c.select(F.struct("f1", "auc")).scalar().alias("_c"),
                     o.select("auc").scalar().alias("auc_positives_only")) \
             .select("mae", "rmse", "r2", F.col("_c.f1").alias("f1"), F.col("_c.auc").alias("auc"), "auc_positives_only")
    return M.non_null_metrics(row).select("metric", R6("value"))
