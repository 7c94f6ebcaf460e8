"""Catalogue entries: bootstrap, t-test, decisions and validation ladders."""

from __future__ import annotations

from pyspark.sql import functions as F

from autoprice.functions.scalar import poisson1_sql, uniform_sql
from autoprice.functions.stats import t_critical
from autoprice.operators import abtest as AB
from autoprice.operators import models as MD
from autoprice.operators import split as S
from autoprice.operators.metrics import regression_metrics
from autoprice.plans.fixtures import view, with_views
from autoprice.plans.q_metrics import reg_sql
from autoprice.plans.registry import register

R6 = lambda c: F.round(F.col(c), 6).alias(c)
B, SEED, ALPHA = 100, 42, 0.01
PREDS = {"prod": "yhat_prod", "cand": "yhat_cand"}

_W = poisson1_sql(uniform_sql("cast(doc_id as varchar) || '-' || cast(iteration // 4 as varchar) || '-42'", "iteration % 4"))
_BOOT = f"""
, w as (select doc_id, y, yhat_prod, yhat_cand, unnest(range({B})) as iteration from preds),
ww as (select *, {_W} as w from w),
c as (select iteration,
  cast(sum(case when y = 1 and yhat_prod = 1 then w else 0 end) as bigint) as prod_tp,
  cast(sum(case when y = 0 and yhat_prod = 1 then w else 0 end) as bigint) as prod_fp,
  cast(sum(case when y = 1 and yhat_prod = 0 then w else 0 end) as bigint) as prod_fn,
  cast(sum(case when y = 0 and yhat_prod = 0 then w else 0 end) as bigint) as prod_tn,
  cast(sum(case when y = 1 and yhat_cand = 1 then w else 0 end) as bigint) as cand_tp,
  cast(sum(case when y = 0 and yhat_cand = 1 then w else 0 end) as bigint) as cand_fp,
  cast(sum(case when y = 1 and yhat_cand = 0 then w else 0 end) as bigint) as cand_fn,
  cast(sum(case when y = 0 and yhat_cand = 0 then w else 0 end) as bigint) as cand_tn
  from ww group by iteration),
l as (select iteration, 'prod' as model, prod_tp as tp, prod_fp as fp, prod_fn as fn, prod_tn as tn from c
  union all select iteration, 'cand', cand_tp, cand_fp, cand_fn, cand_tn from c),
m as (select iteration, model, tp, fp, fn, tn,
  coalesce(tp / nullif(tp + fp, 0), 0.0) as precision, coalesce(tp / nullif(tp + fn, 0), 0.0) as recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) as f1,
  (tp / nullif(tp + fn, 0) + tn / nullif(tn + fp, 0)) / 2 as auc from l)"""

_TT = _BOOT + """,
lm as (select model, 'f1' as metric, f1 as value from m union all select model, 'precision', precision from m),
s as (select metric,
  count(*) filter (where model = 'prod') as n_b, count(*) filter (where model = 'cand') as n_c,
  avg(value) filter (where model = 'prod') as base_mean, avg(value) filter (where model = 'cand') as candidate_mean,
  var_samp(value) filter (where model = 'prod') as var_b, var_samp(value) filter (where model = 'cand') as var_c
  from lm group by metric),
tt as (select metric, (base_mean - candidate_mean)
    / sqrt(((n_b - 1) * var_b + (n_c - 1) * var_c) / (n_b + n_c - 2) * (1.0 / n_b + 1.0 / n_c)) as t_statistic,
  n_b + n_c - 2 as dof, abs(candidate_mean - base_mean) / sqrt((var_b + var_c) / 2) as effect_size,
  base_mean, candidate_mean, candidate_mean - base_mean as improvement from s)"""


def _boot(spark, sf_dir):
    return AB.bootstrap_confusion_poisson(view(spark, sf_dir, "preds"), "doc_id", "y", PREDS, B, SEED)


@register("bootstrap_metrics", with_views(_BOOT + """
select iteration, model, tp, fp, fn, tn, round(precision, 6) as precision, round(recall, 6) as recall,
  round(f1, 6) as f1, round(auc, 6) as auc from m""", "preds"))
def q_bootstrap(spark, sf_dir):
    return _boot(spark, sf_dir).select("iteration", "model", "tp", "fp", "fn", "tn",
                                       R6("precision"), R6("recall"), R6("f1"), R6("auc"))


@register("paired_bootstrap", with_views(_BOOT + """
select iteration, round(max(f1) filter (where model = 'prod'), 6) as f1_prod,
  round(max(f1) filter (where model = 'cand'), 6) as f1_cand from m group by iteration""", "preds"))
def q_paired_bootstrap(spark, sf_dir):
    b = _boot(spark, sf_dir)
    return b.groupBy("iteration").agg(F.round(F.max(F.when(F.col("model") == "prod", F.col("f1"))), 6).alias("f1_prod"),
                                      F.round(F.max(F.when(F.col("model") == "cand", F.col("f1"))), 6).alias("f1_cand"))


@register("bootstrap_metrics_multinomial", with_views(f"""
select i.iteration, m.model, (select count(*) from preds where y is not null and yhat_prod is not null and yhat_cand is not null) as n_drawn,
  true as in_range from (select unnest(range({B})) as iteration) i, (select unnest(['prod', 'cand']) as model) m""", "preds"))
def q_bootstrap_multinomial(spark, sf_dir):
    """Every draw has as many rows as the data, and metrics between 0 and 1."""
    b = AB.bootstrap_confusion_multinomial(view(spark, sf_dir, "preds"), "y", PREDS, B, SEED)
    ok = F.lit(True)
    for c in ("precision", "recall", "f1"):
        ok = ok & F.col(c).between(0, 1)
    return b.select("iteration", "model", (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n_drawn"), ok.alias("in_range"))


def _ttest(spark, sf_dir, with_p=False):
    return AB.t_test(_boot(spark, sf_dir), "prod", "cand", ["f1", "precision"], ALPHA, with_p=with_p)


@register("t_test", with_views(_TT + """
select metric, round(t_statistic, 6) as t_statistic, dof, round(effect_size, 6) as effect_size,
  round(base_mean, 6) as base_mean, round(candidate_mean, 6) as candidate_mean,
  round(improvement, 6) as improvement from tt""", "preds"))
def q_t_test(spark, sf_dir):
    t = _ttest(spark, sf_dir)
    return t.select("metric", R6("t_statistic"), "dof", R6("effect_size"), R6("base_mean"), R6("candidate_mean"),
                    R6("improvement"))


@register("effect_size", with_views(_TT + "\nselect metric, round(effect_size, 6) as effect_size from tt", "preds"))
def q_effect_size(spark, sf_dir):
    return _ttest(spark, sf_dir).select("metric", R6("effect_size"))


# Two-sided 1 % critical value of Student's t with 198 degrees of freedom (two models x 100 draws).
_T_CRIT = t_critical(ALPHA, 2 * B - 2)


@register("deploy_decision", with_views(_TT + f""",
d as (select abs(t_statistic) > {_T_CRIT!r} as sig, improvement > 0 as imp from tt where metric = 'f1')
select sig as f1_significant, imp as f1_improved,
  case when sig and imp then '{AB.DECISION_DEPLOY}' else '{AB.DECISION_KEEP}' end as decision,
  case when sig and imp then '{AB.REASON_SIGNIFICANT}' when not imp then '{AB.REASON_NO_IMPROVEMENT}'
       else '{AB.REASON_NOT_SIGNIFICANT}' end as reason from d""", "preds"))
def q_deploy_decision(spark, sf_dir):
    return AB.deploy_decision(_ttest(spark, sf_dir, with_p=True))


@register("t_test_pvalues", with_views(_TT + f"""
select metric, round(t_statistic, 6) as t_statistic, dof, abs(t_statistic) > {_T_CRIT!r} as is_significant,
  abs(t_statistic) > {_T_CRIT!r} as p_below_alpha from tt""", "preds"))
def q_t_test_pvalues(spark, sf_dir):
    """The p-value falls below the level exactly where t passes the critical value."""
    t = _ttest(spark, sf_dir, with_p=True)
    return t.select("metric", R6("t_statistic"), "dof", "is_significant", (F.col("p_value") < ALPHA).alias("p_below_alpha"))


@register("t_test_full")
def q_t_test_full(spark, sf_dir):
    """B3 with its p-values (``t_test_pvalues`` holds them to the critical value)."""
    return _ttest(spark, sf_dir, with_p=True)


@register("bootstrap_multinomial_rows")
def q_bootstrap_multinomial_rows(spark, sf_dir):
    """B1 at scale, with the metrics of every draw."""
    return AB.bootstrap_confusion_multinomial(view(spark, sf_dir, "preds"), "y", PREDS, B, SEED)


# ------------------------------------------------------------------ time-ordered A/B with the formula model

def _ols_sql(name: str, src: str) -> str:
    return f"""{name} as (select n, case when n * sxx - sx * sx = 0 then 0.0 else (n * sxy - sx * sy) / (n * sxx - sx * sx) end as slope,
    sx, sy from (select count(*) as n, sum(x) as sx, sum(y) as sy, sum(x * x) as sxx, sum(x * y) as sxy from {src})),
{name}_m as (select n, slope, (sy - slope * sx) / n as intercept from {name})"""


_AB = f"""
, r as (select car_id, yhat as x, y, row_number() over (order by car_id) - 1 as i, count(*) over () as n from scored),
p as (select *, greatest(2, cast(trunc(n * 0.6) as bigint)) as sp from r),
q as (select *, greatest(1, cast(trunc(greatest(n - sp, 0) * 0.7) as bigint)) as ts from p),
seg as (select x, y, case when i < sp then 'old' when i < sp + ts then 'new_train' else 'new_test' end as segment from q),
{_ols_sql('fa', "(select * from seg where segment = 'old')")},
{_ols_sql('fb', "(select * from seg where segment <> 'new_test')")},
ta as (select y, (select intercept from fa_m) + (select slope from fa_m) * x as yhat from seg where segment <> 'old'),
tb as (select y, (select intercept from fb_m) + (select slope from fb_m) * x as yhat from seg where segment = 'new_test'),
ma as ({reg_sql('ta', small='0.0')}), mb as ({reg_sql('tb', small='0.0')}),
ab as (select 'A' as model, (select n from fa_m) as n_train, n as n_test, r2, mae, rmse from ma
  union all select 'B', (select n from fb_m), n, r2, mae, rmse from mb)"""


def _time_ab(spark, sf_dir):
    return MD.time_ab_metrics(view(spark, sf_dir, "scored").withColumnRenamed("yhat", "x"), "car_id", "x", "y")


@register("time_ab_metrics", with_views(_AB + """
select model, n_train, n_test, round(r2, 6) as r2, round(mae, 6) as mae, round(rmse, 6) as rmse from ab""", "scored"))
def q_time_ab(spark, sf_dir):
    return _time_ab(spark, sf_dir).select("model", "n_train", "n_test", R6("r2"), R6("mae"), R6("rmse"))


_VAL = _AB + f""",
v as (select {", ".join(f"(select {c} from ab where model = '{m}') as {c}_{m.lower()}" for m in "AB" for c in ("r2", "mae", "rmse"))},
  (select n_train from ab where model = 'A') as n_old, (select n_test from ab where model = 'A') as n_new,
  (select n_test from ab where model = 'B') as n_test_b),
sk as (select *, case when n_old + n_new < 6 then '{AB.STATUS_SKIPPED}'
                      when n_new < 2 or n_old < 2 then '{AB.STATUS_SKIPPED_SPLIT}' end as skip from v),
vi as (select *, case when skip is not null or r2_a = 0 then 0.0 else (r2_b - r2_a) / r2_a * 100 end as improvement_pct from sk),
vs as (select *, coalesce(skip, case when improvement_pct > 5 then '{AB.STATUS_IMPROVED}'
    when improvement_pct > -5 then '{AB.STATUS_NO_DEGRADATION}' else '{AB.STATUS_DEGRADED}' end) as validation_status,
  case when skip is null and improvement_pct > -5 then 1 else 0 end as status_code from vi)"""


def _validation(spark, sf_dir):
    ab = _time_ab(spark, sf_dir)
    at = lambda m, c: F.max(F.when(F.col("model") == m, F.col(c)))
    row = ab.agg(*[at(m, c).alias(f"{c}_{m.lower()}") for m in "AB" for c in ("r2", "mae", "rmse")],
                 at("A", "n_train").alias("n_old"), at("A", "n_test").alias("n_new"), at("B", "n_test").alias("n_test_b"))
    return AB.validated(row).withColumnRenamed("validation_code", "status_code")


@register("improvement_pct", with_views(_VAL + """
select round(r2_a, 6) as r2_a, round(r2_b, 6) as r2_b, round(improvement_pct, 6) as improvement_pct,
  r2_a < 0 as sign_flipped from vs""", "scored"))
def q_improvement_pct(spark, sf_dir):
    v = _validation(spark, sf_dir)
    return v.select(R6("r2_a"), R6("r2_b"), R6("improvement_pct"), (F.col("r2_a") < 0).alias("sign_flipped"))


@register("validation_status", with_views(_VAL + "\nselect validation_status, status_code from vs", "scored"))
def q_validation_status(spark, sf_dir):
    return _validation(spark, sf_dir).select("validation_status", "status_code")


@register("validation_skip", with_views(_VAL + f"""
select n_old, n_new, case when n_old + n_new < 6 then '{AB.STATUS_SKIPPED}'
  when n_new < 2 or n_old < 2 then '{AB.STATUS_SKIPPED_SPLIT}' else 'RUN' end as skip_status from vs""", "scored"))
def q_validation_skip(spark, sf_dir):
    v = _validation(spark, sf_dir)
    skip = AB.validation_skip(F.col("n_old") + F.col("n_new"), F.col("n_old"), F.col("n_new"))
    return v.select("n_old", "n_new", F.coalesce(skip, F.lit("RUN")).alias("skip_status"))


# ------------------------------------------------------------------ cross-validation, grade, summary

_CV = """
, cr as (select car_id, yhat as x, y, row_number() over (order by car_id) - 1 as i, count(*) over () as n from scored),
cp as (select x, y, cast(case when i < (n % 3) * (n // 3 + 1) then floor(i / (n // 3 + 1))
                  else (n % 3) + floor((i - (n % 3) * (n // 3 + 1)) / (n // 3)) end as integer) as fold from cr),
per as (select fold, count(*) as n, sum(x) as sx, sum(y) as sy, sum(x * x) as sxx, sum(x * y) as sxy from cp group by fold),
tot as (select sum(n) as n, sum(sx) as sx, sum(sy) as sy, sum(sxx) as sxx, sum(sxy) as sxy from per),
cm as (select fold, (select n from tot) - n as n, (select sx from tot) - sx as sx, (select sy from tot) - sy as sy,
  (select sxx from tot) - sxx as sxx, (select sxy from tot) - sxy as sxy from per),
cs as (select fold, n, sx, sy, case when n * sxx - sx * sx = 0 then 0.0 else (n * sxy - sx * sy) / (n * sxx - sx * sx) end as slope from cm),
mdl as (select fold, slope, (sy - slope * sx) / n as intercept from cs),
sc as (select cp.fold, y, intercept + slope * x as yhat from cp join mdl on cp.fold = mdl.fold),
fr as (select fold, n, sqrt(mse) as rmse, case when n < 2 then null when v = 0 then (case when mse = 0 then 1.0 else 0.0 end)
  else 1 - mse / v end as r2 from (select fold, count(*) as n, avg((yhat - y) * (yhat - y)) as mse, var_pop(y) as v
  from sc group by fold)),
cv as (select fold, r2, rmse, avg(r2) over () as cv_r2_mean, stddev_pop(r2) over () as cv_r2_std,
  avg(rmse) over () as cv_rmse_mean, stddev_pop(rmse) over () as cv_rmse_std from fr)"""


_CV_OUT = ["r2", "rmse", "cv_r2_mean", "cv_r2_std", "cv_rmse_mean", "cv_rmse_std"]


@register("cross_validate", with_views(_CV + f"""
select fold, {", ".join(f"round({c}, 6) as {c}" for c in _CV_OUT)} from cv""", "scored"))
def q_cross_validate(spark, sf_dir):
    cv = MD.cross_validate_ols(view(spark, sf_dir, "scored").withColumnRenamed("yhat", "x"), "car_id", "x", "y", 3)
    return cv.select("fold", *[R6(c) for c in _CV_OUT])


_RUN = _VAL + "," + _CV.lstrip()[1:] + f""",
sp as (select x, y, case when {uniform_sql("cast(car_id as varchar) || '-s-42'")} < 0.2 then 'test' else 'train' end as split
       from (select car_id, yhat as x, y from scored)),
{_ols_sql('ft', "(select * from sp where split = 'train')")},
te as (select y, (select intercept from ft_m) + (select slope from ft_m) * x as yhat from sp where split = 'test'),
mt as ({reg_sql('te')}),
run as (select (select r2 from mt) as r2, (select mae from mt) as mae, (select rmse from mt) as rmse,
  (select max(cv_r2_mean) from cv) as cv_r2, (select max(cv_r2_std) from cv) as cv_r2_std, validation_status, improvement_pct,
  n_old + n_new as n_total from vs),
g as (select *, case when coalesce(r2 > 0.8, false) and coalesce(cv_r2 > 0.7, false) then '{AB.GRADE_EXCELLENT}'
  when coalesce(r2 > 0.6, false) and coalesce(cv_r2 > 0.5, false) then '{AB.GRADE_GOOD}'
  when coalesce(r2 > 0.4, false) then '{AB.GRADE_SATISFACTORY}' else '{AB.GRADE_LOW}' end
  || case when validation_status like '%FAILED%' then '{AB.SUFFIX_FAILED}'
          when validation_status like '%SKIPPED%' then '{AB.SUFFIX_SKIPPED}' else '' end as quality from run)"""


def _run_row(spark, sf_dir):
    sc = view(spark, sf_dir, "scored").select("car_id", F.col("yhat").alias("x"), "y")
    sp = S.split_random(sc, "car_id", 0.2, seed=42)
    fit = MD.ols_fit(sp.where("split = 'train'"), "x", "y")
    test = MD.ols_predict(sp.where("split = 'test'"), fit, "x")
    m = regression_metrics(test, "y", "yhat").select("r2", "mae", "rmse")
    cv = MD.cross_validate_ols(sc, "car_id", "x", "y", 3).agg(F.max("cv_r2_mean").alias("cv_r2"), F.max("cv_r2_std").alias("cv_r2_std"))
    v = _validation(spark, sf_dir).select("validation_status", "improvement_pct", (F.col("n_old") + F.col("n_new")).alias("n_total"))
    one = lambda d: d.select(F.struct("*")).scalar()
    row = spark.range(1).select(one(m).alias("m"), one(cv).alias("c"), one(v).alias("v")).select("m.*", "c.*", "v.*")
    return row.withColumn("quality", AB.quality_grade(F.col("r2"), F.col("cv_r2"), F.col("validation_status")))


@register("quality_grade", with_views(_RUN + """
select round(r2, 6) as r2, round(cv_r2, 6) as cv_r2, validation_status, quality from g""", "scored"))
def q_quality_grade(spark, sf_dir):
    return _run_row(spark, sf_dir).select(R6("r2"), R6("cv_r2"), "validation_status", "quality")


@register("final_summary", with_views(_RUN + """
select quality || ' - R2: ' || coalesce(printf('%.4f', r2), 'N/A') as status, 'run-0001' as run_id,
  round(r2, 6) as r2_score, round(cv_r2, 6) as cv_r2_score, validation_status, quality from g""", "scored"))
def q_final_summary(spark, sf_dir):
    s = AB.final_summary(_run_row(spark, sf_dir), "run-0001")
    return s.select("status", "run_id", R6("r2_score"), R6("cv_r2_score"), "validation_status", "quality")
