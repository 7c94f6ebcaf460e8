"""Catalogue entries: Spark ML models and model jobs.

Forests are not bit-identical to any other library, so these keys have no SQL oracle (rows-only);
the tests hold them to quality floors, repeatability and save / load equality instead.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from autoprice.operators import clean as C
from autoprice.operators import features as FE
from autoprice.operators import forest as FO
from autoprice.operators import linear as LN
from autoprice.operators import models as MD
from autoprice.functions.scalar import uniform_sql
from autoprice.operators.metrics import classification_metrics
from autoprice.operators.split import kfold_stratified, split_random
from autoprice.plans import jobs as J
from autoprice.plans.fixtures import view, with_views
from autoprice.plans.q_clean import _J2_SQL
from autoprice.plans.registry import AS_OF_YEAR, register
from autoprice.session import scratch_dir

def _clean(spark, sf_dir):
    return C.clean_cars_mean(view(spark, sf_dir, "cars_raw"), as_of_year=AS_OF_YEAR)


def _assembled(spark, sf_dir):
    """Numeric features and the label codes of the categorical ones, laid out for training."""
    d = FE.label_encode(_clean(spark, sf_dir), J.PRICE_CATEGORICAL)
    d = FE.assemble_features(d, J.PRICE_NUMERIC + [f"{c}_code" for c in J.PRICE_CATEGORICAL])
    d = MD.training_layout(d.select("car_id", "features", F.col("selling_price").alias("label")), "car_id")
    return split_random(d, "car_id", 0.2, 42)


_U = uniform_sql("cast(car_id as varchar) || '-s-42'")


def _ols3_sql(src: str) -> str:
    """Least squares on three variables by the centred normal equations (Cramer's rule): b1, b2, b3, b0."""
    return f"""(select b1, b2, b3, my - b1 * m1 - b2 * m2 - b3 * m3 as b0 from (select *,
    (c1 * (v22 * v33 - v23 * v23) - v12 * (c2 * v33 - v23 * c3) + v13 * (c2 * v23 - v22 * c3)) / det as b1,
    (v11 * (c2 * v33 - v23 * c3) - c1 * (v12 * v33 - v23 * v13) + v13 * (v12 * c3 - c2 * v13)) / det as b2,
    (v11 * (v22 * c3 - c2 * v23) - v12 * (v12 * c3 - c2 * v13) + c1 * (v12 * v23 - v22 * v13)) / det as b3
  from (select *, v11 * (v22 * v33 - v23 * v23) - v12 * (v12 * v33 - v23 * v13) + v13 * (v12 * v23 - v22 * v13) as det
  from (select avg(x1) as m1, avg(x2) as m2, avg(x3) as m3, avg(y) as my, var_pop(x1) as v11, var_pop(x2) as v22, var_pop(x3) as v33,
    covar_pop(x1, x2) as v12, covar_pop(x1, x3) as v13, covar_pop(x2, x3) as v23,
    covar_pop(x1, y) as c1, covar_pop(x2, y) as c2, covar_pop(x3, y) as c3 from {src}))))"""


@register("rf_regressor")
def q_rf_regressor(spark, sf_dir):
    sp = _assembled(spark, sf_dir)
    model = MD.rf_regressor("features", "label", 50, 8).fit(sp.where("split = 'train'"))
    return model.transform(sp.where("split = 'test'")).select("car_id", "label", "prediction")


@register("linear_regression", with_views(f"""
, j2 as ({_J2_SQL}),
sp as (select car_id, cast(year as double) as x1, present_price as x2, cast(kms_driven as double) as x3, selling_price as y,
  {_U} < 0.2 as test from j2),
fit as {_ols3_sql("(select * from sp where not test)")}
select car_id, y as label, round(b0 + b1 * x1 + b2 * x2 + b3 * x3, 4) as prediction from sp, fit where test""", "cars_raw"))
def q_linear_regression(spark, sf_dir):
    d = FE.assemble_features(_clean(spark, sf_dir), ["year", "present_price", "kms_driven"])
    sp = split_random(d.select("car_id", "features", F.col("selling_price").alias("label")), "car_id", 0.2, 42)
    model = MD.linear_regression("features", "label").fit(sp.where("split = 'train'"))
    return model.transform(sp.where("split = 'test'")).select("car_id", "label", F.round("prediction", 4).alias("prediction"))


_LINEAR = ["year", "present_price", "kms_driven"]
_KNOWN3 = """, d as (select car_id, cast(year as double) as x1, present_price as x2, cast(kms_driven as double) as x3, selling_price as y
  from cars_raw where year is not null and present_price is not null and kms_driven is not null and selling_price is not null)"""


@register("linear_fit", with_views(_KNOWN3 + f"""
, fit as {_ols3_sql("d")}
select unnest(['intercept', 'year', 'present_price', 'kms_driven']) as term, unnest([round(b0, 4), round(b1, 6), round(b2, 6), round(b3, 8)]) as weight
from fit""", "cars_raw"))
def q_linear_fit(spark, sf_dir):
    m = LN.fit_linear(view(spark, sf_dir, "cars_raw"), _LINEAR, "selling_price")
    digits = [4, 6, 6, 8]
    return spark.createDataFrame([(t, round(w, d)) for t, w, d in zip(["intercept", *_LINEAR], [m.intercept, *m.coefficients], digits)],
                                 "term string, weight double")


_FOLDS = 5
_CV_LINEAR = _KNOWN3 + f"""
, r as (select *, row_number() over (order by car_id) - 1 as i, count(*) over () as n from d),
f as (select *, case when i < (n % {_FOLDS}) * (n // {_FOLDS} + 1) then i // (n // {_FOLDS} + 1)
             else n % {_FOLDS} + (i - (n % {_FOLDS}) * (n // {_FOLDS} + 1)) // (n // {_FOLDS}) end as fold from r),
fits as ({" union all ".join(f"select {k} as fold, * from {_ols3_sql(f'(select * from f where fold <> {k})')}" for k in range(_FOLDS))}),
e as (select f.fold, y, b0 + b1 * x1 + b2 * x2 + b3 * x3 - y as e from f join fits on f.fold = fits.fold),
per as (select fold, count(*) as n, sqrt(avg(e * e)) as rmse, 1 - avg(e * e) / var_pop(y) as r2 from e group by fold)"""


@register("cross_validate_linear", with_views(_CV_LINEAR + """
select cast(fold as integer) as fold, n, round(r2, 6) as r2, round(rmse, 6) as rmse, round(avg(r2) over (), 6) as cv_r2_mean,
  round(stddev_pop(r2) over (), 6) as cv_r2_std, round(avg(rmse) over (), 6) as cv_rmse_mean, round(stddev_pop(rmse) over (), 6) as cv_rmse_std
from per""", "cars_raw"))
def q_cross_validate_linear(spark, sf_dir):
    """M4 on three features: five folds, all fits and scores from one scan."""
    cv = LN.cross_validate_linear(view(spark, sf_dir, "cars_raw"), "car_id", _LINEAR, "selling_price", _FOLDS)
    return cv.select("fold", "n", *[F.round(c, 6).alias(c) for c in ("r2", "rmse", "cv_r2_mean", "cv_r2_std", "cv_rmse_mean", "cv_rmse_std")])


@register("time_ab_linear", with_views(_KNOWN3 + f"""
, r as (select *, row_number() over (order by car_id) - 1 as i, count(*) over () as n from d),
p as (select *, greatest(2, cast(trunc(n * 0.6) as bigint)) as sp from r),
seg as (select *, case when i < sp then 0 when i < sp + greatest(1, cast(trunc(greatest(n - sp, 0) * 0.7) as bigint)) then 1 else 2 end as part from p),
fits as (select 'A' as model, * from {_ols3_sql("(select * from seg where part = 0)")}
  union all select 'B', * from {_ols3_sql("(select * from seg where part < 2)")}),
e as (select model, y, b0 + b1 * x1 + b2 * x2 + b3 * x3 - y as e from seg join fits on (model = 'A' and part > 0) or (model = 'B' and part = 2))
select model, case model when 'A' then (select count(*) from seg where part = 0) else (select count(*) from seg where part < 2) end as n_train,
  count(*) as n_test, round(1 - avg(e * e) / var_pop(y), 6) as r2, round(avg(abs(e)), 6) as mae, round(sqrt(avg(e * e)), 6) as rmse
from e group by model""", "cars_raw"))
def q_time_ab_linear(spark, sf_dir):
    ab = LN.time_ab_linear(view(spark, sf_dir, "cars_raw"), "car_id", _LINEAR, "selling_price")
    return ab.select("model", "n_train", "n_test", *[F.round(c, 6).alias(c) for c in ("r2", "mae", "rmse")])


def _url(spark, sf_dir):
    return J.url_features(view(spark, sf_dir, "url_raw"))


# The test side of the URL split: ceil(0.3 n) labelled pages by md5 order.
_URL_TEST = f"""
, lab as (select page_id, case label when 'bad' then 1 else 0 end as y,
  row_number() over (order by {uniform_sql("cast(page_id as varchar) || '-s-42'")}, page_id) as i, count(*) over () as n
  from url_raw where label in ('bad', 'good')),
test as (select * from lab where i <= ceil(n * 0.3))"""


@register("rf_classifier")
def q_rf_classifier(spark, sf_dir):
    train, test = _url(spark, sf_dir)
    model = MD.rf_classifier("features", "label").fit(train)
    return model.transform(test).select("page_id", "label", "prediction")


@register("random_search", with_views(_URL_TEST + """
select unnest(range(24)) as point, true as f1_in_range, (select count(*) from test) as n_test""", "url_raw"))
def q_random_search(spark, sf_dir):
    """All 24 points of the grid are scored, and the best model predicts every test row."""
    train, test = _url(spark, sf_dir)
    cv = MD.random_search(MD.rf_classifier("features", "label"), train, J.URL_GRID, "page_id", draws=30, folds=3, seed=42)
    n_test = cv.bestModel.transform(test).agg(F.count("prediction")).scalar()
    rows = [(i, 0 <= float(m) <= 1) for i, m in enumerate(cv.avgMetrics)]
    return spark.createDataFrame(rows, "point bigint, f1_in_range boolean").withColumn("n_test", n_test)


def _pipeline_model(spark, sf_dir):
    clean = _clean(spark, sf_dir)
    return J.fit_price(split_random(clean, "car_id", 0.2, 42).where("split = 'train'")), clean


@register("batch_predict", with_views(f", j2 as ({_J2_SQL})\nselect car_id, selling_price, true as predicted from j2", "cars_raw"))
def q_batch_predict(spark, sf_dir):
    """Every row of the table gets a prediction within the range of the prices trained on (1 to 10)."""
    model, clean = _pipeline_model(spark, sf_dir)
    return MD.batch_predict(model, clean).select("car_id", "selling_price", F.col("prediction").between(1, 10).alias("predicted"))


@register("model_save_load", with_views(f", j2 as ({_J2_SQL})\nselect car_id, true as equal from j2", "cars_raw"))
def q_model_save_load(spark, sf_dir):
    model, clean = _pipeline_model(spark, sf_dir)
    path = MD.save_model(model, scratch_dir(spark, "model") + "/price_model")
    reloaded = MD.load_model(path)
    a = model.transform(clean).select("car_id", "prediction")
    b = reloaded.transform(clean).select("car_id", F.col("prediction").alias("reloaded_prediction"))
    # same rows keyed by the unique car id: an equi-join on the key
    return a.join(b, "car_id").select("car_id", (F.col("prediction") == F.col("reloaded_prediction")).alias("equal"))


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    sp = _assembled(spark, sf_dir)
    train = sp.where("split = 'train'")
    model = MD.rf_regressor("features", "label", 50, 8).fit(train)
    return FE.feature_importance(spark, model, FE.assembled_names(train), 10)


@register("train_price")
def q_train_price(spark, sf_dir):
    _model, metrics, _scored = J.train_price(_clean(spark, sf_dir))
    return metrics


@register("train_validate_price")
def q_train_validate_price(spark, sf_dir):
    summary, _imp, _ab = J.train_validate_price(_clean(spark, sf_dir), spark)
    return summary


@register("ab_test_url")
def q_ab_test_url(spark, sf_dir):
    decision, _comp, _metrics = J.ab_test_url(view(spark, sf_dir, "url_raw"), spark, draws=50)
    return decision


@register("train_linear_baseline", with_views(f"""
, d as (select car_id, cast(year as double) as x1, present_price as x2, cast(kms_driven as double) as x3, selling_price as y,
  {_U} < 0.2 as test from cars_raw
  where year is not null and present_price is not null and kms_driven is not null and selling_price is not null),
fit as {_ols3_sql("(select * from d where not test)")},
e as (select b0 + b1 * x1 + b2 * x2 + b3 * x3 - y as e from d, fit where test)
select count(*) as n, round(sqrt(avg(e * e)), 6) as rmse from e""", "cars_raw"))
def q_train_linear_baseline(spark, sf_dir):
    _model, rmse = J.train_linear_baseline(view(spark, sf_dir, "cars_raw"))
    return rmse.select("n", F.round("rmse", 6).alias("rmse"))


@register("train_url", with_views(_URL_TEST + """
select cast(sum(y) as bigint) as positives, count(*) as n_test, true as in_range from test""", "url_raw"))
def q_train_url(spark, sf_dir):
    """J7 first half: O3 -> P8 -> O5 -> E4 -> M3 -> Q2/Q3, held to the totals of the test side."""
    train, test = _url(spark, sf_dir)
    model = MD.rf_classifier("features", "label").fit(train)
    scored = model.transform(test).select(F.col("label").cast("int").alias("y"), F.col("prediction").cast("int").alias("yhat"))
    m = classification_metrics(scored, "y", "yhat")
    ok = F.col("precision").between(0, 1) & F.col("recall").between(0, 1) & F.col("f1").between(0, 1)
    return m.select((F.col("tp") + F.col("fn")).alias("positives"),
                    (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n_test"), ok.alias("in_range"))


# ------------------------------------------------------------------ full rows of what is checked by facts above

@register("batch_predict_rows")
def q_batch_predict_rows(spark, sf_dir):
    """M6: every row with its prediction."""
    model, clean = _pipeline_model(spark, sf_dir)
    return MD.batch_predict(model, clean).select("car_id", "selling_price", "prediction")


@register("train_url_rows")
def q_train_url_rows(spark, sf_dir):
    """J7 first half: the confusion counts and metrics of the test side."""
    train, test = _url(spark, sf_dir)
    scored = MD.rf_classifier("features", "label").fit(train).transform(test)
    return classification_metrics(scored.select(F.col("label").cast("int").alias("y"), F.col("prediction").cast("int").alias("yhat")), "y", "yhat")


# ------------------------------------------------------------------ trees with a minimum of samples per split

_TREE = ["year", "owner", "automatic"]
_TREE_ROWS = """, d as (select car_id, cast(year as double) as x0, cast(owner as double) as x1, case transmission when 'Automatic' then 1e0 else 0e0 end as x2,
  selling_price as y from cars_raw where year is not null and selling_price is not null)"""


def _tree_split_sql(name: str, src: str) -> str:
    """The best squared-error split of each node (column ``node``) of ``src``: feature, midpoint threshold, smallest first on ties."""
    return f"""{name}_v as (select node, f, v, count(*) as n, sum(y) as s from (
    select node, unnest([0, 1, 2]) as f, unnest([x0, x1, x2]) as v, y from {src}) group by all),
{name}_c as (select *, sum(n) over w as nl, sum(s) over w as sl, sum(n) over p as na, sum(s) over p as sa, lead(v) over (partition by node, f order by v) as nv
  from {name}_v window w as (partition by node, f order by v), p as (partition by node, f)),
{name} as (select node, min_by(f, (-round(sl * sl / nl + (sa - sl) * (sa - sl) / (na - nl), 3), f, v)) as f,
  min_by((v + nv) / 2, (-round(sl * sl / nl + (sa - sl) * (sa - sl) / (na - nl), 3), f, v)) as t from {name}_c where nv is not null group by node)"""


def _tree_df(spark, sf_dir):
    d = view(spark, sf_dir, "cars_raw").where("year is not null and selling_price is not null")
    x = F.array(F.col("year").cast("double"), F.col("owner").cast("double"), F.when(F.col("transmission") == "Automatic", 1.0).otherwise(0.0))
    return d.select("car_id", x.alias("features"), F.col("selling_price").alias("label"))


@register("tree_regressor", with_views(_TREE_ROWS + f"""
, s0 as (select *, 1 as node, count(*) over () as n from d), {_tree_split_sql("b0", "s0")},
s1 as (select s0.* exclude (node, n), 2 + cast((case f when 0 then x0 when 1 then x1 else x2 end) > t as integer) as node from s0, b0),
z1 as (select *, count(*) over (partition by node) as nn from s1),
m1 as (select max(nn) as limit_rows from z1), {_tree_split_sql("b1", "(select * from z1, m1 where nn >= limit_rows)")},
s2 as (select z1.*, case when b1.f is null then z1.node
    else z1.node * 2 + cast((case b1.f when 0 then x0 when 1 then x1 else x2 end) > b1.t as integer) end as leaf from z1 left join b1 on z1.node = b1.node)
select car_id, y as label, round(avg(y) over (partition by leaf), 6) as prediction from s2""", "cars_raw"))
def q_tree_regressor(spark, sf_dir):
    """M1, one tree of two levels over all rows, without draws: ``min_split`` is set so that only the larger child of the root may
    be split again."""
    d = _tree_df(spark, sf_dir)
    root = FO.fit_forest(d, "car_id", trees=1, depth=1, bootstrap=False).trees[0]
    tree = FO.fit_forest(d, "car_id", trees=1, depth=2, min_split=max(root.rows[1:]), bootstrap=False)
    return tree.transform(d).select("car_id", "label", F.round("prediction", 6).alias("prediction"))


def _arrays(df):
    from pyspark.ml.functions import vector_to_array
    return df.withColumn("features", vector_to_array("features"))


@register("forest_regressor")
def q_forest_regressor(spark, sf_dir):
    """M1: 50 trees of depth 8 with at least four rows to split, on the numeric and encoded car features; test predictions."""
    sp = _arrays(_assembled(spark, sf_dir))
    model = FO.fit_forest(sp.where("split = 'train'"), "car_id", trees=50, depth=8, min_split=4)
    return model.transform(sp.where("split = 'test'")).select("car_id", "label", "prediction")


@register("forest_classifier")
def q_forest_classifier(spark, sf_dir):
    """M3: 35 trees of depth 9 on character counts; test predictions."""
    train, test = (_arrays(d) for d in _url(spark, sf_dir))
    model = FO.fit_forest(train, "page_id", classes=2, trees=35, depth=9, max_features="sqrt")
    return model.transform(test).select("page_id", "label", "prediction")


@register("random_search_full")
def q_random_search_full(spark, sf_dir):
    """M5: all 48 points of the grid with their mean F1 over three class-balanced folds, the best of them marked."""
    train, _ = _url(spark, sf_dir)
    train = _arrays(kfold_stratified(train, "page_id", "label", 3, 42))
    _, table = FO.search(train, "page_id", J.URL_GRID_FULL, folds=3, draws_=50)
    return table
