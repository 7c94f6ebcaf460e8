"""Catalogue entries: feature encoders."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from autoprice.operators import clean as C
from autoprice.operators import features as FE
from autoprice.plans.fixtures import view, with_views
from autoprice.plans.q_clean import _J2_SQL, Y
from autoprice.plans.registry import register

_CAT = ["car_name", "fuel_type", "seller_type", "transmission"]


@register("label_encode", with_views(f"""
, j2 as ({_J2_SQL})
select car_id, {", ".join(f"cast(dense_rank() over (order by {c}) - 1 as integer) as {c}_code" for c in _CAT)} from j2""",
    "cars_raw"))
def q_label_encode(spark, sf_dir):
    d = C.clean_cars_mean(view(spark, sf_dir, "cars_raw"), as_of_year=Y).select("car_id", *_CAT)
    return FE.label_encode(d, _CAT).select("car_id", *[f"{c}_code" for c in _CAT])


_OHE = {"fuel_type": ["CNG", "Diesel", "Petrol"], "transmission": ["Automatic", "Manual"]}


@register("one_hot", with_views("select car_id, " + ", ".join(
    f"cast(case when {c} = '{v}' then 1 else 0 end as integer) as {c}_{v}" for c, vs in _OHE.items() for v in vs)
    + " from cars_raw", "cars_raw"))
def q_one_hot(spark, sf_dir):
    d = view(spark, sf_dir, "cars_raw").select("car_id", *_OHE)
    return FE.one_hot(d, list(_OHE)).drop(*_OHE)


_SC = ["year", "present_price", "kms_driven"]


@register("standard_scale", with_views("select car_id, " + ", ".join(
    f"round((cast({c} as double) - avg({c}) over ()) / coalesce(nullif(stddev_pop({c}) over (), 0), 1), 6) as {c}_z"
    for c in _SC) + " from cars_raw", "cars_raw"))
def q_standard_scale(spark, sf_dir):
    d = FE.standard_scale(view(spark, sf_dir, "cars_raw").select("car_id", *_SC), _SC)
    return d.select("car_id", *[F.round(F.col(f"{c}_z"), 6).alias(f"{c}_z") for c in _SC])


@register("char_count_vector", with_views("""
, ch as (select page_id, unnest(string_split(lower(url), '')) as ch from url_raw)
select page_id, ch, count(*) as cnt from ch where ch <> '' group by page_id, ch""", "url_raw"))
def q_char_counts(spark, sf_dir):
    return FE.char_counts_long(view(spark, sf_dir, "url_raw"), "page_id", "url")


_ASM = ["year", "present_price", "kms_driven", "owner", "car_age", "kms_per_year"]


@register("assemble_features", with_views(f"""
, j2 as ({_J2_SQL})
select car_id, list_transform([{", ".join(f"cast({c} as double)" for c in _ASM)}], lambda x: round(x, 6)) as features
from j2""", "cars_raw"))
def q_assemble(spark, sf_dir):
    d = C.clean_cars_mean(view(spark, sf_dir, "cars_raw"), as_of_year=Y)
    a = FE.assemble_features(d, _ASM)
    return a.select("car_id", F.transform(vector_to_array("features"), lambda x: F.round(x, 6)).alias("features"))
