"""Catalogue entries: ordering, sampling, splits, folds."""

from __future__ import annotations

from autoprice.functions.scalar import uniform_sql
from autoprice.operators import split as S
from autoprice.plans.fixtures import view, with_views
from autoprice.plans.registry import register


def _u(key: str, salt: str, seed: int) -> str:
    return uniform_sql(f"cast({key} as varchar) || '-{salt}-{seed}'")


@register("top_k", with_views(
    "select car_id, selling_price from cars_raw order by selling_price desc nulls last, car_id limit 10", "cars_raw"))
def q_top_k(spark, sf_dir):
    return S.top_k(view(spark, sf_dir, "cars_raw").select("car_id", "selling_price"), "selling_price", 10, "car_id")


@register("head_rows", with_views("select car_id, car_name, year from cars_raw order by car_id limit 5", "cars_raw"))
def q_head_rows(spark, sf_dir):
    return S.head_rows(view(spark, sf_dir, "cars_raw").select("car_id", "car_name", "year"), "car_id", 5)


@register("sample_fraction", with_views(f"""
, r as (select page_id, url, label, row_number() over (order by {_u('page_id', 's', 42)}, page_id) - 1 as i,
               count(*) over () as n from url_raw)
select page_id, url, label from r where i < round_even(n * 0.3, 0)""", "url_raw"))
def q_sample_fraction(spark, sf_dir):
    return S.sample_fraction(view(spark, sf_dir, "url_raw"), "page_id", 0.3, seed=42, exact=True)


@register("sample_fraction_bernoulli", with_views(
    f"select page_id, url, label from url_raw where {_u('page_id', 's', 42)} < 0.3", "url_raw"))
def q_sample_fraction_bernoulli(spark, sf_dir):
    return S.sample_fraction(view(spark, sf_dir, "url_raw"), "page_id", 0.3, seed=42)


@register("sample_rows", with_views(
    f"select car_id, car_name from cars_raw order by {_u('car_id', 's', 42)}, car_id limit 5", "cars_raw"))
def q_sample_rows(spark, sf_dir):
    return S.sample_rows(view(spark, sf_dir, "cars_raw").select("car_id", "car_name"), "car_id", 5, seed=42)


@register("split_random", with_views(
    f"select car_id, case when {_u('car_id', 's', 42)} < 0.2 then 'test' else 'train' end as split from cars_raw",
    "cars_raw"))
def q_split_random(spark, sf_dir):
    return S.split_random(view(spark, sf_dir, "cars_raw").select("car_id"), "car_id", 0.2, seed=42)


@register("split_random_exact", with_views(f"""
, r as (select car_id, row_number() over (order by {_u('car_id', 's', 42)}, car_id) - 1 as i,
               count(*) over () as n from cars_raw)
select car_id, case when i < ceil(n * 0.2) then 'test' else 'train' end as split from r""", "cars_raw"))
def q_split_random_exact(spark, sf_dir):
    return S.split_random(view(spark, sf_dir, "cars_raw").select("car_id"), "car_id", 0.2, seed=42, exact=True)


@register("split_small_guarded", with_views(f"""
, r as (select car_id, row_number() over (order by {_u('car_id', 's', 42)}, car_id) - 1 as i,
               count(*) over () as n from cars_raw)
select car_id, case when i < ceil(n * least(0.2, 2.0 / n)) then 'test' else 'train' end as split from r""",
    "cars_raw"))
def q_split_small_guarded(spark, sf_dir):
    return S.split_small_guarded(view(spark, sf_dir, "cars_raw").select("car_id"), "car_id", seed=42)


@register("subsample_train", with_views(f"""
, s as (select car_id, case when {_u('car_id', 's', 42)} < 0.2 then 'test' else 'train' end as split from cars_raw)
select car_id, split from s where split <> 'train' or {_u('car_id', 'sub', 7)} < 0.5""", "cars_raw"))
def q_subsample_train(spark, sf_dir):
    d = S.split_random(view(spark, sf_dir, "cars_raw").select("car_id"), "car_id", 0.2, seed=42)
    return S.subsample_train(d, "car_id", keep_frac=0.5, seed=7)


_O8 = """
, r as (select car_id, row_number() over (order by car_id) - 1 as i, count(*) over () as n from cars_raw),
p as (select *, greatest(2, cast(trunc(n * 0.6) as bigint)) as sp from r),
q as (select *, greatest(1, cast(trunc(greatest(n - sp, 0) * 0.7) as bigint)) as ts from p),
seg as (select car_id, case when i < sp then 'old' when i < sp + ts then 'new_train' else 'new_test' end as segment from q)"""


@register("split_time_ordered", with_views(_O8 + "\nselect car_id, segment from seg", "cars_raw"))
def q_split_time_ordered(spark, sf_dir):
    return S.split_time_ordered(view(spark, sf_dir, "cars_raw").select("car_id"), "car_id")


@register("union_rows", with_views(_O8 + """
select car_id, segment from seg where segment = 'old'
union all select car_id, segment from seg where segment = 'new_train'""", "cars_raw"))
def q_union_rows(spark, sf_dir):
    seg = S.split_time_ordered(view(spark, sf_dir, "cars_raw").select("car_id"), "car_id")
    return S.union_rows(seg.where("segment = 'old'"), seg.where("segment = 'new_train'"))


@register("kfold_assign", with_views("""
, r as (select car_id, row_number() over (order by car_id) - 1 as i, count(*) over () as n from cars_raw),
p as (select car_id, i, n // 5 as q, n % 5 as rr from r)
select car_id, cast(case when i < rr * (q + 1) then floor(i / (q + 1))
                         else rr + floor((i - rr * (q + 1)) / q) end as integer) as fold from p""", "cars_raw"))
def q_kfold_assign(spark, sf_dir):
    return S.kfold_assign(view(spark, sf_dir, "cars_raw").select("car_id"), "car_id", k=5)


@register("kfold_stratified", with_views(f"""
select page_id, label, cast((row_number() over (partition by label order by {_u('page_id', 'cv', 42)}, page_id) - 1) % 3
       as integer) as fold from url_raw""", "url_raw"))
def q_kfold_stratified(spark, sf_dir):
    return S.kfold_stratified(view(spark, sf_dir, "url_raw").select("page_id", "label"), "page_id", "label", k=3)
