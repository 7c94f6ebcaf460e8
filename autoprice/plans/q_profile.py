"""Catalogue entries: row counts and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from autoprice.operators import clean as C
from autoprice.operators import profile as PR
from autoprice.plans.fixtures import view, with_views
from autoprice.plans.q_clean import _J2_SQL, TX_COLS, Y
from autoprice.plans.registry import register

R6 = lambda c: F.round(c, 6)

_IN_RANGE = "selling_price > 1 and selling_price < 10 and kms_driven > 0 and kms_driven < 1000000"


@register("row_counts", with_views(f"""
, j2 as ({_J2_SQL}),
c as (select 0 as step_no, 'raw' as step, count(*) as row_count from cars_raw
  union all select 1, 'not_null_target', count(*) from cars_raw where selling_price is not null
  union all select 2, 'in_range', count(*) from cars_raw where selling_price is not null and {_IN_RANGE}
  union all select 3, 'valid_year', count(*) from j2)
select step_no, step, row_count, coalesce(lag(row_count) over (order by step_no) - row_count, 0) as removed from c""",
    "cars_raw"))
def q_row_counts(spark, sf_dir):
    raw = view(spark, sf_dir, "cars_raw")
    price, kms = F.col("selling_price"), F.col("kms_driven")
    in_range = (price > 1.0) & (price < 10.0) & (kms > 0) & (kms < 1_000_000)
    out = PR.filter_chain_counts(raw, [("not_null_target", price.isNotNull()), ("in_range", in_range)],
                                 [("valid_year", C.clean_cars_mean(raw, as_of_year=Y))])
    # the first step is the raw input
    return out.withColumn("step", F.when(F.col("step_no") == 0, F.lit("raw")).otherwise(F.col("step")))


def _union(parts: list[str]) -> str:
    return "\nunion all ".join(parts)


_TX = [c.strip() for c in TX_COLS.split(",")]


@register("null_profile", with_views(f"""
, d as (select distinct {TX_COLS} from tx_raw),
p as ({_union([f"select '{c}' as column_name, cast(count_if({c} is null) as bigint) as null_count, "
               f"(select count(*) from d) as n from d" for c in _TX])})
select column_name, null_count, round(null_count * 100.0 / n, 6) as null_pct from p where null_count > 0""", "tx_raw"))
def q_null_profile(spark, sf_dir):
    d = C.dedupe_rows(view(spark, sf_dir, "tx_raw"))
    return PR.null_profile(d).withColumn("null_pct", R6(F.col("null_pct")))


@register("zero_profile", with_views(f"""
, d as (select distinct {TX_COLS} from tx_raw)
{_union([f"select '{c}' as column_name, cast(count_if(try_cast({c} as bigint) = 0) as bigint) as zero_count from d"
         for c in ["terminal_id", "customer_id"]])}""", "tx_raw"))
def q_zero_profile(spark, sf_dir):
    return PR.zero_profile(C.dedupe_rows(view(spark, sf_dir, "tx_raw")))


_NUM = ["year", "selling_price", "present_price", "kms_driven", "owner"]


@register("describe_numeric", with_views(f"""
, l as ({_union([f"select '{c}' as column_name, cast({c} as double) as v from cars_raw" for c in _NUM])})
select column_name, count(v) as count, round(avg(v), 6) as mean, round(stddev_samp(v), 6) as std, min(v) as min,
  round(quantile_cont(v, 0.25), 6) as q25, round(quantile_cont(v, 0.5), 6) as q50,
  round(quantile_cont(v, 0.75), 6) as q75, max(v) as max
from l group by column_name""", "cars_raw"))
def q_describe_numeric(spark, sf_dir):
    d = PR.describe_numeric(view(spark, sf_dir, "cars_raw"), _NUM)
    return d.select("column_name", "count", R6(F.col("mean")).alias("mean"), R6(F.col("std")).alias("std"), "min",
                    *[R6(F.col(c)).alias(c) for c in ["q25", "q50", "q75"]], "max")


@register("target_stats", with_views(
    "select min(selling_price) as target_min, max(selling_price) as target_max, "
    "round(avg(selling_price), 6) as target_mean from cars_raw", "cars_raw"))
def q_target_stats(spark, sf_dir):
    d = PR.target_stats(view(spark, sf_dir, "cars_raw"))
    return d.select("target_min", "target_max", R6(F.col("target_mean")).alias("target_mean"))


@register("group_median", with_views(
    "select country, round(median(average_temperature), 6) as median_temperature from temps "
    "where country is not null group by country", "temps"))
def q_group_median(spark, sf_dir):
    d = PR.group_median(view(spark, sf_dir, "temps"), "country", "average_temperature", "median_temperature")
    return d.select("country", R6(F.col("median_temperature")).alias("median_temperature"))


@register("value_counts_top", with_views(
    "select fuel_type, count(*) as cnt from cars_raw where fuel_type is not null group by fuel_type "
    "order by cnt desc, fuel_type limit 1", "cars_raw"))
def q_value_counts_top(spark, sf_dir):
    return PR.value_counts_top(view(spark, sf_dir, "cars_raw"), "fuel_type", 1)


_TYPES = {"car_id": "bigint", "car_name": "string", "year": "bigint", "selling_price": "double",
          "present_price": "double", "kms_driven": "bigint", "fuel_type": "string", "seller_type": "string",
          "transmission": "string", "owner": "bigint"}


@register("schema_profile", with_views(
    _union([f"select '{c}' as column_name, '{t}' as data_type, count({c}) as non_null, count(*) as row_count "
            "from cars_raw" for c, t in _TYPES.items()]), "cars_raw"))
def q_schema_profile(spark, sf_dir):
    return PR.schema_profile(view(spark, sf_dir, "cars_raw"))


@register("key_null_check", with_views(f"""
, j2 as ({_J2_SQL})
{_union([f"select '{c}' as column_name, cast(count_if({c} is null) as bigint) as missing, "
         f"case when count_if({c} is null) = 0 then 'OK' else 'WARN' end as status from j2"
         for c in ["selling_price", "year", "kms_driven", "fuel_type"]])}""", "cars_raw"))
def q_key_null_check(spark, sf_dir):
    return PR.key_null_check(C.clean_cars_mean(view(spark, sf_dir, "cars_raw"), as_of_year=Y))


# ------------------------------------------------------------------ mergeable summaries

@register("group_median_sketch", with_views(
    "select country, count(average_temperature) as n, round(median(average_temperature), 6) as exact_median, true as within_bound from temps "
    "where country is not null group by country having count(average_temperature) > 0", "temps"))
def q_group_median_sketch(spark, sf_dir):
    """A6 by sketches: per country the exact median, and that of the merged sketches of 16 parts of the rows held to its error."""
    from autoprice.operators import sketch as SK
    d = view(spark, sf_dir, "temps").where("country is not null")
    parts = SK.sketch(d.withColumn("part", F.pmod(F.xxhash64("dt", "average_temperature"), F.lit(16))), "average_temperature", ["country", "part"])
    merged = SK.merge(parts, ["country"])
    got = SK.sketch_quantiles(merged, [0.5], ["m"], ["country"]).join(merged.groupBy("country").agg(F.sum("n").alias("n")), "country")
    both = got.join(PR.group_median(d, "country", "average_temperature", "exact"), "country")
    close = F.abs(F.col("m") - F.col("exact")) <= SK.ALPHA * F.abs(F.col("exact")) + 1e-9
    return both.select("country", "n", F.round("exact", 6).alias("exact_median"), close.alias("within_bound"))


_TOP = [("car_name", "cars_raw", 3), ("kms_driven", "cars_raw", 3), ("year", "cars_raw", 3), ("source", "pred_log", 5), ("terminal_id", "tx_raw", 5)]


@register("top_values_heavy", with_views("\n" + " union all ".join(
    f"(select '{c}' as column_name, cast({c} as varchar) as value, count(*) as cnt from {v} where {c} is not null group by {c} order by cnt desc, {c} limit {k})"
    for c, v, k in _TOP), "cars_raw", "pred_log", "tx_raw"))
def q_top_values_heavy(spark, sf_dir):
    """A7 / D5 by Misra-Gries candidates and an exact recount: the most frequent values of few-valued, many-valued and flat columns."""
    from autoprice.operators import sketch as SK
    out = None
    for c, v, k in _TOP:
        t = SK.top_values(view(spark, sf_dir, v), c, k).select(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), "cnt")
        out = t if out is None else out.unionByName(t)
    return out
