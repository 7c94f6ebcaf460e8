"""Catalogue entries: projections, filters, de-duplication, imputation, cleaning jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from autoprice.operators import clean as C
from autoprice.plans.fixtures import view, with_views
from autoprice.sources.readers import TX_COLUMNS
from autoprice.plans.registry import AS_OF_YEAR, register

Y = AS_OF_YEAR
CAR_COLS = "car_id, car_name, year, selling_price, present_price, kms_driven, fuel_type, seller_type, transmission, owner"


def _r6(c):
    return F.round(c, 6)


# ------------------------------------------------------------------ J2 (flagship) and J1

_J2_SQL = with_views(f"""
, f as (select * from cars_raw where selling_price is not null
        and selling_price > 1 and selling_price < 10 and kms_driven > 0 and kms_driven < 1000000),
st as (select coalesce(avg(year), 0) as m_year, coalesce(avg(kms_driven), 0) as m_kms,
              coalesce(avg(present_price), 0) as m_pp from f),
mf as (select fuel_type as v from f where fuel_type is not null group by 1 order by count(*) desc, 1 limit 1),
ms as (select seller_type as v from f where seller_type is not null group by 1 order by count(*) desc, 1 limit 1),
mt as (select transmission as v from f where transmission is not null group by 1 order by count(*) desc, 1 limit 1),
mo as (select owner as v from f where owner is not null group by 1 order by count(*) desc, 1 limit 1),
i as (select car_id, car_name,
        coalesce(cast(year as double), (select m_year from st)) as year, selling_price,
        coalesce(present_price, (select m_pp from st)) as present_price,
        coalesce(cast(kms_driven as double), (select m_kms from st)) as kms_driven,
        coalesce(fuel_type, (select v from mf), 'unknown') as fuel_type,
        coalesce(seller_type, (select v from ms), 'unknown') as seller_type,
        coalesce(transmission, (select v from mt), 'unknown') as transmission,
        coalesce(owner, (select v from mo)) as owner
      from f)
select car_id, car_name, cast(trunc(year) as integer) as year, selling_price, present_price,
  cast(trunc(kms_driven) as integer) as kms_driven, fuel_type, seller_type, transmission, owner,
  cast(trunc({Y} - year) as integer) as car_age,
  round(case when {Y} - year > 0 then kms_driven / ({Y} - year) else kms_driven end, 6) as kms_per_year
from i where year > 1950 and year <= {Y}
""", "cars_raw")


@register("clean_cars_mean", _J2_SQL)
def q_clean_cars_mean(spark, sf_dir):
    df = C.clean_cars_mean(view(spark, sf_dir, "cars_raw"), as_of_year=Y)
    return df.withColumn("kms_per_year", _r6(F.col("kms_per_year")))


_J1_SQL = with_views(f"""
, f as (select * from cars_raw where selling_price is not null
        and selling_price > 1 and selling_price < 10 and kms_driven > 0 and kms_driven < 1000000),
st as (select median(year) as med_year, median(kms_driven) as med_kms from f),
mf as (select fuel_type as v from f where fuel_type is not null group by 1 order by count(*) desc, 1 limit 1),
ms as (select seller_type as v from f where seller_type is not null group by 1 order by count(*) desc, 1 limit 1),
mt as (select transmission as v from f where transmission is not null group by 1 order by count(*) desc, 1 limit 1),
mo as (select owner as v from f where owner is not null group by 1 order by count(*) desc, 1 limit 1),
i as (select car_id, car_name,
        coalesce(cast(year as double), (select med_year from st)) as year, selling_price, present_price,
        coalesce(cast(kms_driven as double), (select med_kms from st)) as kms_driven,
        coalesce(fuel_type, (select v from mf), 'unknown') as fuel_type,
        coalesce(seller_type, (select v from ms), 'unknown') as seller_type,
        coalesce(transmission, (select v from mt), 'unknown') as transmission,
        coalesce(owner, (select v from mo)) as owner
      from f)
select car_id, car_name, cast(trunc(year) as integer) as year, selling_price, present_price,
  cast(trunc(kms_driven) as integer) as kms_driven, fuel_type, seller_type, transmission, owner,
  round({Y} - year, 6) as car_age,
  round(kms_driven / ({Y} - year + 1), 6) as kms_per_year
from i where year > 1950 and year <= {Y}
""", "cars_raw")


@register("clean_cars_median", _J1_SQL)
def q_clean_cars_median(spark, sf_dir):
    df = C.clean_cars_median(view(spark, sf_dir, "cars_raw"), as_of_year=Y)
    return (df.withColumn("car_age", _r6(F.col("car_age")))
              .withColumn("kms_per_year", _r6(F.col("kms_per_year"))))


# ------------------------------------------------------------------ projections

@register("car_age", with_views(f"select car_id, year, {Y} - year as car_age from cars_raw", "cars_raw"))
def q_car_age(spark, sf_dir):
    return view(spark, sf_dir, "cars_raw").select("car_id", "year", C.car_age(as_of_year=Y).alias("car_age"))


@register("kms_per_year_plus1", with_views(
    f"select car_id, round(kms_driven / nullif({Y} - year + 1, 0), 6) as kms_per_year from cars_raw", "cars_raw"))
def q_kms_plus1(spark, sf_dir):
    d = view(spark, sf_dir, "cars_raw").withColumn("car_age", C.car_age(as_of_year=Y))
    return d.select("car_id", _r6(C.kms_per_year_plus1()).alias("kms_per_year"))


@register("kms_per_year_guarded", with_views(
    f"select car_id, round(case when {Y} - year > 0 then kms_driven / ({Y} - year) else kms_driven end, 6) as kms_per_year "
    "from cars_raw", "cars_raw"))
def q_kms_guarded(spark, sf_dir):
    d = view(spark, sf_dir, "cars_raw").withColumn("car_age", C.car_age(as_of_year=Y))
    return d.select("car_id", _r6(C.kms_per_year_guarded()).alias("kms_per_year"))


@register("kms_per_year_rounded", with_views(
    f"select car_id, round_even(kms_driven / greatest({Y} - year, 1), 1) as kms_per_year from cars_raw", "cars_raw"))
def q_kms_rounded(spark, sf_dir):
    d = view(spark, sf_dir, "cars_raw").withColumn("car_age", C.car_age(as_of_year=Y))
    return d.select("car_id", C.kms_per_year_rounded().alias("kms_per_year"))


@register("cast_types", with_views(
    "select car_id, cast(year as integer) as year, cast(kms_driven as integer) as kms_driven, "
    "cast(selling_price as double) as selling_price, cast(present_price as double) as present_price from cars_raw",
    "cars_raw"))
def q_cast_types(spark, sf_dir):
    d = view(spark, sf_dir, "cars_raw").select("car_id", "year", "kms_driven", "selling_price", "present_price")
    return C.cast_types(d)


@register("derive_tx_date", with_views(
    "select tranaction_id, tx_datetime, cast(try_cast(tx_datetime as date) as varchar) as tx_date from tx_raw", "tx_raw"))
def q_derive_tx_date(spark, sf_dir):
    # dates leave the catalogue as ISO text so both engines hand over the same representation
    return view(spark, sf_dir, "tx_raw").select("tranaction_id", "tx_datetime",
                                                C.derive_date("tx_datetime").cast("string").alias("tx_date"))


@register("derive_year", with_views(
    "select dt, cast(year(try_strptime(dt, '%Y-%m-%d')) as integer) as year from temps", "temps"))
def q_derive_year(spark, sf_dir):
    return view(spark, sf_dir, "temps").select("dt", C.derive_year("dt").alias("year"))


@register("label_map", with_views(
    "select page_id, url, label, case when label = 'bad' then 1 when label = 'good' then 0 end as label_enc from url_raw",
    "url_raw"))
def q_label_map(spark, sf_dir):
    from autoprice.functions.scalar import label_map
    d = view(spark, sf_dir, "url_raw")
    return d.select("page_id", "url", "label", label_map("label", {"bad": 1, "good": 0}).alias("label_enc"))


@register("select_features", with_views(
    "select car_id, year, present_price, kms_driven, owner, fuel_type, seller_type, transmission, selling_price "
    "from cars_raw", "cars_raw"))
def q_select_features(spark, sf_dir):
    from autoprice.operators.features import select_features
    return select_features(view(spark, sf_dir, "cars_raw"),
                           ["year", "present_price", "kms_driven", "owner", "fuel_type", "seller_type", "transmission"],
                           "selling_price", keep=["car_id"])


@register("drop_columns", with_views(
    "select car_id, year, present_price, kms_driven, fuel_type, seller_type, transmission, owner from cars_raw",
    "cars_raw"))
def q_drop_columns(spark, sf_dir):
    return view(spark, sf_dir, "cars_raw").drop("selling_price", "car_name")


@register("new_columns", with_views(f"""
, j2 as ({_J2_SQL})
select 'car_age' as column_name, count(car_age) as non_null from j2
union all select 'kms_per_year', count(kms_per_year) from j2""", "cars_raw"))
def q_new_columns(spark, sf_dir):
    raw = view(spark, sf_dir, "cars_raw")
    cleaned = C.clean_cars_mean(raw, as_of_year=Y)
    cols = C.new_columns(raw, cleaned)
    agg = cleaned.agg(*[F.count(c).alias(c) for c in cols])
    return agg.unpivot([], cols, "column_name", "non_null")


@register("relative_error_pct", with_views(
    "select car_id, round(abs((yhat - y) / y) * 100, 6) as rel_err_pct from scored", "scored"))
def q_relative_error(spark, sf_dir):
    return view(spark, sf_dir, "scored").select("car_id", _r6(C.relative_error_pct("yhat", "y")).alias("rel_err_pct"))


@register("nest_prediction", with_views(
    "select car_id, to_json({'car_data': {'year': year, 'kms_driven': kms_driven, 'fuel_type': fuel_type, "
    "'transmission': transmission}, 'predicted_price': floor(present_price * 85) / 100}) as value from cars_raw",
    "cars_raw"))
def q_nest_prediction(spark, sf_dir):
    d = view(spark, sf_dir, "cars_raw").withColumn("pred", F.floor(F.col("present_price") * 85) / 100)
    nested = C.nest_prediction(["year", "kms_driven", "fuel_type", "transmission"], "pred")
    return d.select("car_id", F.to_json(nested, {"ignoreNullFields": "false"}).alias("value"))


# ------------------------------------------------------------------ filters

@register("drop_null_target", with_views(f"select {CAR_COLS} from cars_raw where selling_price is not null", "cars_raw"))
def q_drop_null_target(spark, sf_dir):
    return C.drop_null_target(view(spark, sf_dir, "cars_raw"))


@register("drop_any_null", with_views(
    f"select {CAR_COLS} from cars_raw where " + " and ".join(f"{c.strip()} is not null" for c in CAR_COLS.split(",")),
    "cars_raw"))
def q_drop_any_null(spark, sf_dir):
    return C.drop_any_null(view(spark, sf_dir, "cars_raw"))


@register("filter_outliers", with_views(
    f"select {CAR_COLS} from cars_raw where selling_price > 1 and selling_price < 10 "
    "and kms_driven > 0 and kms_driven < 1000000", "cars_raw"))
def q_filter_outliers(spark, sf_dir):
    return C.filter_outliers(view(spark, sf_dir, "cars_raw"))


@register("filter_year", with_views(f"select {CAR_COLS} from cars_raw where year > 1950 and year <= {Y}", "cars_raw"))
def q_filter_year(spark, sf_dir):
    return C.filter_year(view(spark, sf_dir, "cars_raw"), as_of_year=Y)


TX_COLS = ", ".join(TX_COLUMNS)


@register("filter_zero_ids", with_views(
    f"select {TX_COLS} from tx_raw where try_cast(terminal_id as bigint) <> 0 and try_cast(customer_id as bigint) <> 0",
    "tx_raw"))
def q_filter_zero_ids(spark, sf_dir):
    return C.filter_zero_ids(view(spark, sf_dir, "tx_raw"))


# The reference default; the driver's order dates span 1995-2001, so both sides of the bound are populated.
MIN_YEAR = 2000


@register("filter_min_year", with_views(
    f"select dt, country, average_temperature, cast(year(try_strptime(dt, '%Y-%m-%d')) as integer) as year "
    f"from temps where year(try_strptime(dt, '%Y-%m-%d')) >= {MIN_YEAR}", "temps"))
def q_filter_min_year(spark, sf_dir):
    d = view(spark, sf_dir, "temps").withColumn("year", C.derive_year("dt"))
    return C.filter_min_year(d, "year", MIN_YEAR)


# ------------------------------------------------------------------ de-duplication and imputation

@register("dedupe_rows", with_views(f"select distinct {TX_COLS} from tx_raw", "tx_raw"))
def q_dedupe_rows(spark, sf_dir):
    return C.dedupe_rows(view(spark, sf_dir, "tx_raw"))


@register("impute_mean", with_views("""
, st as (select coalesce(avg(year), 0) as m_year, coalesce(avg(kms_driven), 0) as m_kms,
                coalesce(avg(present_price), 0) as m_pp from cars_raw)
select car_id, round(coalesce(cast(year as double), (select m_year from st)), 6) as year,
  round(coalesce(cast(kms_driven as double), (select m_kms from st)), 6) as kms_driven,
  round(coalesce(present_price, (select m_pp from st)), 6) as present_price
from cars_raw""", "cars_raw"))
def q_impute_mean(spark, sf_dir):
    d = view(spark, sf_dir, "cars_raw").select("car_id", "year", "kms_driven", "present_price")
    d = C.impute_mean_mode(d, ["year", "kms_driven", "present_price"], [])
    return d.select("car_id", *[_r6(F.col(c)).alias(c) for c in ["year", "kms_driven", "present_price"]])


@register("impute_median", with_views("""
, st as (select median(year) as m_year, median(kms_driven) as m_kms from cars_raw)
select car_id, round(coalesce(cast(year as double), (select m_year from st)), 6) as year,
  round(coalesce(cast(kms_driven as double), (select m_kms from st)), 6) as kms_driven
from cars_raw""", "cars_raw"))
def q_impute_median(spark, sf_dir):
    d = view(spark, sf_dir, "cars_raw").select("car_id", "year", "kms_driven")
    d = C.impute_median(d, ["year", "kms_driven"])
    return d.select("car_id", _r6(F.col("year")).alias("year"), _r6(F.col("kms_driven")).alias("kms_driven"))


@register("impute_mode", with_views("""
, mf as (select fuel_type as v from cars_raw where fuel_type is not null group by 1 order by count(*) desc, 1 limit 1),
ms as (select seller_type as v from cars_raw where seller_type is not null group by 1 order by count(*) desc, 1 limit 1),
mt as (select transmission as v from cars_raw where transmission is not null group by 1 order by count(*) desc, 1 limit 1),
mo as (select owner as v from cars_raw where owner is not null group by 1 order by count(*) desc, 1 limit 1)
select car_id, coalesce(fuel_type, (select v from mf), 'unknown') as fuel_type,
  coalesce(seller_type, (select v from ms), 'unknown') as seller_type,
  coalesce(transmission, (select v from mt), 'unknown') as transmission,
  coalesce(owner, (select v from mo)) as owner
from cars_raw""", "cars_raw"))
def q_impute_mode(spark, sf_dir):
    d = view(spark, sf_dir, "cars_raw").select("car_id", "fuel_type", "seller_type", "transmission", "owner")
    return C.impute_mode(d, ["fuel_type", "seller_type", "transmission", "owner"])


@register("impute_constant", with_views(
    "select car_id, coalesce(fuel_type, 'missing') as fuel_type, coalesce(seller_type, 'missing') as seller_type, "
    "coalesce(cast(owner as varchar), 'missing') as owner from cars_raw", "cars_raw"))
def q_impute_constant(spark, sf_dir):
    d = view(spark, sf_dir, "cars_raw").select("car_id", "fuel_type", "seller_type", "owner")
    return C.impute_constant(d, ["fuel_type", "seller_type", "owner"])


# ------------------------------------------------------------------ J3, J4

@register("clean_transactions", with_views(f"""
, d as (select distinct {TX_COLS} from tx_raw)
select {TX_COLS}, cast(try_cast(tx_datetime as date) as varchar) as tx_date from d
where try_cast(terminal_id as bigint) <> 0 and try_cast(customer_id as bigint) <> 0""", "tx_raw"))
def q_clean_transactions(spark, sf_dir):
    d = C.clean_transactions(view(spark, sf_dir, "tx_raw"))
    return d.withColumn("tx_date", F.col("tx_date").cast("string"))


@register("temperature_etl", with_views(f"""
, f as (select * from temps where year(try_strptime(dt, '%Y-%m-%d')) >= {MIN_YEAR} and country is not null)
select country, round(median(average_temperature), 6) as median_temperature from f group by country""", "temps"))
def q_temperature_etl(spark, sf_dir):
    d = C.temperature_etl(view(spark, sf_dir, "temps"), MIN_YEAR)
    return d.select("country", _r6(F.col("median_temperature")).alias("median_temperature"))


# ------------------------------------------------------------------ scalar functions

@register("scalar_math", with_views("""
select car_id, abs(kms_driven - 500000) as abs_dev, round(sqrt(abs(kms_driven)), 6) as sqrt_kms,
  greatest(year, 2000) as max_year, least(year, 2000) as min_year, cast(trunc(selling_price) as integer) as int_price,
  round(present_price, 1) as price_r1, round(present_price, 2) as price_r2,
  round(kms_driven / greatest(year - 1990, 1), 6) as ratio from cars_raw""", "cars_raw"))
def q_scalar_math(spark, sf_dir):
    d = view(spark, sf_dir, "cars_raw")
    return d.select("car_id", F.abs(F.col("kms_driven") - 500000).alias("abs_dev"),
                    _r6(F.sqrt(F.abs("kms_driven"))).alias("sqrt_kms"),
                    F.greatest("year", F.lit(2000)).alias("max_year"), F.least("year", F.lit(2000)).alias("min_year"),
                    F.col("selling_price").cast("int").alias("int_price"),
                    F.round("present_price", 1).alias("price_r1"), F.round("present_price", 2).alias("price_r2"),
                    _r6(F.try_divide(F.col("kms_driven"), F.greatest(F.col("year") - 1990, F.lit(1)))).alias("ratio"))


@register("scalar_date", with_views("""
select dt, cast(cast(try_strptime(dt, '%Y-%m-%d') as date) as varchar) as d, cast(year(try_strptime(dt, '%Y-%m-%d')) as integer) as y,
  strftime(try_strptime(dt, '%Y-%m-%d'), '%Y-%m') as ym, cast(year(current_date) as integer) as current_year
from temps""", "temps"))
def q_scalar_date(spark, sf_dir):
    d = view(spark, sf_dir, "temps")
    dd = F.try_to_date(F.col("dt"), "yyyy-MM-dd")
    return d.select("dt", dd.cast("string").alias("d"), F.year(dd).alias("y"), F.date_format(dd, "yyyy-MM").alias("ym"),
                    F.year(F.current_date()).alias("current_year"))


@register("scalar_string", with_views("""
select car_id, replace(car_name || '.parquet', '.parquet', '_stats.parquet') as stats_key, lower(fuel_type) as fuel_lower,
  contains(fuel_type, 'e') as has_e, printf('%.4f', present_price) as price_txt,
  concat_ws('-', car_name, fuel_type, seller_type) as joined from cars_raw""", "cars_raw"))
def q_scalar_string(spark, sf_dir):
    from autoprice.functions.scalar import fixed_decimals
    d = view(spark, sf_dir, "cars_raw")
    return d.select("car_id", F.replace(F.concat("car_name", F.lit(".parquet")), F.lit(".parquet"),
                                        F.lit("_stats.parquet")).alias("stats_key"),
                    F.lower("fuel_type").alias("fuel_lower"), F.contains("fuel_type", F.lit("e")).alias("has_e"),
                    fixed_decimals("present_price", 4).alias("price_txt"),
                    F.concat_ws("-", "car_name", "fuel_type", "seller_type").alias("joined"))


@register("scalar_hash", with_views("select car_id, md5(car_name) as name_md5 from cars_raw", "cars_raw"))
def q_scalar_hash(spark, sf_dir):
    return view(spark, sf_dir, "cars_raw").select("car_id", F.md5("car_name").alias("name_md5"))


@register("scalar_conditional", with_views("""
select car_id, case when year is null then 'missing' when year > 2010 then 'new' when year > 2000 then 'mid' else 'old' end
  as age_band, coalesce(fuel_type, seller_type, 'none') as first_known, year is null as year_missing from cars_raw""",
    "cars_raw"))
def q_scalar_conditional(spark, sf_dir):
    d = view(spark, sf_dir, "cars_raw")
    band = (F.when(F.col("year").isNull(), "missing").when(F.col("year") > 2010, "new")
             .when(F.col("year") > 2000, "mid").otherwise("old"))
    return d.select("car_id", band.alias("age_band"), F.coalesce("fuel_type", "seller_type", F.lit("none")).alias("first_known"),
                    F.col("year").isNull().alias("year_missing"))


@register("scalar_json", with_views("""
select car_id, case when json_valid(value) then json_extract_string(value, '$.Fuel_Type') end as fuel_type,
  case when json_valid(value) then try_cast(json_extract(value, '$.Year') as integer) end as year,
  case when json_valid(value) and try_cast(json_extract(value, '$.Year') as integer) is not null
    then to_json({'fuel': json_extract_string(value, '$.Fuel_Type'),
      'year': try_cast(json_extract(value, '$.Year') as integer)}) end as echo from requests""", "requests"))
def q_scalar_json(spark, sf_dir):
    d = view(spark, sf_dir, "requests")
    parsed = F.from_json("value", "Year int, Fuel_Type string")
    echo = F.when(parsed.isNotNull() & parsed.getField("Year").isNotNull(),
                  F.to_json(F.struct(parsed.getField("Fuel_Type").alias("fuel"), parsed.getField("Year").alias("year")),
                            {"ignoreNullFields": "false"}))
    return d.select("car_id", F.get_json_object("value", "$.Fuel_Type").alias("fuel_type"),
                    parsed.getField("Year").alias("year"), echo.alias("echo"))
