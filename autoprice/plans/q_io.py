"""Catalogue entries: sources and sinks as write -> read round trips.

Each query writes a fixture view with the sink under test into a fresh folder beside the checkpoint
directory and reads it back with the matching reader, so the oracle is the view itself.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from autoprice.operators import clean as C
from autoprice.plans.fixtures import table, view, with_views
from autoprice.plans.q_clean import _J2_SQL, CAR_COLS, MIN_YEAR, TX_COLS, Y
from autoprice.plans.registry import register
from autoprice.session import scratch_dir
from autoprice.sources import readers as RD
from autoprice.sources import sinks as SK


@register("read_csv_header", with_views(f"select {CAR_COLS} from cars_raw", "cars_raw"))
def q_read_csv_header(spark, sf_dir):
    out = scratch_dir(spark, "cars-csv")
    SK.write_csv(view(spark, sf_dir, "cars_raw"), out)
    return RD.read_csv_header(spark, out)


@register("read_csv_positional", with_views(f"select {TX_COLS} from tx_raw", "tx_raw"))
def q_read_csv_positional(spark, sf_dir):
    out = scratch_dir(spark, "tx-csv")
    view(spark, sf_dir, "tx_raw").write.mode("overwrite").option("header", False).csv(out + "/data")
    # a comment-only file next to the data, as the source files carry '#' lines
    spark.createDataFrame([("# exported transactions",)], "value string").write.mode("append").text(out + "/data")
    return RD.read_csv_positional(spark, out + "/data/*")


@register("rename_positional", with_views(f"select {TX_COLS} from tx_raw", "tx_raw"))
def q_rename_positional(spark, sf_dir):
    d = view(spark, sf_dir, "tx_raw")
    return RD.rename_positional(d.toDF(*[f"_c{i}" for i in range(len(d.columns))]), RD.TX_COLUMNS)


@register("read_parquet", with_views(f"select {CAR_COLS} from cars_raw", "cars_raw"))
def q_read_parquet(spark, sf_dir):
    out = scratch_dir(spark, "cars-parquet")
    SK.write_parquet(view(spark, sf_dir, "cars_raw"), out)
    return RD.read_parquet(spark, out)


@register("read_dated_csv", with_views("select dt, country, average_temperature from temps", "temps"))
def q_read_dated_csv(spark, sf_dir):
    out = scratch_dir(spark, "temps-csv")
    SK.write_csv(view(spark, sf_dir, "temps").select("dt", "country", "average_temperature"), out)
    return RD.read_dated_csv(spark, out)


@register("read_text_dir", "select url as value from pages")
def q_read_text_dir(spark, sf_dir):
    out = scratch_dir(spark, "logs")
    table(spark, sf_dir, "pages").select("url").repartition(4).write.mode("overwrite").text(out)
    return RD.read_text_dir(spark, out).select("value")


@register("merge_text", "select url as value from pages")
def q_merge_text(spark, sf_dir):
    src, dst = scratch_dir(spark, "logs"), scratch_dir(spark, "merged")
    table(spark, sf_dir, "pages").select("url").repartition(4).write.mode("overwrite").text(src)
    # ordered multi-part output: same lines as one merged file, without funnelling the text through one task
    SK.merge_text(RD.read_text_dir(spark, src), dst)
    return spark.read.text(dst)


@register("synthetic_cars", with_views("""
select car_id, year, present_price, kms_driven, owner, fuel_type, seller_type, transmission, 2025 - year as car_age,
  round_even(kms_driven / greatest(2025 - year, 1), 1) as kms_per_year from cars_raw""", "cars_raw"))
def q_producer_records(spark, sf_dir):
    """S8, re-aimed: the load producer's record (car fields with age and rounded kilometres per year) made
    from the given cars instead of random draws."""
    d = view(spark, sf_dir, "cars_raw").withColumn("car_age", C.car_age(as_of_year=2025))
    return d.select("car_id", "year", "present_price", "kms_driven", "owner", "fuel_type", "seller_type", "transmission",
                    "car_age", C.kms_per_year_rounded().alias("kms_per_year"))


# ------------------------------------------------------------------ the jobs on files of the reference's layout

# The header names of the car file, without an id.
CAR_HEADER = ["Car_Name", "Year", "Selling_Price", "Present_Price", "Kms_Driven", "Fuel_Type", "Seller_Type", "Transmission", "Owner"]


@register("clean_cars_job", with_views(f", j2 as ({_J2_SQL})\nselect * exclude (car_id) from j2", "cars_raw"))
def q_clean_cars_job(spark, sf_dir):
    """J2 as a job over a header CSV of nine capitalised columns in another order and one column more."""
    from autoprice.plans.jobs import run_clean_cars
    src, out = scratch_dir(spark, "cars-file"), scratch_dir(spark, "cars-job") + "/cars.parquet"
    raw = view(spark, sf_dir, "cars_raw")
    raw.select(F.lit("spare").alias("Colour"), *[F.col(c.lower()).alias(c) for c in reversed(CAR_HEADER)]) \
       .write.mode("overwrite").option("header", True).csv(src)
    run_clean_cars(spark, src, out, "mean", Y)
    return spark.read.parquet(out).drop("colour").withColumn("kms_per_year", F.round("kms_per_year", 6))


@register("clean_transactions_job", with_views(f"""
, d as (select {TX_COLS}, count(*) as c from tx_raw group by all),
n as (select {", ".join(f"count(*) - count({c}) as {c}" for c in RD.TX_COLUMNS)} from d),
z as (select cast(count_if(try_cast(terminal_id as bigint) = 0) as bigint) as terminal_id,
  cast(count_if(try_cast(customer_id as bigint) = 0) as bigint) as customer_id from d),
bad as (select count(*) as b from events where event_id % 97 = 0)
select column_name, 'null' as kind, v as count from (unpivot n on columns(*) into name column_name value v) where v > 0
union all select column_name, 'zero', v from (unpivot z on columns(*) into name column_name value v)
union all select '', 'input', (select count(*) from tx_raw) + (select b from bad)
union all select '', 'rejected', (select b from bad)
union all select '', 'duplicate', (select sum(c - 1)::bigint from d)""", "tx_raw"))
def q_clean_transactions_job(spark, sf_dir):
    """J3 as a job over headerless files with comment lines and ragged lines (too few and too many fields)."""
    from autoprice.plans.jobs import run_clean_transactions
    src, out = scratch_dir(spark, "tx-files"), scratch_dir(spark, "tx-job")
    view(spark, sf_dir, "tx_raw").write.mode("append").option("header", False).csv(src)
    ragged = F.when(F.col("event_id") % 2 == 0, F.concat_ws(",", "event_id", "user_id")).otherwise(
        F.concat_ws(",", *["event_id"] * (len(RD.TX_COLUMNS) + 2)))
    table(spark, sf_dir, "events").where("event_id % 97 = 0").select(ragged).write.mode("append").text(src)
    spark.createDataFrame([("# exported transactions",)], "value string").write.mode("append").text(src)
    return run_clean_transactions(spark, src + "/*", out)


@register("temperature_job", with_views(f"""
, f as (select * from temps where year(try_strptime(dt, '%Y-%m-%d')) >= {MIN_YEAR} and country is not null)
select country, round(median(average_temperature), 6) as median_temperature from f group by country""", "temps"))
def q_temperature_job(spark, sf_dir):
    """J4 as a job over a file whose header is spelled and ordered as the source's, with a column more."""
    from autoprice.plans.jobs import run_temperature_etl
    src, out = scratch_dir(spark, "temps-file"), scratch_dir(spark, "temps-job")
    view(spark, sf_dir, "temps").select("dt", F.col("average_temperature").alias("AverageTemperature"),
                                        F.lit(0.25).alias("AverageTemperatureUncertainty"), F.col("country").alias("Country")) \
        .write.mode("overwrite").option("header", True).csv(src)
    run_temperature_etl(spark, src, out, MIN_YEAR)
    back = spark.read.option("header", True).schema("country string, median_temperature double").csv(out)
    return back.select("country", F.round("median_temperature", 6).alias("median_temperature"))


@register("write_parquet", with_views(f", j2 as ({_J2_SQL})\nselect * from j2", "cars_raw"))
def q_write_parquet(spark, sf_dir):
    out = scratch_dir(spark, "cars-clean")
    d = C.clean_cars_mean(view(spark, sf_dir, "cars_raw"), as_of_year=Y)
    SK.write_parquet(d.withColumn("kms_per_year", F.round("kms_per_year", 6)), out)
    return spark.read.parquet(out)


@register("write_partitioned", with_views(f"""
, d as (select distinct {TX_COLS} from tx_raw)
select cast(try_cast(tx_datetime as date) as varchar) as tx_date, count(*) as n_rows from d
where try_cast(terminal_id as bigint) <> 0 and try_cast(customer_id as bigint) <> 0 group by 1""", "tx_raw"))
def q_write_partitioned(spark, sf_dir):
    out = scratch_dir(spark, "tx-clean")
    SK.write_partitioned(C.clean_transactions(view(spark, sf_dir, "tx_raw")), out, "tx_date")
    back = spark.read.parquet(out)
    return back.groupBy(F.col("tx_date").cast("string").alias("tx_date")).agg(F.count(F.lit(1)).alias("n_rows"))


@register("write_csv", with_views(f"""
, f as (select * from temps where year(try_strptime(dt, '%Y-%m-%d')) >= {MIN_YEAR} and country is not null)
select country, round(median(average_temperature), 6) as median_temperature from f group by country""", "temps"))
def q_write_csv(spark, sf_dir):
    out = scratch_dir(spark, "temps-median")
    SK.write_csv(C.temperature_etl(view(spark, sf_dir, "temps"), MIN_YEAR), out)
    return spark.read.option("header", True).schema("country string, median_temperature double").csv(out) \
                .select("country", F.round("median_temperature", 6).alias("median_temperature"))


@register("write_stats", with_views(f"""
, j2 as ({_J2_SQL})
select (select count(*) from cars_raw) as original_records, (select count(*) from j2) as processed_records,
  (select count(*) from cars_raw) - (select count(*) from j2) as removed_records,
  ['car_id', 'car_name', 'year', 'selling_price', 'present_price', 'kms_driven', 'fuel_type', 'seller_type',
   'transmission', 'owner', 'car_age', 'kms_per_year'] as columns""", "cars_raw"))
def q_write_stats(spark, sf_dir):
    out = scratch_dir(spark, "cars-out") + "/cars_clean.parquet"
    raw = view(spark, sf_dir, "cars_raw")
    SK.write_with_stats(raw, C.clean_cars_mean(raw, as_of_year=Y), out, "fixed-for-check")
    st = spark.read.parquet(SK.stats_path(out))
    return st.select("original_records", "processed_records", "removed_records", "columns")


@register("unique_output_key", with_views(
    "select model_name, version, md5(model_name || '-' || cast(version as varchar) || '-2024-01-01T00:00:00') || '.csv' "
    "as object_key from model_versions", "model_versions"))
def q_unique_output_key(spark, sf_dir):
    mv = view(spark, sf_dir, "model_versions")
    run_id = F.concat_ws("-", "model_name", F.col("version").cast("string"))
    return mv.select("model_name", "version", SK.unique_output_key(run_id, F.lit("2024-01-01T00:00:00")).alias("object_key"))


def _line_sql(src: str, title: str, what: list) -> str:
    """The text lines of a report about the one row of ``src``; columns it lacks are N/A."""
    out = [f"select '{title}' as value", "select 'Run: run-0001'", f"select 'Validation split: {SK.STRATEGY}'"]
    for label, c, digits in what:
        value = f"cast({c} as varchar)" if digits is None else f"printf('%.{digits}f', {c})"
        out.append(f"select '{label}: ' || coalesce({value}, 'N/A') from {src}")
    return "\nunion all ".join(out)


def _report_sql() -> str:
    from autoprice.plans.q_abtest import _VAL
    return with_views(_VAL + ", rep as (select *, n_old + n_new as n_total from vs)\n"
                      + _line_sql("rep", "Report of the A/B validation", SK.AB_REPORT), "scored")


@register("write_report", _report_sql())
def q_write_report(spark, sf_dir):
    from autoprice.plans.q_abtest import _validation
    out = scratch_dir(spark, "report")
    SK.write_report(_validation(spark, sf_dir), out)
    return spark.read.text(out)


def _final_sql() -> str:
    from autoprice.plans.q_abtest import _RUN
    return with_views(_RUN + ", fin as (select *, 1 as n_features from g)\n"
                      + _line_sql("fin", "Final evaluation of the price model", SK.FINAL_REPORT)
                      + "\nunion all select 'Feature present_price: 1.0000'", "scored")


@register("write_final_report", _final_sql())
def q_write_final_report(spark, sf_dir):
    from autoprice.plans.q_abtest import _run_row
    out = scratch_dir(spark, "final-report")
    # the formula model has one feature
    only = spark.createDataFrame([("present_price", 1.0)], "feature string, importance double")
    SK.write_final_report(_run_row(spark, sf_dir).withColumn("n_features", F.lit(1)), only, out)
    return spark.read.text(out)
