"""Filters, de-duplication, imputation and derived columns.

Imputation is fit / transform, like Spark ML's ``Imputer``: *one* aggregate pass computes every
column's statistic (map-side partial aggregation, a single row reaches the driver), and the fill
applies them as literals, which Catalyst constant-folds and pushes into the scan together with the
later filters. The reference's per-column actions (one job per statistic) collapse into one job.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from autoprice.operators.ranking import quantiles

CAR_NUMERIC = ["year", "kms_driven", "present_price"]
CAR_CATEGORICAL = ["fuel_type", "seller_type", "transmission", "owner"]


def current_year() -> int:
    return _dt.date.today().year


# ---------------------------------------------------------------- filters

def drop_null_target(df: DataFrame, target: str = "selling_price") -> DataFrame:
    """drop rows whose target is NULL."""
    return df.where(F.col(target).isNotNull())


def drop_any_null(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """drop rows with a NULL in any (or any of ``subset``) column."""
    return df.na.drop(how="any", subset=subset)


def filter_outliers(df: DataFrame, price: str = "selling_price", kms: str = "kms_driven",
                    price_range: tuple[float, float] = (1.0, 10.0),
                    kms_range: tuple[float, float] = (0, 1_000_000)) -> DataFrame:
    """strict two-sided bounds on price and mileage; NULLs are dropped."""
    pc, kc = F.col(price), F.col(kms)
    return df.where((pc > price_range[0]) & (pc < price_range[1]) & (kc > kms_range[0]) & (kc < kms_range[1]))


def filter_year(df: DataFrame, year: str = "year", as_of_year: int | None = None, lower: int = 1950) -> DataFrame:
    """``lower < year <= as_of_year``."""
    y = as_of_year if as_of_year is not None else current_year()
    return df.where((F.col(year) > lower) & (F.col(year) <= y))


def nonzero_id(c: str) -> Column:
    """An id that parses as a non-zero integer; NULL or malformed ids are not kept."""
    return F.expr(f"try_cast(`{c}` as bigint)") != 0


def filter_zero_ids(df: DataFrame, cols: tuple[str, ...] = ("terminal_id", "customer_id")) -> DataFrame:
    """keep rows whose id columns are all non-zero integers."""
    cond = None
    for c in cols:
        cond = nonzero_id(c) if cond is None else cond & nonzero_id(c)
    return df.where(cond)


def filter_min_year(df: DataFrame, year_col: str = "year", min_year: int = 2000) -> DataFrame:
    """``year >= min_year``."""
    return df.where(F.col(year_col) >= min_year)


# ---------------------------------------------------------------- de-duplication

def dedupe_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop full-row duplicates (hash aggregate with map-side combine)."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


COPIES = "_copies"


def dedupe_rows_counted(df: DataFrame) -> DataFrame:
    """D1 with the number of copies of each distinct row in ``_copies`` (their sum less the rows is what was
    removed), from the same aggregate."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


# ---------------------------------------------------------------- statistics for imputation

def fill_statistics(df: DataFrame, mean_cols: list[str] = (), mode_cols: list[str] = ()) -> DataFrame:
    """One-row struct ``s`` with ``mean_<c>`` (0 when the column is all NULL) and ``mode_<c>``
    (most frequent non-NULL value, smallest on ties, NULL when none) for every column.

    One scan: grouping sets ``(), (c1), (c2), ...`` count each categorical value and average the
    numeric columns together; the grouped counts are tiny (distinct values) and reduced to modes
    by a second, in-memory aggregate.
    """
    mean_cols, mode_cols = list(mean_cols), list(mode_cols)
    sets = [[]] + [[F.col(c)] for c in mode_cols]
    aggs = [F.count(F.lit(1)).alias("_cnt"), F.grouping_id().alias("_gid")]
    aggs += [F.avg(c).alias(f"_avg_{c}") for c in mean_cols]
    grouped = df.groupingSets(sets, *[F.col(c) for c in mode_cols]).agg(*aggs) if mode_cols else \
        df.agg(*[F.count(F.lit(1)).alias("_cnt"), F.lit(0).alias("_gid")] + aggs[2:])
    full_gid = (1 << len(mode_cols)) - 1  # every mode column aggregated away -> the () set
    fields = []
    for c in mean_cols:
        fields.append(F.coalesce(F.max(F.when(F.col("_gid") == full_gid, F.col(f"_avg_{c}"))), F.lit(0.0))
                      .alias(f"mean_{c}"))
    for i, c in enumerate(mode_cols):
        gid = full_gid ^ (1 << (len(mode_cols) - 1 - i))
        best = F.min(F.when((F.col("_gid") == gid) & F.col(c).isNotNull(), F.struct((-F.col("_cnt")).alias("k"), F.col(c).alias("v"))))
        fields.append(best.getField("v").alias(f"mode_{c}"))
    return grouped.agg(F.struct(*fields).alias("s")) if fields else grouped.agg(F.struct(F.lit(0).alias("none")).alias("s"))


def fit_mean_mode(df: DataFrame, mean_cols: list[str], mode_cols: list[str]) -> dict:
    """Fit: one aggregate job -> {mean_<c>: float, mode_<c>: value} (a single row)."""
    if not mean_cols and not mode_cols:
        return {}
    return fill_statistics(df, mean_cols, mode_cols).first()["s"].asDict()


def impute_mean_mode(df: DataFrame, mean_cols: list[str] = CAR_NUMERIC, mode_cols: list[str] = CAR_CATEGORICAL,
                     default_category: str = "unknown", stats: dict | None = None) -> DataFrame:
    """D3 + D5 in one statistics pass; missing columns are skipped like the reference.
    ``stats`` (from :func:`fit_mean_mode`) lets a fitted imputer be applied to other data."""
    mean_cols = [c for c in mean_cols if c in df.columns]
    mode_cols = [c for c in mode_cols if c in df.columns]
    st = stats if stats is not None else fit_mean_mode(df, mean_cols, mode_cols)
    out = []
    for c in df.columns:
        if c in mean_cols:
            fill = F.lit(float(st[f"mean_{c}"])).cast("double")
            out.append(F.when(F.col(c).isNull(), fill).otherwise(F.col(c).cast("double")).alias(c))
        elif c in mode_cols:
            filled = F.coalesce(F.col(c), F.lit(st[f"mode_{c}"]).cast(df.schema[c].dataType))
            if isinstance(df.schema[c].dataType, T.StringType):
                filled = F.coalesce(filled, F.lit(default_category))
            out.append(filled.alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def impute_median(df: DataFrame, cols: list[str] = ("year", "kms_driven"), approx: bool = False) -> DataFrame:
    """NULL -> exact median of the column (midpoint on an even count; ``approx`` uses the
    percentile sketch). All-NULL stays NULL."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v"))
                                         for c in cols])).alias("kv")).select("kv.k", "kv.v")
    med = quantiles(long, "v", [0.5], ["median"], ["k"], approx)
    st = dict(med.collect())  # one row per imputed column
    fill = {c: F.lit(st.get(c)).cast("double") for c in cols}
    return df.select(*[(F.when(F.col(c).isNull(), fill[c]).otherwise(F.col(c).cast("double")).alias(c)
                        if c in cols else F.col(c)) for c in df.columns])


def impute_mode(df: DataFrame, cols: list[str] = CAR_CATEGORICAL, default: str = "unknown") -> DataFrame:
    """D5 alone."""
    return impute_mean_mode(df, [], cols, default)


def impute_constant(df: DataFrame, cols: list[str], value: str = "missing") -> DataFrame:
    """NULL -> a constant category; non-string columns become strings first."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(value)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


# ---------------------------------------------------------------- derived columns

def car_age(year: str = "year", as_of_year: int | None = None) -> Column:
    """P1."""
    return F.lit(as_of_year if as_of_year is not None else current_year()) - F.col(year)


def kms_per_year_plus1(kms: str = "kms_driven", age: str = "car_age") -> Column:
    """Pandas rule, ``kms / (age + 1)``."""
    return F.try_divide(F.col(kms), F.col(age) + 1)


def kms_per_year_guarded(kms: str = "kms_driven", age: str = "car_age") -> Column:
    """Spark rule, ``age > 0 ? kms / age : kms``."""
    return F.when(F.col(age) > 0, F.try_divide(F.col(kms), F.col(age))).otherwise(F.col(kms).cast("double"))


def kms_per_year_rounded(kms: str = "kms_driven", age: str = "car_age") -> Column:
    """Producer rule, ``round(kms / max(age, 1), 1)`` half-even like Python's ``round``."""
    return F.bround(F.try_divide(F.col(kms), F.greatest(F.col(age), F.lit(1))), 1)


def cast_types(df: DataFrame, casts: dict[str, str] | None = None) -> DataFrame:
    """P5: truncating casts; columns that are absent are skipped."""
    casts = casts or {"year": "int", "kms_driven": "int", "selling_price": "double",
                      "present_price": "double", "car_age": "int"}
    return df.select(*[F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns])


def derive_date(c: str) -> Column:
    """Date part of a timestamp string; malformed -> NULL instead of an error."""
    return F.try_to_date(F.col(c))


def derive_year(c: str, fmt: str = "yyyy-MM-dd") -> Column:
    """P7."""
    return F.year(F.try_to_date(F.col(c), fmt))


def relative_error_pct(pred: str, y: str) -> Column:
    """``|(pred - y) / y| * 100``; NULL when y is 0."""
    return F.abs(F.try_divide(F.col(pred) - F.col(y), F.col(y))) * 100


def nest_prediction(record_cols: list[str], prediction: str, record_name: str = "car_data",
                    prediction_name: str = "predicted_price") -> Column:
    """``{car_data: {...}, predicted_price: p}``."""
    return F.struct(F.struct(*[F.col(c) for c in record_cols]).alias(record_name),
                    F.col(prediction).cast("double").alias(prediction_name))


def new_columns(before: DataFrame, after: DataFrame) -> list[str]:
    """Columns present in ``after`` but not in ``before`` (schema-level, no job)."""
    seen = set(before.columns)
    return [c for c in after.columns if c not in seen]


# ---------------------------------------------------------------- composite cleaning jobs

def clean_cars_mean(df: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """J2, the Spark rule set: F1 -> F3 -> D3 + D5 -> F4 -> P1 -> P3 -> P5."""
    y = as_of_year if as_of_year is not None else current_year()
    d = filter_outliers(drop_null_target(df))
    d = impute_mean_mode(d)
    d = filter_year(d, as_of_year=y)
    d = d.withColumn("car_age", car_age(as_of_year=y))
    d = d.withColumn("kms_per_year", kms_per_year_guarded())
    return cast_types(d)


def clean_cars_median(df: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """J1, the pandas rule set: F1 -> F3 -> D4 -> D5 -> F4 -> P1 -> P2 -> int casts."""
    y = as_of_year if as_of_year is not None else current_year()
    d = filter_outliers(drop_null_target(df))
    d = impute_median(d, ["year", "kms_driven"])
    d = impute_mode(d)
    d = filter_year(d, as_of_year=y)
    d = d.withColumn("car_age", car_age(as_of_year=y))
    d = d.withColumn("kms_per_year", kms_per_year_plus1())
    return cast_types(d, {"year": "int", "kms_driven": "int"})


# ---------------------------------------------------------------- transactions (J3) and temperatures

def clean_transactions(df: DataFrame, id_cols: tuple[str, ...] = ("terminal_id", "customer_id"),
                       datetime_col: str = "tx_datetime") -> DataFrame:
    """J3 without the I/O: D1 -> F5 -> P6 (``tx_date``). Profiles A2/A3 run on ``dedupe_rows(df)``."""
    d = filter_zero_ids(dedupe_rows(df), id_cols)
    return d.withColumn("tx_date", derive_date(datetime_col))


def temperature_etl(df: DataFrame, min_year: int = 2000, date_col: str = "dt", key: str = "country",
                    value: str = "average_temperature") -> DataFrame:
    """J4 without the I/O: P7 -> F6 -> A6 (median per country, ordered by country)."""
    from autoprice.operators.profile import group_median
    d = df.withColumn("year", derive_year(date_col))
    return group_median(filter_min_year(d, "year", min_year), key, value, "median_temperature")
