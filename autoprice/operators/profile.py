"""Row counts and column profiles.

Every profile is one aggregate pass over the data (partial aggregation on the map side), reshaped to
one row per column with ``unpivot``; none of them runs an action per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from autoprice.operators.ranking import exact_quantiles, quantiles
from autoprice.session import ensure_checkpoint_dir

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def _steps_from_counts(row: DataFrame, names: list[str]) -> DataFrame:
    """One output row per step from a one-row DataFrame with count columns c0..cn."""
    rows = F.array(*[F.struct(F.lit(i).alias("step_no"), F.lit(n).alias("step"), F.col(f"c{i}").alias("row_count"),
                              (F.col(f"c{i - 1}") - F.col(f"c{i}") if i else F.lit(0).cast("bigint")).alias("removed"))
                     for i, n in enumerate(names)])
    return row.select(F.explode(rows).alias("s")).select("s.*")


def filter_chain_counts(df: DataFrame, steps: list[tuple[str, Column]], extra: list[tuple[str, DataFrame]] = ()
                        ) -> DataFrame:
    """A1 for a chain of filters: rows before any filter and after each cumulative filter, all from
    one aggregate (``count_if`` of the running conjunction, NULL counting as dropped), plus
    optional later steps whose counts come from their own DataFrames (e.g. after imputation)."""
    aggs, acc = [F.count(F.lit(1)).alias("c0")], None
    for i, (_, cond) in enumerate(steps, 1):
        acc = cond if acc is None else acc & cond
        aggs.append(F.count_if(F.coalesce(acc, F.lit(False))).alias(f"c{i}"))
    row = df.agg(*aggs)
    k = len(steps)
    if extra:
        row = row.select("*", *[d.agg(F.count(F.lit(1))).scalar().alias(f"c{k + 1 + j}") for j, (_, d) in enumerate(extra)])
    names = ["input"] + [n for n, _ in steps] + [n for n, _ in extra]
    return _steps_from_counts(row, names)


def null_profile(df: DataFrame, cols: list[str] | None = None, keep_zero: bool = False) -> DataFrame:
    """A2: per column the NULL count and percent of rows; columns without NULLs are omitted."""
    cols = cols or df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = agg.unpivot("_rows", cols, "column_name", "null_count")
    out = long.select("column_name", F.col("null_count").cast("bigint").alias("null_count"),
                      (F.try_divide(F.col("null_count") * 100.0, F.col("_rows"))).alias("null_pct"))
    return out if keep_zero else out.where(F.col("null_count") > 0)


def zero_profile(df: DataFrame, cols: list[str] = ("terminal_id", "customer_id")) -> DataFrame:
    """A3: count of values equal to integer 0 per key column (malformed values are not zeros)."""
    agg = df.agg(*[F.count_if(F.expr(f"try_cast(`{c}` as bigint)") == 0).alias(c) for c in cols])
    return agg.unpivot([], list(cols), "column_name", "zero_count") \
              .select("column_name", F.col("zero_count").cast("bigint").alias("zero_count"))


def describe_numeric(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """A4: count, mean, sample std, min, 25/50/75 % (exact unless ``approx``) and max per numeric column; a
    column without any value has count 0.

    The moments of all columns come from one aggregate of one row, unpivoted; only the quartiles need the
    (column, value) histogram.
    """
    cols = cols or numeric_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, count bigint, mean double, std double, min double, "
                                                   "q25 double, q50 double, q75 double, max double")
    known = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    stats = (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    row = df.agg(*[F.struct(F.lit(c).alias("column_name"), *[f(known(c)).alias(n) for n, f in stats]).alias(f"_{i}")
                   for i, c in enumerate(cols)])
    basic = row.select(F.explode(F.array(*[f"_{i}" for i in range(len(cols))])).alias("s")).select("s.*")
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v"))
                                         for c in cols])).alias("kv")).select("kv.*")
    qs = quantiles(long, "v", [0.25, 0.5, 0.75], ["q25", "q50", "q75"], ["column_name"], approx)
    return basic.join(qs, "column_name", "left").select("column_name", "count", "mean", "std", "min",
                                                        "q25", "q50", "q75", "max")


def target_stats(df: DataFrame, target: str = "selling_price") -> DataFrame:
    """A5."""
    return df.agg(F.min(target).alias("target_min"), F.max(target).alias("target_max"),
                  F.avg(target).alias("target_mean"))


def group_median(df: DataFrame, key: str, value: str, out: str = "median_value", approx: bool = False) -> DataFrame:
    """Median per group; NULL keys dropped, NULL values skipped, an all-NULL group is kept
    with a NULL median; ordered by key. Exact and skew-safe (see ``exact_quantiles``) unless ``approx``.

    One scan: the (group, value) histogram keeps the count of NULL values, so it also knows every group."""
    d = df.where(F.col(key).isNotNull())
    if approx:
        return quantile_or_null(d, key, value, out)
    ensure_checkpoint_dir(df.sparkSession)
    v = F.col(value).cast("double")
    hist = d.groupBy(key, F.when(~F.isnan(v), v).alias("_v")).agg(F.count(F.lit(1)).alias("_c")).checkpoint()
    med = exact_quantiles(d, value, [0.5], [out], [key], histogram=hist.where(F.col("_v").isNotNull()))
    return hist.select(key).distinct().join(med, key, "left").orderBy(key)


def quantile_or_null(df: DataFrame, key: str, value: str, out: str, accuracy: int = 10000) -> DataFrame:
    v = F.col(value).cast("double")
    return df.groupBy(key).agg(F.percentile_approx(F.when(~F.isnan(v), v), 0.5, accuracy).alias(out)).orderBy(key)


def value_counts_top(df: DataFrame, col: str, k: int = 1) -> DataFrame:
    """The k most frequent non-NULL values (count descending, value ascending)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))
              .orderBy(F.desc("cnt"), F.asc(col)).limit(k))


def schema_profile(df: DataFrame) -> DataFrame:
    """Per column its type, non-NULL count and the row count (``df.info`` / ``shape``)."""
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    types = F.create_map(*[x for f in df.schema.fields for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    long = agg.unpivot("_rows", df.columns, "column_name", "non_null")
    return long.select("column_name", types[F.col("column_name")].alias("data_type"),
                       F.col("non_null").cast("bigint").alias("non_null"), F.col("_rows").alias("row_count"))


def key_null_check(df: DataFrame, cols: list[str] = ("selling_price", "year", "kms_driven", "fuel_type")) -> DataFrame:
    """Missing values in key columns with an OK / WARN status."""
    present = [c for c in cols if c in df.columns]
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in present])
    long = agg.unpivot([], present, "column_name", "missing")
    return long.select("column_name", F.col("missing").cast("bigint").alias("missing"),
                       F.when(F.col("missing") == 0, F.lit("OK")).otherwise(F.lit("WARN")).alias("status"))
