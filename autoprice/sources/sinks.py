"""Writers. Streaming sinks (K5) live in ``autoprice.streaming``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """K1: overwrite, snappy."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_col: str = "tx_date") -> None:
    """K2: Parquet partitioned by ``partition_col`` (overwrite).

    A ``rebalance`` on the partition column clusters rows by date, so each task writes few
    directories (no small-file explosion), while AQE splits a skewed date (one date may hold a third
    of all rows) over several tasks and coalesces small ones; a plain ``repartition(col)`` would put
    a hot date in one task."""
    df.hint("rebalance", partition_col).write.mode("overwrite").partitionBy(partition_col).parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """K3: CSV with a header line, no index column."""
    df.write.mode("overwrite").option("header", header).csv(path)


def stats_path(output_path: str) -> str:
    """K4 path rule: ``x.parquet`` -> ``x_stats.parquet``."""
    return output_path.replace(".parquet", "_stats.parquet") if ".parquet" in output_path else output_path + "_stats"


def write_with_stats(raw: DataFrame, processed: DataFrame, output_path: str, processing_date: str,
                     extra: dict[str, str] | None = None) -> DataFrame:
    """K1 + K4 + A1: write the processed table, count its rows from the written files (a count over
    Parquet reads row-group metadata only, not the data), count the raw rows with one aggregate,
    then write the one-row statistics table beside it. Returns the statistics row.

    (``df.observe`` would count during the write, but in this Spark version an ``Observation`` on
    the session breaks later RDD-based jobs such as forest training.)"""
    spark = processed.sparkSession
    write_parquet(processed, output_path)
    n_processed = int(spark.read.parquet(output_path).count())
    n_raw = int(raw.agg(F.count(F.lit(1))).first()[0])
    cols = list(processed.columns)
    row = spark.range(1).select(
        F.lit(processing_date).alias("processing_date"), F.lit(n_raw).cast("bigint").alias("original_records"),
        F.lit(n_processed).cast("bigint").alias("processed_records"),
        F.lit(n_raw - n_processed).cast("bigint").alias("removed_records"),
        F.array(*[F.lit(c) for c in cols]).alias("columns"),
        *[F.lit(v).alias(k) for k, v in (extra or {}).items()])
    write_parquet(row, stats_path(output_path))
    return row


def _number(c: str, digits: int = 4):
    from autoprice.functions.scalar import fixed_decimals
    return F.coalesce(fixed_decimals(c, digits), F.lit("N/A"))


def _text(c: str):
    return F.coalesce(F.col(c).cast("string"), F.lit("N/A"))


# What a report states, in order: (label, column, digits of a number or None for text). A column that the
# metrics row lacks is printed as N/A.
AB_REPORT = [("Baseline model A R2", "r2_a", 4), ("Baseline model A MAE", "mae_a", 4), ("Baseline model A RMSE", "rmse_a", 4),
             ("New model B R2", "r2_b", 4), ("New model B MAE", "mae_b", 4), ("New model B RMSE", "rmse_b", 4),
             ("Improvement in percent", "improvement_pct", 2), ("Validation status", "validation_status", None),
             ("Rows in all", "n_total", None), ("Rows in the new segment", "n_new", None), ("Rows that test model B", "n_test_b", None)]
FINAL_REPORT = [("Quality", "quality", None), ("R2", "r2", 4), ("Cross-validated R2", "cv_r2", 4),
                ("Deviation of the cross-validated R2", "cv_r2_std", 4), ("MAE", "mae", 4), ("RMSE", "rmse", 4),
                ("A/B validation", "validation_status", None), ("Improvement in percent", "improvement_pct", 2),
                ("Rows in all", "n_total", None), ("Features", "n_features", None)]
STRATEGY = "ordered by time, first 60 percent old, rest new"


def _lines(row: DataFrame, title: str, run_id: str, what: list) -> DataFrame:
    """(line_no, value) of a report about one metrics row."""
    if "n_total" not in row.columns and {"n_old", "n_new"} <= set(row.columns):
        row = row.withColumn("n_total", F.col("n_old") + F.col("n_new"))
    body = [F.concat(F.lit(f"{label}: "), F.lit("N/A") if c not in row.columns else _text(c) if digits is None else _number(c, digits))
            for label, c, digits in what]
    lines = [F.lit(title), F.lit(f"Run: {run_id}"), F.lit(f"Validation split: {STRATEGY}"), *body]
    return row.select(F.posexplode(F.array(*lines)).alias("line_no", "value"))


def report_lines(metrics_row: DataFrame, run_id: str = "run-0001") -> DataFrame:
    """K6: the A/B validation report as text lines (4-decimal metrics, 2-decimal improvement)."""
    return _lines(metrics_row, "Report of the A/B validation", run_id, AB_REPORT)


def final_report_lines(metrics_row: DataFrame, importances: DataFrame | None = None, run_id: str = "run-0001") -> DataFrame:
    """K6: the final evaluation of a run as text lines, with the most important features if given."""
    lines = _lines(metrics_row, "Final evaluation of the price model", run_id, FINAL_REPORT)
    if importances is None:
        return lines
    # the few top features, best first, after the other lines
    top = importances.agg(F.array_sort(F.collect_list(F.struct((-F.col("importance")).alias("o"), "feature", "importance"))).alias("t"))
    top = top.select(F.posexplode("t").alias("place", "f")).select("place", "f.feature", "f.importance")
    return lines.unionByName(top.select((F.col("place") + 1000).alias("line_no"), F.concat(
        F.lit("Feature "), F.col("feature"), F.lit(": "), _number("importance")).alias("value")))


def _write_lines(lines: DataFrame, path: str) -> None:
    lines.orderBy("line_no").select("value").coalesce(1).write.mode("overwrite").text(path)


def write_report(metrics_row: DataFrame, path: str, run_id: str = "run-0001") -> None:
    """K6 sink: one small text file (the report is a handful of lines)."""
    _write_lines(report_lines(metrics_row, run_id), path)


def write_final_report(metrics_row: DataFrame, importances: DataFrame | None, path: str, run_id: str = "run-0001") -> None:
    _write_lines(final_report_lines(metrics_row, importances, run_id), path)


def merge_text(lines: DataFrame, path: str) -> None:
    """K7: all log lines in (file, offset) order, written as ordered part files (a global sort, so
    part i precedes part i+1)."""
    lines.orderBy("file_path", "block_start", "pos").select("value").write.mode("overwrite").text(path)


def unique_output_key(run_id, ts, suffix: str = ".csv"):
    """K8: deterministic per-run object key ``md5(run_id-ts) + suffix``."""
    return F.concat(F.md5(F.concat_ws("-", run_id, ts)), F.lit(suffix))
