"""Streaming monitoring.

The window aggregates of ``autoprice.operators.monitor`` run unchanged on a streaming DataFrame.
A watermark bounds the state: windows older than the watermark are finalised (append mode) and
dropped from the state store, and events later than the watermark are ignored (W12). Exact
percentiles keep every value in state, so the streaming p95 uses the bounded
``percentile_approx`` sketch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from autoprice.operators import monitor as MO


def with_event_time(df: DataFrame, ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Watermark on the event time (TIMESTAMP_NTZ cast to TIMESTAMP first)."""
    d = df.withColumn(ts, F.col(ts).cast("timestamp")) if isinstance(df.schema[ts].dataType, T.TimestampNTZType) else df
    return d.withWatermark(ts, delay)


def stream_request_counts(df: DataFrame, ts: str = "ts", width: str = "5 minutes", slide: str = "1 minute",
                          delay: str | None = "10 minutes") -> DataFrame:
    """W2 on a stream (append mode needs ``delay``; complete mode may pass ``None``)."""
    d = with_event_time(df, ts, delay) if delay else df
    return MO.request_count(d, ts, width, slide)


def stream_health(df: DataFrame, ts: str = "ts", width: str = "5 minutes", slide: str = "1 minute",
                  delay: str = "10 minutes") -> DataFrame:
    """J10 on a stream: requests, errors + status, approximate p95 and rate per window."""
    d = with_event_time(df, ts, delay)
    secs = float(MO._seconds(width))
    out = MO.window_agg(d, [F.count(F.lit(1)).alias("requests"), F.count_if(~F.col("ok")).alias("errors"),
                            F.percentile_approx("latency_s", 0.95, 10000).alias("latency_p95"),
                            F.min("latency_s").alias("latency_min"), F.max("latency_s").alias("latency_max")], ts, width, slide)
    return out.withColumn("status", F.when(F.col("errors") >= 1, "red").otherwise("green")) \
              .withColumn("rate_per_s", F.col("requests") / secs)
