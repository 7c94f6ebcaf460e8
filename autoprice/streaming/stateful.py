"""Stateful monitoring operators on a stream.

``alert_stream``    W10: alert transitions of a windowed series, with timers for silence
``health_panes``    J10: sketches of panes, merged into windows with p95 (``health_windows``)
``counter_stream``  W7, W8: increases of cumulative counters per pane, across micro-batches and resets
``split_late``      W12: rows later than the watermark go to a table of their own, not nowhere

Alerts and counters are ``transformWithState`` processors: state is one small value per series or pod, kept in RocksDB
(``rocksdb_state`` sets the provider while a query is started), and bounded by the number of series.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from autoprice.operators import monitor as MO
from autoprice.operators import sketch as SK
from autoprice.streaming.monitor import with_event_time

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """State of queries started inside lies in RocksDB, which ``transformWithState`` needs; the session's setting is put back."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


# ------------------------------------------------------------------ W10: alerts

class _Alerts(StatefulProcessor):
    """Per metric: whether it fires, the last firing window (ms) and its value. Windows come once each, closed, and in later
    batches later; within a batch they are sorted here."""

    def __init__(self, thresholds: dict[str, tuple[float, bool]], width_ms: int, slide_ms: int) -> None:
        self._thresholds, self._width, self._slide = thresholds, width_ms, slide_ms

    def init(self, handle) -> None:
        self._handle = handle
        self._firing = handle.getValueState("firing", "last long, value double")

    def _resolve(self, key) -> Row:
        last, value = self._firing.get()
        self._firing.clear()
        return Row(metric=key[0], start_ms=last + self._slide, state="resolved", value=value)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        threshold, above = self._thresholds[key[0]]
        for start, value in sorted((r.start_ms, r.value) for r in rows):
            fires = value is not None and (value > threshold if above else value < threshold)
            if self._firing.exists() and start > self._firing.get()[0] + self._slide:
                yield self._resolve(key)  # windows without data in between
            if fires:
                if not self._firing.exists():
                    yield Row(metric=key[0], start_ms=start, state="firing", value=value)
                self._firing.update((start, value))
            elif self._firing.exists():
                yield self._resolve(key)
        for timer in list(self._handle.listTimers()):
            self._handle.deleteTimer(timer)
        if self._firing.exists():  # when the next window is over, and had no data
            self._handle.registerTimer(self._firing.get()[0] + self._slide + self._width)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self._firing.exists() and expiredTimerInfo.getExpiryTimeInMs() >= self._firing.get()[0] + self._slide + self._width:
            yield self._resolve(key)

    def close(self) -> None:
        pass


def alert_stream(series: DataFrame, thresholds: dict[str, float], width: str, slide: str, above: bool = True) -> DataFrame:
    """W10 on a stream: ``series`` (metric, window, value) are closed windows, as a windowed aggregate in append mode gives
    them. ``firing`` when the condition begins to hold, ``resolved`` one slide after the last firing window: at once when a
    window without the condition follows, and once the watermark has passed the next window's end when none does. Equals
    ``monitor.threshold_alerts`` up to the final watermark."""
    ms = lambda spec: MO._seconds(spec) * 1000
    d = series.where(F.col("metric").isin(list(thresholds))).select(
        "metric", F.window_time("window").alias("_at"), F.unix_millis(F.col("window.start")).alias("start_ms"), F.col("value").cast("double").alias("value"))
    made = _Alerts({m: (float(t), above) for m, t in thresholds.items()}, ms(width), ms(slide))
    out = d.groupBy("metric").transformWithState(made, "metric string, start_ms long, state string, value double", "append", "eventTime")
    return out.select("metric", F.timestamp_millis("start_ms").alias("window_start"), "state", "value")


def alert_series(log: DataFrame, width: str, slide: str, delay: str) -> DataFrame:
    """The monitored series of a prediction log as (metric, window, value) rows of closed windows: errors, and requests."""
    d = with_event_time(log, "ts", delay)
    w = d.groupBy(F.window("ts", width, slide)).agg(F.count_if(~F.col("ok")).cast("double").alias("errors"), F.count(F.lit(1)).cast("double").alias("requests"))
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("errors", "requests")])
    return w.select("window", F.explode(pairs).alias("m")).select("m.metric", "window", "m.value")


# ------------------------------------------------------------------ J10: health of windows, from sketches of panes

def health_panes(log: DataFrame, slide: str, delay: str, alpha: float = SK.ALPHA) -> DataFrame:
    """A stream of closed panes of a prediction log: (pane, ok, bucket, n), the sketch of each pane's latencies by outcome. A latency that is
    unknown has no bucket."""
    d = with_event_time(log, "ts", delay).withColumn("bucket", SK.log_bucket("latency_s", alpha))
    return d.groupBy(F.window("ts", slide), "ok", "bucket").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("pane"), "ok", "bucket", "n")


def health_windows(panes: DataFrame, width: str, slide: str, alpha: float = SK.ALPHA) -> DataFrame:
    """J10 from the table of ``health_panes``: requests, errors and status, p95 latency within ``alpha``, and rate of each window that any pane
    lies in. Panes are merged, not rows, and the table serves any width."""
    w = MO.in_windows(panes, "pane", width, slide)
    keys = ["window_start", "window_end"]
    counts = w.groupBy(*keys).agg(F.sum("n").alias("requests"), F.sum(F.when(~F.col("ok"), F.col("n")).otherwise(0)).alias("errors"))
    counts = counts.withColumn("status", F.when(F.col("errors") >= 1, "red").otherwise("green")) \
                   .withColumn("rate_per_s", F.col("requests") / float(MO._seconds(width)))
    p95 = SK.sketch_quantiles(SK.merge(w.where(F.col("bucket").isNotNull()), keys), [0.95], ["latency_p95"], keys, alpha)
    return counts.join(p95, keys, "left")


# ------------------------------------------------------------------ W7, W8: counters

class _Counter(StatefulProcessor):
    """Per pod: the last sample (ms, value). A batch's samples are held as columns of numbers, 24 bytes a sample, not as Python rows."""

    def __init__(self, slide_ms: int) -> None:
        self._slide = slide_ms

    def init(self, handle) -> None:
        self._last = handle.getValueState("last", "at long, x double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = [(f.at_ms.to_numpy(np.int64), f.x.to_numpy(np.float64), f.limit.to_numpy(np.float64)) for f in rows if len(f)]
        if not frames:
            return
        at, x, limit = (np.concatenate(c) for c in zip(*frames))
        del frames
        order = np.lexsort((x, at))
        at, x, limit = at[order], x[order], limit[order]
        last = self._last.get() if self._last.exists() else None
        pane = at // self._slide * self._slide
        before, step = np.empty_like(pane), np.empty_like(x)
        before[1:], step[1:] = pane[:-1], np.where(x[1:] >= x[:-1], x[1:] - x[:-1], x[1:])
        # the first sample of all has none before it: a group of its own, whose before_ms is null
        before[0] = -1 if last is None else last[0] // self._slide * self._slide
        step[0] = 0.0 if last is None else x[0] - last[1] if x[0] >= last[1] else x[0]
        # in time order, the samples of a pane and the pane before are neighbours
        first = np.append(True, (pane[1:] != pane[:-1]) | (before[1:] != before[:-1]))
        first[1:2] |= last is None
        first = np.flatnonzero(first)
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(at))))
        self._last.update((int(at[-1]), float(x[-1])))
        earlier = pd.Series(before[first], dtype="Int64").mask((first == 0) & (last is None))
        yield pd.DataFrame({"key": key[0], "pane_ms": pane[first], "before_ms": earlier, "step": np.bincount(group, step),
                            "limit": np.fmax.reduceat(limit, first)})

    def close(self) -> None:
        pass


def counter_stream(samples: DataFrame, counter: str, key: str, slide: str, limit: str | None = None, ts: str = "ts",
                   delay: str = "10 minutes") -> DataFrame:
    """W7, W8 on a stream: the steps between neighbouring samples of a cumulative counter (after a reset, a smaller value, the new
    value), summed per key, pane_ms (the pane of one slide that the later sample lies in) and before_ms (that of the earlier
    one), with the largest limit. The last sample of each key is kept from batch to batch. Samples of a key must come in time order from
    batch to batch (within one they are sorted). ``counter_windows`` makes windows of the result."""
    d = with_event_time(samples.where(F.col(counter).isNotNull() & F.col(ts).isNotNull()), ts, delay)
    d = d.select(F.col(key).cast("string").alias("key"), ts, F.unix_millis(F.col(ts)).alias("at_ms"), F.col(counter).cast("double").alias("x"),
                 (F.col(limit).cast("double") if limit else F.lit(None).cast("double")).alias("limit"))
    return d.groupBy("key").transformWithStateInPandas(
        _Counter(MO._seconds(slide) * 1000), "key string, pane_ms long, before_ms long, step double, limit double", "append", "eventTime")


def counter_windows(steps: DataFrame, width: str, slide: str) -> DataFrame:
    """Increase and limit of each key and window from the table of ``counter_stream`` rows: key, window_start, window_end, increase,
    limit. A step counts in the windows that hold both of its samples."""
    panes = steps.groupBy("key", "pane_ms", "before_ms").agg(F.sum("step").alias("step"), F.max("limit").alias("limit"))
    panes = panes.withColumn("_pane", F.timestamp_millis("pane_ms"))
    w = MO.in_windows(panes, "_pane", width, slide)
    inside = F.col("before_ms") >= F.unix_millis("window_start")
    return w.groupBy("key", "window_start", "window_end").agg(
        F.sum(F.when(inside, F.col("step")).otherwise(0.0)).alias("increase"), F.max("limit").alias("limit"))


# ------------------------------------------------------------------ W12: late rows

def split_late(df: DataFrame, on_time: str, late: str, checkpoint: str, ts: str = "ts", delay: str = "10 minutes"):
    """Start a query that writes each micro-batch's rows to the table ``on_time`` or, where they are later than the watermark, to
    ``late``; rows in = rows on time + rows late. The watermark of a batch is the latest event time of the batches before it less ``delay``,
    as Spark's own. Rows without an event time are on time.

    Batches are written under their number, and a batch that is replayed replaces itself. The latest event time of each batch
    is a table beside the checkpoint, so a restarted query goes on with the same watermark. Windows over a stream of
    ``on_time`` with the same delay drop nothing."""
    spark = df.sparkSession
    seen = f"{checkpoint.rstrip('/')}-event-times"
    seconds = MO._seconds(delay)

    def write(rows: DataFrame, path: str, epoch: int) -> None:
        (rows.withColumn("epoch_id", F.lit(epoch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("epoch_id").parquet(path))

    def run(batch: DataFrame, epoch: int) -> None:
        write(spark.createDataFrame([], "latest timestamp"), seen, -1)  # the table exists from the first batch on
        batch = batch.withColumn(ts, F.col(ts).cast("timestamp"))
        batch.persist()
        try:
            known = spark.read.schema("latest timestamp, epoch_id int").parquet(seen).where(F.col("epoch_id") < epoch)
            latest = known.agg(F.unix_micros(F.max("latest")).alias("latest")).first().latest
            mark = F.timestamp_micros(F.lit(None if latest is None else latest - seconds * 1_000_000).cast("bigint"))
            is_late = F.coalesce(F.col(ts) < mark, F.lit(False))
            write(batch.where(~is_late), on_time, epoch)
            write(batch.where(is_late).withColumn("watermark", mark), late, epoch)
            write(batch.agg(F.max(ts).alias("latest")), seen, epoch)
        finally:
            batch.unpersist()
    return df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
