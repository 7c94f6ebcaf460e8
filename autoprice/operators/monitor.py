"""Monitoring over a prediction log, batch form.

The dashboards' PromQL ranges become event-time windows over a log of (ts, ok, latency). Plain counts
are window aggregates (sliding windows via ``window()``: each event is expanded into the
``width / slide`` windows that contain it, then partially aggregated), so the same expressions also
run on a stream (see ``autoprice.streaming.monitor``). What needs more than a count per window (exact
quantiles, counter rates) is first reduced to panes of one slide, and only the reduced panes are copied
into the windows that contain them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from autoprice.operators.ranking import exact_quantiles
from autoprice.session import ensure_checkpoint_dir

# Default histogram bucket upper bounds of the Prometheus client library (seconds).
DEFAULT_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]


def _seconds(spec: str) -> int:
    n, unit = spec.split()
    return int(n) * {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600}[unit]


def in_windows(panes: DataFrame, pane: str, width: str, slide: str) -> DataFrame:
    """Rows of one-slide panes (``pane`` = start) copied into every window that contains their pane
    (``window_start``, ``window_end``). The width must be a whole number of slides."""
    n, rest = divmod(_seconds(width), _seconds(slide))
    if rest:
        raise ValueError(f"{width} is not a whole number of {slide}")
    back = F.explode(F.array(*[F.col(pane) - F.expr(f"interval {i * _seconds(slide)} seconds") for i in range(n)]))
    d = panes.select(*[c for c in panes.columns if c != pane], back.alias("window_start"))
    return d.withColumn("window_end", F.col("window_start") + F.expr(f"interval {_seconds(width)} seconds"))


def latency_panes(df: DataFrame, latency: str, ts: str, slide: str, by: list[str] | None = None) -> DataFrame:
    """Counts ``_c`` per (pane, latency value ``_v``) and the given columns: one scan of the log, checkpointed."""
    ensure_checkpoint_dir(df.sparkSession)
    pane = F.window(F.col(ts), slide, slide).getField("start").alias("_pane")
    d = df.where(F.col(ts).isNotNull()).groupBy(pane, *(by or []), F.col(latency).cast("double").alias("_v"))
    return d.agg(F.count(F.lit(1)).alias("_c")).checkpoint(eager=True)


def pane_quantile(panes: DataFrame, q: float, out: str, width: str, slide: str) -> DataFrame:
    known = panes.where(F.col("_v").isNotNull() & ~F.isnan("_v")).select("_pane", "_v", "_c")
    w = in_windows(known, "_pane", width, slide)
    return exact_quantiles(w, "_v", [q], [out], ["window_start", "window_end"], histogram=w)


def window_agg(df: DataFrame, aggs: list[Column], ts: str = "ts", width: str = "5 minutes",
               slide: str = "1 minute", keys: list[str] | None = None) -> DataFrame:
    g = [F.window(F.col(ts), width, slide).alias("w"), *(keys or [])]
    out = df.groupBy(*g).agg(*aggs)
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *[c for c in out.columns if c != "w"])


def request_count(df: DataFrame, ts="ts", width="5 minutes", slide="1 minute") -> DataFrame:
    """Requests per window (exact event counts; no counter extrapolation)."""
    return window_agg(df, [F.count(F.lit(1)).alias("requests")], ts, width, slide)


def error_count(df: DataFrame, ok: str = "ok", ts="ts", width="5 minutes", slide="1 minute") -> DataFrame:
    """Failed requests per window and a red / green status (red at >= 1)."""
    out = window_agg(df, [F.count_if(~F.col(ok)).alias("errors")], ts, width, slide)
    return out.withColumn("status", F.when(F.col("errors") >= 1, "red").otherwise("green"))


def latency_quantile(df: DataFrame, latency: str = "latency_s", q: float = 0.95, ts="ts", width="5 minutes",
                     slide="1 minute", out: str = "latency_p95") -> DataFrame:
    """Exact latency quantile per window, from one histogram per pane. (A stream takes the bounded
    ``percentile_approx`` instead, see ``autoprice.streaming.monitor``.)"""
    return pane_quantile(latency_panes(df, latency, ts, slide), q, out, width, slide)


def histogram_buckets(df: DataFrame, latency: str = "latency_s", buckets: list[float] = DEFAULT_BUCKETS, ts="ts",
                      width="5 minutes", slide="1 minute") -> DataFrame:
    """Cumulative bucket counts per window (``le`` = upper bound, +Inf last) with sum and count."""
    les = [float(b) for b in buckets]
    aggs = [F.count_if(F.col(latency) <= b).alias(f"_b{i}") for i, b in enumerate(les)]
    aggs += [F.count(F.lit(1)).alias("_binf"), F.sum(latency).alias("latency_sum"), F.count(F.lit(1)).alias("latency_count")]
    wide = window_agg(df, aggs, ts, width, slide)
    arr = F.array(*[F.struct(F.lit(b).alias("le"), F.col(f"_b{i}").alias("cum_count")) for i, b in enumerate(les)],
                  F.struct(F.lit(float("inf")).alias("le"), F.col("_binf").alias("cum_count")))
    return wide.select("window_start", "window_end", "latency_sum", "latency_count", F.inline(arr))


def histogram_quantile(buckets: DataFrame, q: float = 0.95, keys: tuple[str, ...] = ("window_start", "window_end"),
                       out: str = "latency_q") -> DataFrame:
    """Quantile from cumulative buckets by linear interpolation inside the bucket holding rank
    ``q * total`` (lower bound 0 for the first bucket; the +Inf bucket returns the highest finite
    bound; no observations -> NULL). Works on the <= 15 buckets of each window only."""
    b = buckets.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("le", "cum_count"))).alias("bk"))
    total = F.element_at(F.col("bk"), -1).getField("cum_count")
    rank = F.lit(float(q)) * total
    idx = F.array_position(F.transform("bk", lambda x: x.getField("cum_count") >= rank), True)
    hit = F.element_at("bk", idx.cast("int"))
    prev = F.when(idx > 1, F.element_at("bk", (idx - 1).cast("int"))).otherwise(
        F.struct(F.lit(0.0).alias("le"), F.lit(0).cast("bigint").alias("cum_count")))
    finite_max = F.element_at(F.col("bk"), -2).getField("le")
    lower, upper = prev.getField("le"), hit.getField("le")
    c_lo, c_hi = prev.getField("cum_count"), hit.getField("cum_count")
    interp = lower + (upper - lower) * F.try_divide(rank - c_lo, c_hi - c_lo)
    val = (F.when(total == 0, F.lit(None).cast("double"))
            .when(F.isnan(upper) | (upper == float("inf")), finite_max)
            .otherwise(F.coalesce(interp, upper)))
    return b.select(*keys, val.alias(out))


def request_rate(df: DataFrame, ts="ts", width="5 minutes", slide="1 minute") -> DataFrame:
    """Per-second rate over the window."""
    secs = _seconds(width)
    return window_agg(df, [(F.count(F.lit(1)) / F.lit(float(secs))).alias("rate_per_s")], ts, width, slide)


def counter_increase(df: DataFrame, counter: str, keys: list[str], ts="ts", width="5 minutes", slide="1 minute",
                     out: str = "increase", largest: dict[str, str] | None = None) -> DataFrame:
    """Increase of a cumulative counter per key and window: the sum of the steps between neighbouring
    samples in the window; after a reset (a smaller value) the step is the new value.

    Samples are reduced to panes first (at most the samples of one key in one slide are ordered
    together), so a window adds up at most ``width / slide`` pane rows and the steps between them. ``largest`` (name: column)
    adds the largest values of other columns, from the same panes.
    """
    extra = largest or {}
    step = lambda before, now: F.when(now < before, now).otherwise(now - before)
    pane = F.window(F.col(ts), slide, slide).getField("start")
    d = df.where(F.col(counter).isNotNull() & F.col(ts).isNotNull()) \
          .select(*keys, F.col(ts).alias("_t"), F.col(counter).cast("double").alias("_x"), pane.alias("_pane"),
                  *[F.col(c).alias(f"_m_{n}") for n, c in extra.items()])
    inside = Window.partitionBy(*keys, "_pane").orderBy("_t", "_x")
    d = d.withColumn("_step", step(F.lag("_x").over(inside), F.col("_x")))
    at = F.struct("_t", "_x")
    panes = d.groupBy(*keys, "_pane").agg(F.coalesce(F.sum("_step"), F.lit(0.0)).alias("_within"),
                                          F.min(at).alias("_first"), F.max(at).alias("_last"),
                                          *[F.max(f"_m_{n}").alias(n) for n in extra])
    along = Window.partitionBy(*keys).orderBy("_pane")  # one row per pane of a key
    panes = panes.select(*keys, "_pane", "_within", *extra, F.lag("_pane").over(along).alias("_before"),
                         step(F.lag("_last").over(along)["_x"], F.col("_first")["_x"]).alias("_across"))
    w = in_windows(panes, "_pane", width, slide)
    both = F.col("_within") + F.when(F.col("_before") >= F.col("window_start"), F.col("_across")).otherwise(F.lit(0.0))
    return w.groupBy("window_start", "window_end", *keys).agg(F.sum(both).alias(out), *[F.max(n).alias(n) for n in extra])


def cpu_percent(df: DataFrame, usage: str = "cpu_seconds", limit: str = "cpu_limit", pod: str = "pod", ts="ts",
                width="5 minutes", slide="1 minute") -> DataFrame:
    """``sum(rate(usage)) / sum(limit) * 100``: the increase of each pod's cumulative counter per
    second over the summed limits of the pods seen in the window."""
    secs = float(_seconds(width))
    both = counter_increase(df, usage, [pod], ts, width, slide, "_u", {"_l": limit})
    per_win = both.groupBy("window_start", "window_end").agg(F.sum("_u").alias("_u"), F.sum("_l").alias("_l"))
    return per_win.select("window_start", "window_end", (F.try_divide(F.col("_u") / secs, F.col("_l")) * 100).alias("cpu_pct"))


def active_sources(df: DataFrame, source: str = "source", ts="ts", width="5 minutes", slide="1 minute",
                   approx: bool = False) -> DataFrame:
    """Distinct live sources per window (approximate sketch for streams)."""
    agg = F.approx_count_distinct(source) if approx else F.count_distinct(F.col(source))
    return window_agg(df, [agg.alias("active_sources")], ts, width, slide)


def threshold_alerts(series: DataFrame, metric: str, value: str, threshold: float, slide: str = "1 minute",
                     above: bool = True) -> DataFrame:
    """Alert transitions of one windowed metric: ``firing`` when the condition starts to hold,
    ``resolved`` (one slide after the last firing window) when it stops. A window with no data
    counts as not firing.

    One pass over the series: every window emits itself and a copy shifted one slide forward (its
    role as "previous window"); a single aggregation per window start then sees the current and
    the previous state together -- no self-joins, so the series is computed once.
    """
    cond = (F.col(value) > threshold) if above else (F.col(value) < threshold)
    cur = series.select("window_start", F.col(value).alias("value"), F.coalesce(cond, F.lit(False)).alias("firing"))
    both = cur.select(F.explode(F.array(
        F.struct(F.col("window_start").alias("ws"), F.lit(True).alias("is_cur"), "firing", "value"),
        F.struct((F.col("window_start") + F.expr(f"interval {slide}")).alias("ws"), F.lit(False).alias("is_cur"),
                 "firing", "value"))).alias("e")).select("e.*")
    g = both.groupBy("ws").agg(
        F.coalesce(F.max(F.when(F.col("is_cur"), F.col("firing"))), F.lit(False)).alias("now"),
        F.coalesce(F.max(F.when(~F.col("is_cur"), F.col("firing"))), F.lit(False)).alias("before"),
        F.max(F.when(F.col("is_cur"), F.col("value"))).alias("v_now"),
        F.max(F.when(~F.col("is_cur"), F.col("value"))).alias("v_before"))
    out = g.where(F.col("now") != F.col("before")).select(
        F.col("ws").alias("window_start"),
        F.when(F.col("now"), F.lit("firing")).otherwise(F.lit("resolved")).alias("state"),
        F.when(F.col("now"), F.col("v_now")).otherwise(F.col("v_before")).alias("value"))
    return out.select(F.lit(metric).alias("metric"), "window_start", "state", "value")


ALERT_SCHEMA = "title string, message string, state string"


def normalise_alert(df: DataFrame, value: str = "value") -> DataFrame:
    """Flatten an alert payload with defaults for absent fields."""
    a = F.from_json(F.col(value), ALERT_SCHEMA)
    return df.select(*[c for c in df.columns if c != value],
                     F.coalesce(a.getField("title"), F.lit("No title")).alias("title"),
                     F.coalesce(a.getField("message"), F.lit("No message")).alias("message"),
                     F.coalesce(a.getField("state"), F.lit("No state")).alias("state"))
