"""Catalogue entries: monitoring windows and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from autoprice.operators import monitor as MO
from autoprice.plans.fixtures import view, with_views
from autoprice.plans.registry import register

R6 = lambda c: F.round(F.col(c), 6).alias(c)

# The dashboards' 5-minute ranges step every minute; quantile and histogram panels use hour-wide
# windows every 30 minutes so each window holds enough requests to be meaningful.
FIVE, ONE = "5 minutes", "1 minute"
HOUR, HALF = "1 hour", "30 minutes"


def win_sql(src: str, width_min: int, slide_min: int, name: str = "w") -> str:
    k = width_min // slide_min
    return f"""{name}0 as (select *, unnest(range({k})) as _i from {src}),
{name} as (select *, time_bucket(interval '{slide_min} minutes', ts) - to_minutes(_i * {slide_min}) as window_start,
  time_bucket(interval '{slide_min} minutes', ts) - to_minutes(_i * {slide_min}) + interval '{width_min} minutes' as window_end
  from {name}0)"""


@register("request_count_5m", with_views(f"""
, {win_sql('pred_log', 5, 1)}
select window_start, window_end, count(*) as requests from w group by window_start, window_end""", "pred_log"))
def q_request_count(spark, sf_dir):
    return MO.request_count(view(spark, sf_dir, "pred_log"), "ts", FIVE, ONE)


@register("error_count_5m", with_views(f"""
, {win_sql('pred_log', 5, 1)}
select window_start, window_end, cast(count_if(not ok) as bigint) as errors,
  case when count_if(not ok) >= 1 then 'red' else 'green' end as status from w group by window_start, window_end""",
    "pred_log"))
def q_error_count(spark, sf_dir):
    return MO.error_count(view(spark, sf_dir, "pred_log"), "ok", "ts", FIVE, ONE)


@register("latency_p95", with_views(f"""
, {win_sql('pred_log', 60, 30)}
select window_start, window_end, round(quantile_cont(latency_s, 0.95), 6) as latency_p95
from w group by window_start, window_end""", "pred_log"))
def q_latency_p95(spark, sf_dir):
    d = MO.latency_quantile(view(spark, sf_dir, "pred_log"), "latency_s", 0.95, "ts", HOUR, HALF)
    return d.select("window_start", "window_end", R6("latency_p95"))


@register("latency_p95_5m", with_views(f"""
, {win_sql('pred_log', 5, 1)}
select window_start, window_end, round(quantile_cont(latency_s, 0.95), 6) as latency_p95
from w group by window_start, window_end""", "pred_log"))
def q_latency_p95_5m(spark, sf_dir):
    d = MO.latency_quantile(view(spark, sf_dir, "pred_log"), "latency_s", 0.95, "ts", FIVE, ONE)
    return d.select("window_start", "window_end", R6("latency_p95"))


_LES = ", ".join(f"({b!r})" for b in MO.DEFAULT_BUCKETS) + ", ('inf'::double)"
_HIST = f"""
, {win_sql('pred_log', 60, 30)},
les as (select * from (values {_LES}) t(le)),
wl as (select w.*, unnest([{", ".join(repr(b) for b in MO.DEFAULT_BUCKETS)}, 'inf'::double]) as le from w),
b as (select window_start, window_end, le, cast(count_if(latency_s <= le) as bigint) as cum_count,
  sum(latency_s) as latency_sum, count(*) as latency_count from wl group by window_start, window_end, le)"""


@register("histogram_buckets", with_views(_HIST + """
select window_start, window_end, round(latency_sum, 6) as latency_sum, latency_count, le, cum_count from b""",
    "pred_log"))
def q_histogram_buckets(spark, sf_dir):
    d = MO.histogram_buckets(view(spark, sf_dir, "pred_log"), "latency_s", MO.DEFAULT_BUCKETS, "ts", HOUR, HALF)
    return d.select("window_start", "window_end", R6("latency_sum"), "latency_count", "le", "cum_count")


@register("histogram_quantile", with_views(_HIST + f""",
t as (select window_start, max(cum_count) filter (where le = 'inf'::double) as total from b group by window_start),
o as (select b.*, t.total, 0.95 * t.total as rk,
  coalesce(lag(le) over (partition by b.window_start order by le), 0.0) as prev_le,
  coalesce(lag(cum_count) over (partition by b.window_start order by le), 0) as prev_cum
  from b join t on b.window_start = t.window_start),
f as (select *, row_number() over (partition by window_start order by le) as rn from o where cum_count >= rk)
select window_start, window_end, round(case when total = 0 then null when le = 'inf'::double then {MO.DEFAULT_BUCKETS[-1]!r}
  else prev_le + (le - prev_le) * (rk - prev_cum) / (cum_count - prev_cum) end, 6) as latency_q from f where rn = 1""",
    "pred_log"))
def q_histogram_quantile(spark, sf_dir):
    b = MO.histogram_buckets(view(spark, sf_dir, "pred_log"), "latency_s", MO.DEFAULT_BUCKETS, "ts", HOUR, HALF)
    return MO.histogram_quantile(b, 0.95).select("window_start", "window_end", R6("latency_q"))


@register("rate_5m", with_views(f"""
, {win_sql('pred_log', 5, 1)}
select window_start, window_end, round(count(*) / 300.0, 6) as rate_per_s from w group by window_start, window_end""",
    "pred_log"))
def q_rate(spark, sf_dir):
    return MO.request_rate(view(spark, sf_dir, "pred_log"), "ts", FIVE, ONE).select(
        "window_start", "window_end", R6("rate_per_s"))


@register("cpu_pct", with_views(f"""
, {win_sql('cpu_samples', 5, 1)},
st as (select *, lag(cpu_seconds) over (partition by pod, window_start order by ts, cpu_seconds) as before from w),
pp as (select window_start, window_end, pod, max(cpu_limit) as l,
       sum(case when before is null then 0 when cpu_seconds < before then cpu_seconds else cpu_seconds - before end) as u
       from st group by window_start, window_end, pod)
select window_start, window_end, round(sum(u) / 300.0 / sum(l) * 100, 6) as cpu_pct from pp
group by window_start, window_end""", "cpu_samples"))
def q_cpu_pct(spark, sf_dir):
    d = MO.cpu_percent(view(spark, sf_dir, "cpu_samples"), "cpu_seconds", "cpu_limit", "pod", "ts", FIVE, ONE)
    return d.select("window_start", "window_end", R6("cpu_pct"))


@register("active_sources", with_views(f"""
, {win_sql('pred_log', 60, 30)}
select window_start, window_end, count(distinct source) as active_sources from w group by window_start, window_end""",
    "pred_log"))
def q_active_sources(spark, sf_dir):
    return MO.active_sources(view(spark, sf_dir, "pred_log"), "source", "ts", HOUR, HALF)


ERR_THRESHOLD = 4


@register("threshold_alerts", with_views(f"""
, {win_sql('pred_log', 60, 30)},
e as (select window_start, cast(count_if(not ok) as bigint) as errors from w group by window_start),
cur as (select window_start, errors as value, coalesce(errors > {ERR_THRESHOLD}, false) as firing from e),
s as (select c.window_start, 'firing' as state, c.value from cur c left join cur p
        on c.window_start = p.window_start + interval '30 minutes' where c.firing and not coalesce(p.firing, false)),
r as (select c.window_start + interval '30 minutes' as window_start, 'resolved' as state, c.value from cur c left join cur n
        on c.window_start = n.window_start - interval '30 minutes' where c.firing and not coalesce(n.firing, false))
select 'errors' as metric, window_start, state, value from s
union all select 'errors', window_start, state, value from r""", "pred_log"))
def q_threshold_alerts(spark, sf_dir):
    e = MO.error_count(view(spark, sf_dir, "pred_log"), "ok", "ts", HOUR, HALF)
    return MO.threshold_alerts(e, "errors", "errors", ERR_THRESHOLD, HALF)


@register("normalise_alert", with_views("""
select event_id, coalesce(json_extract_string(value, '$.title'), 'No title') as title,
  coalesce(json_extract_string(value, '$.message'), 'No message') as message,
  coalesce(json_extract_string(value, '$.state'), 'No state') as state from alerts""", "alerts"))
def q_normalise_alert(spark, sf_dir):
    return MO.normalise_alert(view(spark, sf_dir, "alerts"))


@register("monitor_predictions", with_views(f"""
, {win_sql('pred_log', 5, 1)}
select window_start, window_end, count(*) as requests, cast(count_if(not ok) as bigint) as errors,
  case when count_if(not ok) >= 1 then 'red' else 'green' end as status,
  round(quantile_cont(latency_s, 0.95), 6) as latency_p95, round(count(*) / 300.0, 6) as rate_per_s
from w group by window_start, window_end""", "pred_log"))
def q_monitor_predictions(spark, sf_dir):
    from autoprice.plans.jobs import monitor_predictions
    d = monitor_predictions(view(spark, sf_dir, "pred_log"), FIVE, ONE)
    return d.select("window_start", "window_end", "requests", "errors", "status", R6("latency_p95"), R6("rate_per_s"))


_ALERT_LIMITS = {"errors": 4.0, "requests": 30.0, "latency_p95": 0.9}


def _alert_sql(metric: str, threshold: float) -> str:
    cur = f"(select window_start, {metric} as value from e where {metric} > {threshold!r})"
    return f"""select '{metric}' as metric, c.window_start, 'firing' as state, round(c.value, 6) as value from {cur} c
  where not exists (select 1 from {cur} p where p.window_start = c.window_start - interval '30 minutes')
union all select '{metric}', c.window_start + interval '30 minutes', 'resolved', round(c.value, 6) from {cur} c
  where not exists (select 1 from {cur} n where n.window_start = c.window_start + interval '30 minutes')"""


@register("monitor_alerts", with_views(f"""
, {win_sql('pred_log', 60, 30)},
e as (select window_start, cast(count_if(not ok) as double) as errors, cast(count(*) as double) as requests,
  quantile_cont(latency_s, 0.95) as latency_p95 from w group by window_start)
{" union all ".join(_alert_sql(m, t) for m, t in _ALERT_LIMITS.items())}""", "pred_log"))
def q_monitor_alerts(spark, sf_dir):
    """The alerts of the dashboard's panels (errors, requests, p95 latency)."""
    from autoprice.plans.jobs import monitor_alerts
    d = monitor_alerts(view(spark, sf_dir, "pred_log"), _ALERT_LIMITS, HOUR, HALF)
    return d.select("metric", "window_start", "state", R6("value"))
