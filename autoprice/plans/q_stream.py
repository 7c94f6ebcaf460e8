"""Catalogue entries: Structured Streaming (S5, S6, F7, W1, K5, D2, W12, J9, streaming W2 / J10).

Streaming keys read the driver tables themselves as a file stream (``pathGlobFilter`` on the table
file), apply the fixture view SQL to the *streaming* DataFrame, drain it with ``availableNow`` into a
memory or file sink and return the sink's contents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from autoprice.plans.fixtures import VIEWS, table, view, with_views
from autoprice.plans.registry import AS_OF_YEAR, register
from autoprice.session import scratch_dir
from autoprice.streaming import monitor as SM
from autoprice.streaming import scoring as SC
from autoprice.streaming import stateful as ST


def _stream_table(spark, sf_dir, name):
    """A file stream over a table that is one file or a folder of files. The bounded input is drained as one
    micro-batch, so no event is late and the result does not depend on how the table is split."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/{name}.parque[t]")


def _stream_view(spark, sf_dir, name, deps=("cars_raw",)):
    """The named fixture view computed over a stream of its base table."""
    _stream_table(spark, sf_dir, "orders").createOrReplaceTempView("_orders_stream")
    for d in deps:
        spark.sql(VIEWS[d].replace("from orders", "from _orders_stream")).createOrReplaceTempView(f"_{d}_stream")
    body = VIEWS[name].replace("from cars_raw", "from _cars_raw_stream").replace("from orders", "from _orders_stream")
    return spark.sql(body)


def _name(prefix):
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


@register("stream_json_source", with_views("select car_id, value from requests", "requests"))
def q_stream_source(spark, sf_dir):
    """A topic of JSON text lines, read through ``stream_source`` and decoded record by record."""
    topic = scratch_dir(spark, "topic")
    view(spark, sf_dir, "requests").select(F.to_json(F.struct("car_id", "value")).alias("value")).write.mode("append").text(topic)
    lines = SC.stream_source(spark, "text", path=topic)
    s = lines.select(F.from_json("value", "car_id bigint, value string").alias("r")).select("r.car_id", "r.value")
    return SC.run_to_table(s, _name("requests"), scratch_dir(spark, "ckpt-src"))


_PARSE = """
, p as (select car_id, value, json_valid(value) as v from requests),
t as (select car_id, value,
  case when v then try_cast(json_extract(value, '$.Year') as integer) end as Year,
  case when v then try_cast(json_extract(value, '$.Present_Price') as double) end as Present_Price,
  case when v then try_cast(json_extract(value, '$.Kms_Driven') as integer) end as Kms_Driven,
  case when v then try_cast(json_extract(value, '$.Owner') as integer) end as Owner,
  case when v then try_cast(json_extract(value, '$.Car_Age') as integer) end as Car_Age,
  case when v then try_cast(json_extract(value, '$.Kms_Per_Year') as double) end as Kms_Per_Year,
  case when v then json_extract_string(value, '$.Fuel_Type') end as Fuel_Type,
  case when v then json_extract_string(value, '$.Seller_Type') end as Seller_Type,
  case when v then json_extract_string(value, '$.Transmission') end as Transmission from p),
ps as (select *, case when Year is not null and Present_Price is not null and Kms_Driven is not null and Owner is not null
  and Car_Age is not null and Kms_Per_Year is not null and Fuel_Type is not null and Seller_Type is not null
  and Transmission is not null then 'ok' else 'rejected' end as status from t)"""

_FIELDS = ", ".join(SC.REQUEST_NAMES)


@register("parse_request", with_views(_PARSE + f"\nselect car_id, {_FIELDS}, status from ps", "requests"))
def q_parse_request(spark, sf_dir):
    return SC.parse_request(view(spark, sf_dir, "requests")).drop("value")


_SCORED = _PARSE + f""",
sc as (select car_id, to_json({{'car_data': {{{", ".join(f"'{n}': {n}" for n in SC.REQUEST_NAMES)}}},
  'predicted_price': floor((Present_Price * 0.6 + Owner * 0.1 - Car_Age * 0.05) * 100) / 100}}) as value
  from ps where status = 'ok')"""


@register("stream_score", with_views(_SCORED + "\nselect ps.car_id, ps.status, sc.value from ps left join sc using (car_id)", "requests"))
def q_stream_score(spark, sf_dir):
    s = _stream_view(spark, sf_dir, "requests")
    out = SC.score_stream(s, SC.formula_price_model(spark)).select("car_id", "status", "value")
    return SC.run_to_table(out, _name("scored"), scratch_dir(spark, "ckpt-score"))


@register("stream_json_sink", with_views(_SCORED + "\nselect car_id, value from sc", "requests"))
def q_stream_sink(spark, sf_dir):
    s = _stream_view(spark, sf_dir, "requests")
    out = SC.score_stream(s, SC.formula_price_model(spark)).where("status = 'ok'").select("car_id", "value")
    path = scratch_dir(spark, "sink-json")
    q = SC.write_stream(out, "json", scratch_dir(spark, "ckpt-sink"), available_now=True, path=path)
    SC.drain(q)
    return spark.read.schema("car_id bigint, value string").json(path)


@register("route_failures", with_views(_PARSE + "\nselect status, count(*) as n from ps group by status", "requests"))
def q_route_failures(spark, sf_dir):
    s = SC.parse_request(_stream_view(spark, sf_dir, "requests"))
    good, dead = scratch_dir(spark, "good"), scratch_dir(spark, "dead")
    q = (s.writeStream.foreachBatch(SC.route_batches(good, dead))
         .option("checkpointLocation", scratch_dir(spark, "ckpt-route")).trigger(availableNow=True).start())
    SC.drain(q)
    g = spark.read.parquet(good).select("status")
    d = spark.read.parquet(dead).select("status")  # epoch partitions are read back as one table
    return g.unionByName(d).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@register("stream_score_cars", with_views(_SCORED + "\nselect car_id, value from sc", "requests"))
def q_stream_score_cars(spark, sf_dir):
    """Source -> parse/validate -> model -> route (good / dead letter) -> JSON sink."""
    s = _stream_view(spark, sf_dir, "requests")
    parsed = SC.parse_request(s)
    model = SC.formula_price_model(spark)
    good, dead = scratch_dir(spark, "good"), scratch_dir(spark, "dead")

    def publish(ok):
        scored = model.transform(ok).withColumnRenamed("prediction", "predicted_price")
        return SC.nest_prediction_json(scored).select("car_id", "value")
    q = parsed.writeStream.foreachBatch(SC.route_batches(good, dead, "json", publish)) \
              .option("checkpointLocation", scratch_dir(spark, "ckpt-j9")).trigger(availableNow=True).start()
    SC.drain(q)
    return spark.read.schema("car_id bigint, value string").json(good).select("car_id", "value")


@register("stream_score_fitted", with_views(_PARSE + "\nselect car_id, status, status = 'ok' as scored, true as equals_batch from ps", "requests"))
def q_stream_score_fitted(spark, sf_dir):
    """J9 with a fitted pipeline: trained on the cleaned cars, saved and loaded as the scoring service would,
    then applied to the stream; malformed and incomplete requests go to the dead-letter table. Predictions
    must equal those of the same model over the batch table."""
    from autoprice.operators import clean as C
    from autoprice.operators import models as MD
    from autoprice.plans.jobs import fit_price
    clean = C.clean_cars_mean(view(spark, sf_dir, "cars_raw"), as_of_year=AS_OF_YEAR)
    model = MD.load_model(MD.save_model(fit_price(clean, trees=10, depth=6), scratch_dir(spark, "model") + "/price"))
    names = {n: n.lower() for n in SC.REQUEST_NAMES}
    good, dead = scratch_dir(spark, "good"), scratch_dir(spark, "dead")
    parsed = SC.parse_request(_stream_view(spark, sf_dir, "requests"))
    publish = lambda ok: SC.score_requests(ok, model, rename=names).select("car_id", "status", "predicted_price")
    SC.drain(parsed.writeStream.foreachBatch(SC.route_batches(good, dead, transform=publish))
             .option("checkpointLocation", scratch_dir(spark, "ckpt-fitted")).trigger(availableNow=True).start())
    batch = SC.score_stream(view(spark, sf_dir, "requests"), model, rename=names).select("car_id", F.col("predicted_price").alias("p"))
    sunk = spark.read.parquet(good).select("car_id", "status", "predicted_price").unionByName(
        spark.read.parquet(dead).select("car_id", "status", F.lit(None).cast("double").alias("predicted_price")))
    return sunk.join(batch, "car_id").select("car_id", "status", F.col("predicted_price").isNotNull().alias("scored"),
                                             F.col("predicted_price").eqNullSafe(F.col("p")).alias("equals_batch"))


@register("dedupe_stream", "select event_id, event_type, value from events")
def q_dedupe_stream(spark, sf_dir):
    src = scratch_dir(spark, "redelivered")
    ev = table(spark, sf_dir, "events")
    ev.write.mode("overwrite").parquet(src + "/a")      # first delivery
    ev.write.mode("overwrite").parquet(src + "/b")      # redelivery of every message
    s = spark.readStream.schema(ev.schema).option("recursiveFileLookup", True).parquet(src)
    d = SC.dedupe_stream(s, "event_id", "ts", "10 minutes").select("event_id", "event_type", "value")
    return SC.run_to_table(d, _name("dedup"), scratch_dir(spark, "ckpt-dedup"))


@register("request_count_stream", with_views("""
, w0 as (select *, unnest(range(5)) as _i from pred_log),
w as (select *, time_bucket(interval '1 minutes', ts) - to_minutes(_i * 1) as window_start from w0)
select window_start, window_start + interval '5 minutes' as window_end, count(*) as requests from w
group by window_start""", "pred_log"))
def q_request_count_stream(spark, sf_dir):
    _stream_table(spark, sf_dir, "events").createOrReplaceTempView("_events_stream")
    log = spark.sql(VIEWS["pred_log"].replace("from events", "from _events_stream"))
    out = SM.stream_request_counts(log, "ts", "5 minutes", "1 minute", delay=None)
    return SC.run_to_table(out, _name("reqcount"), scratch_dir(spark, "ckpt-w2"), mode="complete")


@register("late_data", with_views("""
, w0 as (select *, unnest(range(5)) as _i from pred_log),
w as (select *, time_bucket(interval '1 minutes', ts) - to_minutes(_i * 1) as window_start from w0),
c as (select window_start, window_start + interval '5 minutes' as window_end, count(*) as requests from w
      group by window_start)
select * from c where window_end <= (select max(ts) from pred_log) - interval '10 minutes'""", "pred_log"))
def q_late_data(spark, sf_dir):
    """Append mode finalises a window once the watermark (max event time - 10 minutes) passes
    its end; with the whole table as one batch no event is late, so exactly the windows ending at
    or before the final watermark are emitted."""
    _stream_table(spark, sf_dir, "events").createOrReplaceTempView("_events_stream")
    log = spark.sql(VIEWS["pred_log"].replace("from events", "from _events_stream"))
    out = SM.stream_request_counts(log, "ts", "5 minutes", "1 minute", delay="10 minutes")
    t = SC.run_to_table(out, _name("late"), scratch_dir(spark, "ckpt-w12"), mode="append")
    # back to wall-clock (NTZ) time, the type of the input event times
    return t.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                    F.col("window_end").cast("timestamp_ntz").alias("window_end"), "requests")


@register("stream_health", with_views("""
, w0 as (select *, unnest(range(5)) as _i from pred_log),
w as (select *, time_bucket(interval '1 minutes', ts) - to_minutes(_i * 1) as window_start from w0),
c as (select window_start, window_start + interval '5 minutes' as window_end, count(*) as requests,
        cast(count_if(not ok) as bigint) as errors, case when count_if(not ok) >= 1 then 'red' else 'green' end as status,
        round(count(*) / 300.0, 6) as rate_per_s, min(latency_s) as lo, max(latency_s) as hi from w group by window_start)
select window_start, window_end, requests, errors, status, rate_per_s, true as p95_in_range
from c where window_end <= (select max(ts) from pred_log) - interval '10 minutes'""", "pred_log"))
def q_stream_health(spark, sf_dir):
    """J10 on a stream. The p95 is a sketch there; the check holds it to the window's range of latencies."""
    _stream_table(spark, sf_dir, "events").createOrReplaceTempView("_events_stream")
    log = spark.sql(VIEWS["pred_log"].replace("from events", "from _events_stream"))
    out = SM.stream_health(log, "ts", "5 minutes", "1 minute", "10 minutes")
    t = SC.run_to_table(out, _name("health"), scratch_dir(spark, "ckpt-health"), mode="append")
    return t.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                    F.col("window_end").cast("timestamp_ntz").alias("window_end"), "requests", "errors", "status",
                    F.round("rate_per_s", 6).alias("rate_per_s"),
                    F.col("latency_p95").between(F.col("latency_min"), F.col("latency_max")).alias("p95_in_range"))


# ------------------------------------------------------------------ stateful operators over several deliveries

DELIVERIES = 3


def _deliver(spark, df, name, part, run):
    """Write ``df`` in deliveries (``part``: a row's delivery, 0 to DELIVERIES - 1) and call ``run(folder)`` after each: the query resumes
    from its checkpoint, so every delivery is a micro-batch of its own. Returns the last result."""
    folder, out = scratch_dir(spark, name), None
    for k in range(DELIVERIES):
        df.where(part == k).write.parquet(f"{folder}/delivery={k}")
        out = run(folder)
    return out


def _by_time(log):
    """The third of the log's time range that a row lies in."""
    lo, hi = log.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))), F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    return F.least(F.floor((at - F.lit(lo)) * DELIVERIES / F.lit(max(hi - lo, 1))), F.lit(DELIVERIES - 1))


def _ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


_HOUR_WINDOWS = """
, w0 as (select *, unnest(range(2)) as _i from pred_log),
w as (select *, time_bucket(interval '30 minutes', ts) - to_minutes(_i * 30) as window_start from w0),
e as (select window_start, cast(count_if(not ok) as double) as errors, cast(count(*) as double) as requests from w group by window_start)"""
_LIMITS = {"errors": 4.0, "requests": 30.0}


def _transitions_sql(metric: str, threshold: float) -> str:
    """Alert transitions of one metric over the half-hourly windows ``e``."""
    cur = f"(select window_start, {metric} as value from e where {metric} > {threshold!r})"
    return f"""select '{metric}' as metric, c.window_start, 'firing' as state, c.value from {cur} c
  where not exists (select 1 from {cur} p where p.window_start = c.window_start - interval '30 minutes')
union all select '{metric}', c.window_start + interval '30 minutes', 'resolved', c.value from {cur} c
  where not exists (select 1 from {cur} n where n.window_start = c.window_start + interval '30 minutes')"""


@register("stream_alerts", with_views(_HOUR_WINDOWS + f"""
, t as ({" union all ".join(_transitions_sql(m, v) for m, v in _LIMITS.items())})
select metric, window_start, state, value from t
where window_start + interval '60 minutes' <= (select max(ts) from pred_log) - interval '10 minutes'""", "pred_log"))
def q_stream_alerts(spark, sf_dir):
    """W10 on a stream (J10): transitions of two metrics of the prediction log, delivered in three parts to a query that resumes."""
    log = view(spark, sf_dir, "pred_log")
    checkpoint, path = scratch_dir(spark, "ckpt-alerts"), scratch_dir(spark, "alerts")

    def run(folder):
        s = spark.readStream.schema(log.schema).parquet(f"{folder}/delivery=*")
        with ST.rocksdb_state(spark):
            out = ST.alert_stream(ST.alert_series(s, "60 minutes", "30 minutes", "10 minutes"), _LIMITS, "60 minutes", "30 minutes")
            return SC.run_to_table(out, _name("alerts"), checkpoint, path=path)
    return _ntz(_deliver(spark, log, "alert-log", _by_time(log), run), "window_start")


@register("stream_health_p95", with_views("""
, w0 as (select *, unnest(range(5)) as _i from pred_log),
w as (select *, time_bucket(interval '1 minutes', ts) - to_minutes(_i * 1) as window_start from w0),
c as (select window_start, window_start + interval '5 minutes' as window_end, count(*) as requests,
        cast(count_if(not ok) as bigint) as errors, case when count_if(not ok) >= 1 then 'red' else 'green' end as status,
        round(count(*) / 300.0, 6) as rate_per_s, round(quantile_cont(latency_s, 0.95), 6) as exact_p95 from w group by window_start)
select *, true as p95_within_bound from c where window_end <= (select max(ts) from pred_log) - interval '10 minutes'""", "pred_log"))
def q_stream_health_p95(spark, sf_dir):
    """J10 on a stream with its p95: panes of one minute are sketched on the stream, delivered in three parts, and merged into windows; each
    window's p95 is held to its stated error against the exact one of the batch log."""
    from autoprice.operators import monitor as MO
    from autoprice.operators import sketch as SK
    log = view(spark, sf_dir, "pred_log")
    checkpoint, path = scratch_dir(spark, "ckpt-panes"), scratch_dir(spark, "panes")

    def run(folder):
        s = spark.readStream.schema(log.schema).parquet(f"{folder}/delivery=*")
        return SC.run_to_table(ST.health_panes(s, "1 minute", "10 minutes"), _name("panes"), checkpoint, path=path)
    panes = _deliver(spark, log, "health-log", _by_time(log), run)
    last = log.agg(F.max("ts")).scalar() - F.expr("interval 10 minutes")
    w = _ntz(ST.health_windows(panes, "5 minutes", "1 minute"), "window_start", "window_end").where(F.col("window_end") <= last)
    exact = MO.latency_quantile(log, "latency_s", 0.95, "ts", "5 minutes", "1 minute", "exact_p95")
    both = w.join(exact, ["window_start", "window_end"])
    close = F.abs(F.col("latency_p95") - F.col("exact_p95")) <= SK.ALPHA * F.abs(F.col("exact_p95")) + 1e-12
    return both.select("window_start", "window_end", "requests", "errors", "status", F.round("rate_per_s", 6).alias("rate_per_s"),
                       F.round("exact_p95", 6).alias("exact_p95"), close.alias("p95_within_bound"))


@register("stream_health_rows")
def q_stream_health_rows(spark, sf_dir):
    """J10 on a stream, all its columns (the sketched p95 included; ``stream_health_p95`` holds it to its bound)."""
    _stream_table(spark, sf_dir, "events").createOrReplaceTempView("_events_stream")
    log = spark.sql(VIEWS["pred_log"].replace("from events", "from _events_stream"))
    panes = SC.run_to_table(ST.health_panes(log, "1 minute", "10 minutes"), _name("health_rows"), scratch_dir(spark, "ckpt-health-rows"))
    return _ntz(ST.health_windows(panes, "5 minutes", "1 minute"), "window_start", "window_end")


@register("stream_cpu_pct", with_views("""
, s as (select pod, ts, cpu_seconds as x, cpu_limit, lag(cpu_seconds) over o as px, lag(ts) over o as pt,
          time_bucket(interval '30 minutes', ts) as pane from cpu_samples window o as (partition by pod order by ts, cpu_seconds)),
st as (select pod, pane, cpu_limit, time_bucket(interval '30 minutes', pt) as before,
         case when px is null then 0.0 when x < px then x else x - px end as step from s),
w0 as (select *, unnest(range(2)) as _i from st), w as (select *, pane - to_minutes(_i * 30) as window_start from w0),
p as (select window_start, pod, sum(case when before >= window_start then step else 0.0 end) as u, max(cpu_limit) as l from w group by all)
select window_start, window_start + interval '60 minutes' as window_end, round(sum(u) / 3600.0 / sum(l) * 100, 6) as cpu_pct from p group by window_start""",
    "cpu_samples"))
def q_stream_cpu_pct(spark, sf_dir):
    """W8 on a stream: cumulative counters of all pods, delivered in three parts; the last sample of each pod is kept between them."""
    samples = view(spark, sf_dir, "cpu_samples")
    checkpoint, path = scratch_dir(spark, "ckpt-cpu"), scratch_dir(spark, "cpu")

    def run(folder):
        s = spark.readStream.schema(samples.schema).parquet(f"{folder}/delivery=*")
        with ST.rocksdb_state(spark):
            return SC.run_to_table(ST.counter_stream(s, "cpu_seconds", "pod", "30 minutes", "cpu_limit"), _name("cpu"), checkpoint, path=path)
    steps = _deliver(spark, samples, "cpu-log", _by_time(samples), run)
    w = ST.counter_windows(steps, "60 minutes", "30 minutes")
    out = w.groupBy("window_start", "window_end").agg(F.round(F.sum("increase") / 3600.0 / F.sum("limit") * 100, 6).alias("cpu_pct"))
    return _ntz(out, "window_start", "window_end")


def _topic_in_parts(spark, requests, path, run):
    """The requests appended to a topic in three appends, with ``run()`` after each."""
    from autoprice.sources import topic as TP
    out = None
    for k in range(DELIVERIES):
        TP.append(requests.where(F.col("car_id") % DELIVERIES == k), path, "car_id", "value", ["car_id"])
        out = run()
    return out


@register("topic_source", with_views(f"""
, p as (select cast(car_id as varchar) as key, value, car_id % {DELIVERIES} as append from requests)
select key, value, append, true as in_order from p""", "requests"))
def q_topic_source(spark, sf_dir):
    """A topic with offsets per partition, read by a query that is started anew after each of three appends. Every record arrives
    once; offsets are whole numbers from 0 without gaps, in the order of the appends and of the ids in each of them."""
    from pyspark.sql import Window
    path, checkpoint, out = scratch_dir(spark, "topic"), scratch_dir(spark, "ckpt-topic"), scratch_dir(spark, "topic-out")

    def run():
        s = SC.stream_source(spark, "topic", {"group": "scorer"}, path=path).select("partition", "offset", "key", "value")
        return SC.run_to_table(s, _name("topic"), checkpoint, path=out)
    got = _topic_in_parts(spark, view(spark, sf_dir, "requests"), path, run)
    got = got.withColumn("append", F.col("key").cast("bigint") % DELIVERIES)
    # the neighbour in offset order, joined: no partition of the topic is gathered in one task
    before = got.select("partition", (F.col("offset") + 1).alias("offset"), F.struct("append", F.col("key").cast("bigint").alias("id")).alias("before"))
    j = got.join(before, ["partition", "offset"], "left")
    ok = F.when(F.col("offset") == 0, F.lit(True)).otherwise(F.coalesce(F.col("before") < F.struct("append", F.col("key").cast("bigint").alias("id")), F.lit(False)))
    return j.select("key", "value", "append", ok.alias("in_order"))


@register("stream_score_topic", with_views(_SCORED + "\nselect ps.car_id, ps.status, sc.value from ps left join sc using (car_id)", "requests"))
def q_stream_score_topic(spark, sf_dir):
    """J9 from the topic: source -> parse and validate -> model -> JSON, resumed after each of three appends."""
    path, checkpoint, out = scratch_dir(spark, "topic"), scratch_dir(spark, "ckpt-j9-topic"), scratch_dir(spark, "j9-out")
    model = SC.formula_price_model(spark)

    def run():
        s = SC.stream_source(spark, "topic", path=path).select(F.col("key").cast("bigint").alias("car_id"), "value")
        return SC.run_to_table(SC.score_stream(s, model).select("car_id", "status", "value"), _name("j9"), checkpoint, path=out)
    return _topic_in_parts(spark, view(spark, sf_dir, "requests"), path, run)


@register("late_rows", with_views(f"""
, d as (select *, case when event_id % 7 = 3 then {DELIVERIES - 1} else least(cast(floor((epoch_us(ts) - lo) * {DELIVERIES} / greatest(hi - lo, 1)) as bigint), {DELIVERIES - 1}) end as part
  from pred_log, (select min(epoch_us(ts)) as lo, max(epoch_us(ts)) as hi from pred_log)),
m as (select part, max(ts) as latest from d group by part),
k as (select d.event_id, d.ts, (select max(latest) from m where m.part < d.part) - interval '10 minutes' as watermark from d)
select event_id, case when ts < watermark then 'late' else 'on time' end as arrived, case when ts < watermark then watermark end as watermark from k""", "pred_log"))
def q_late_rows(spark, sf_dir):
    """W12 with a side output: a seventh of the log arrives with the last delivery, most of it late. Rows in = rows on time + rows late."""
    log = view(spark, sf_dir, "pred_log")
    base, checkpoint = scratch_dir(spark, "late-rows"), scratch_dir(spark, "ckpt-late")

    def run(folder):
        s = spark.readStream.schema(log.schema).parquet(f"{folder}/delivery=*")
        SC.drain(ST.split_late(s, f"{base}/on-time", f"{base}/late", checkpoint))
    part = F.when(F.col("event_id") % 7 == 3, DELIVERIES - 1).otherwise(_by_time(log))
    _deliver(spark, log, "late-log", part, run)
    on_time = spark.read.parquet(f"{base}/on-time").select("event_id", F.lit("on time").alias("arrived"), F.lit(None).cast("timestamp").alias("watermark"))
    late = spark.read.parquet(f"{base}/late").select("event_id", F.lit("late").alias("arrived"), "watermark")
    return _ntz(on_time.unionByName(late), "watermark")


@register("late_safe_dedupe", "select event_id, event_type, value from events")
def q_late_safe_dedupe(spark, sf_dir):
    """D2 behind the side output: every message comes twice, and a seventh of them last. What is late is de-duplicated against what the
    stream has kept, so each message remains once."""
    ev = table(spark, sf_dir, "events")
    base, checkpoint, dedup = scratch_dir(spark, "late-dedup"), scratch_dir(spark, "ckpt-split"), scratch_dir(spark, "ckpt-dedup")
    path = scratch_dir(spark, "dedup")

    def run(folder):
        s = spark.readStream.schema(ev.schema).parquet(f"{folder}/delivery=*")
        SC.drain(ST.split_late(s, f"{base}/on-time", f"{base}/late", checkpoint))
        on_time = spark.readStream.schema(spark.read.parquet(f"{base}/on-time").schema).parquet(f"{base}/on-time")
        return SC.run_to_table(SC.dedupe_stream(on_time, "event_id", "ts", "10 minutes").select("event_id", "event_type", "value"), _name("dedup"), dedup, path=path)
    part = F.when(F.col("event_id") % 7 == 3, DELIVERIES - 1).otherwise(_by_time(ev))
    kept = _deliver(spark, ev.unionAll(ev), "late-events", part, run)
    late = spark.read.parquet(f"{base}/late").select("event_id", "event_type", "value").dropDuplicates(["event_id"])
    return kept.unionByName(late.join(kept.select("event_id"), "event_id", "left_anti"))
