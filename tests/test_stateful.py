"""Stateful streaming operators over several micro-batches against their batch forms."""

import datetime as dt
import random

from pyspark.sql import functions as F

from autoprice.operators import monitor as MO
from autoprice.streaming import scoring as SC
from autoprice.streaming import stateful as ST

AT = lambda m, s=0: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m, seconds=s)


def _batches(spark, tmp_path, schema, parts, run):
    """Deliver each part as files and run the resuming query after each."""
    out = None
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/in/d={k}")
        out = run(spark.readStream.schema(schema).parquet(f"{tmp_path}/in/d=*"))
    return out


def test_alerts_equal_batch_form_over_micro_batches(spark, tmp_path):
    rng = random.Random(4)
    minutes = [m for m in range(0, 120) if not 30 <= m < 45 and not 80 <= m < 83]  # silence
    rows = [(AT(m, rng.randrange(60)), rng.random() > (.8 if m // 10 % 2 else .1)) for m in minutes for _ in range(4)]
    rows.sort()
    parts = [rows[:50], rows[50:130], rows[130:131], rows[131:300], rows[300:]]
    limits = {"errors": 3.0, "requests": 3.0}

    def run(s):
        with ST.rocksdb_state(spark):
            out = ST.alert_stream(ST.alert_series(s, "2 minutes", "1 minute", "1 minute"), limits, "2 minutes", "1 minute")
            return SC.run_to_table(out, "alerts_test", f"{tmp_path}/ck", path=f"{tmp_path}/out")
    got = _batches(spark, tmp_path, "ts timestamp, ok boolean", parts, run)
    log = spark.createDataFrame(rows, "ts timestamp, ok boolean")
    e = MO.window_agg(log, [F.count_if(~F.col("ok")).alias("errors"), F.count(F.lit(1)).alias("requests")], "ts", "2 minutes", "1 minute")
    want = None
    for m, t in limits.items():
        a = MO.threshold_alerts(e, m, m, t, "1 minute")
        want = a if want is None else want.unionByName(a)
    last = max(r[0] for r in rows) - dt.timedelta(minutes=1)
    want = sorted((r.metric, r.window_start, r.state, float(r.value)) for r in want.collect() if r.window_start + dt.timedelta(minutes=2) <= last)
    found = sorted((r.metric, r.window_start, r.state, r.value) for r in got.collect())
    assert found == want and {r[2] for r in found} == {"firing", "resolved"} and len(found) > 10
    # some alert was resolved by silence alone
    assert any(r[2] == "resolved" and r[0] == "requests" and r[1] == AT(30) for r in found)


def test_state_provider_is_put_back(spark):
    before = spark.conf.get(ST._PROVIDER)
    with ST.rocksdb_state(spark):
        assert "RocksDB" in spark.conf.get(ST._PROVIDER)
    assert spark.conf.get(ST._PROVIDER) == before


def test_counters_equal_batch_form_with_resets(spark, tmp_path):
    rng = random.Random(5)
    rows, x = [], {"p": 0.0, "q": 5.0}
    for k in range(200):
        pod = rng.choice("pq")
        x[pod] = 0.5 if rng.random() < .05 else x[pod] + rng.randrange(8)
        rows.append((pod, AT(k // 3 + (20 if k > 120 else 0), k % 3 * 17), x[pod], 2.0))
    schema = "pod string, ts timestamp, x double, lim double"

    def run(s):
        with ST.rocksdb_state(spark):
            return SC.run_to_table(ST.counter_stream(s, "x", "pod", "1 minute", "lim"), "counter_test", f"{tmp_path}/ck", path=f"{tmp_path}/out")
    steps = _batches(spark, tmp_path, schema, [rows[:61], rows[61:62], rows[62:150], rows[150:]], run)
    got = {(r.key, r.window_start): (r.increase, r.limit) for r in ST.counter_windows(steps, "3 minutes", "1 minute").collect()}
    want = MO.counter_increase(spark.createDataFrame(rows, schema), "x", ["pod"], "ts", "3 minutes", "1 minute")
    assert got == {(r.pod, r.window_start): (r.increase, 2.0) for r in want.collect()}


def test_counter_holds_numbers_not_rows():
    import tracemalloc

    import numpy as np
    import pandas as pd

    class Value:
        def __init__(self): self.v = None
        def exists(self): return self.v is not None
        def get(self): return self.v
        def update(self, v): self.v = v

    class Handle:
        def getValueState(self, *_): return Value()
    counter, n, size = ST._Counter(60_000), 400_000, 10_000
    counter.init(Handle())
    at = np.random.default_rng(2).permutation(n)

    def frames():
        for i in range(0, n, size):
            k = at[i:i + size]
            yield pd.DataFrame({"at_ms": k * 10, "x": k * 2.0, "limit": np.full(len(k), np.nan)})
    tracemalloc.start()
    out = pd.concat(counter.handleInputRows(("p",), frames(), None))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.step.sum() == 2.0 * (n - 1) and out.limit.isna().all() and out.before_ms.isna().sum() == 1
    assert peak < 150 * n  # a Row of four numbers alone takes more
    more = pd.concat(counter.handleInputRows(("p",), iter([pd.DataFrame({"at_ms": [n * 10], "x": [5.0], "limit": [1.0]})]), None))
    assert more.values.tolist() == [["p", n * 10 // 60_000 * 60_000, (n - 1) * 10 // 60_000 * 60_000, 5.0, 1.0]]


def test_late_rows_go_to_their_own_table(spark, tmp_path):
    schema = "id long, ts timestamp"
    parts = [[(1, AT(0)), (2, AT(30))], [(3, AT(19)), (4, AT(21)), (5, None), (6, AT(60))], [(7, AT(49, 59)), (8, AT(50)), (9, AT(10))]]

    def run(s):
        assert SC.drain(ST.split_late(s, f"{tmp_path}/on", f"{tmp_path}/late", f"{tmp_path}/ck", delay="10 minutes")) == 0
    _batches(spark, tmp_path, schema, parts, run)
    late = {r.id: r.watermark for r in spark.read.parquet(f"{tmp_path}/late").collect()}
    assert late == {3: AT(20), 7: AT(50), 9: AT(50)}
    assert {r.id for r in spark.read.parquet(f"{tmp_path}/on").collect()} == {1, 2, 4, 5, 6, 8}
    # windows over the rows on time, with the same delay, drop nothing
    s = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/on").schema).parquet(f"{tmp_path}/on")
    out = s.withWatermark("ts", "10 minutes").groupBy(F.window("ts", "5 minutes")).count().select("count")
    assert sum(r["count"] for r in SC.run_to_table(out, "after_split", f"{tmp_path}/ck2").collect()) == 3  # closed by 00:50


def test_a_batch_that_is_replayed_replaces_itself(spark, tmp_path):
    schema = "id long, ts timestamp"
    spark.createDataFrame([(1, AT(0)), (2, AT(5))], schema).write.parquet(f"{tmp_path}/in/d=0")
    for checkpoint in ("ck", "ck"):  # the second run finds nothing new
        s = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/d=*")
        SC.drain(ST.split_late(s, f"{tmp_path}/on", f"{tmp_path}/late", f"{tmp_path}/{checkpoint}"))
    import shutil
    shutil.rmtree(tmp_path / "ck" / "commits")  # as after a failure between the batch and its commit
    s = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/d=*")
    SC.drain(ST.split_late(s, f"{tmp_path}/on", f"{tmp_path}/late", f"{tmp_path}/ck"))
    assert spark.read.parquet(f"{tmp_path}/on").count() == 2
