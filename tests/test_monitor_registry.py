"""Monitoring edge cases and registry semantics."""

import datetime as dt

from pyspark.sql import functions as F

from autoprice.operators import monitor as MO
from autoprice.operators import registry as RG


def _log(spark, rows):
    return spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, m, s), ok, lat) for m, s, ok, lat in rows],
                                 "ts timestamp_ntz, ok boolean, latency_s double")


def test_histogram_quantile_interpolates_and_caps_at_last_finite_bound(spark):
    # 4 requests in one window: 0.02, 0.04, 0.3, 20.0 -> p50 inside (0.025, 0.05], p95 in +Inf -> 10.0
    log = _log(spark, [(0, 1, True, 0.02), (0, 2, True, 0.04), (0, 3, True, 0.3), (0, 4, True, 20.0)])
    b = MO.histogram_buckets(log, "latency_s", MO.DEFAULT_BUCKETS, "ts", "5 minutes", "5 minutes")
    p50 = MO.histogram_quantile(b, 0.5, out="q").first().q
    p95 = MO.histogram_quantile(b, 0.95, out="q").first().q
    assert abs(p50 - (0.025 + (0.05 - 0.025) * (2 - 1) / (2 - 1))) < 1e-12
    assert p95 == 10.0


def test_error_status_and_alert_transitions(spark):
    log = _log(spark, [(0, 1, False, 0.1), (1, 1, True, 0.1), (2, 1, False, 0.1), (3, 1, False, 0.1), (9, 1, True, 0.1)])
    e = MO.error_count(log, "ok", "ts", "1 minute", "1 minute")
    assert {r.status for r in e.collect()} == {"red", "green"}
    a = MO.threshold_alerts(e, "errors", "errors", 0, "1 minute").orderBy("window_start").collect()
    states = [(r.window_start.minute, r.state) for r in a]
    assert states == [(0, "firing"), (1, "resolved"), (2, "firing"), (4, "resolved")]


def test_normalise_alert_defaults(spark):
    df = spark.createDataFrame([('{"title":"x"}',), ("{}",), ("not json",)], "value string")
    out = [(r.title, r.message, r.state) for r in MO.normalise_alert(df).collect()]
    assert out[0] == ("x", "No message", "No state") and out[1] == out[2] == ("No title", "No message", "No state")


def _versions(spark):
    return spark.createDataFrame([("m", 1, 0.5, "Production"), ("m", 2, 0.7, "Staging"), ("m", 3, 0.6, "None"),
                                  ("n", 1, 0.1, "Archived")], "model_name string, version long, r2 double, stage string")


def test_next_and_latest_versions(spark):
    v = _versions(spark)
    assert dict(RG.next_versions(v).collect()) == {"m": 4, "n": 2}
    latest = {r.model_name: (r.version, r.stage) for r in RG.latest_versions(v).collect()}
    assert latest == {"m": (3, "None"), "n": (1, "Archived")}


def test_alias_resolution_with_tag_fallback(spark):
    v = _versions(spark)
    events = spark.createDataFrame([("m", "champion", 3, 1), ("m", "champion", 2, 5), ("m", "shadow", 1, 9)],
                                   "model_name string, alias string, version long, set_at long")
    of = lambda alias, tag: {r.model_name: r.resolved_version for r in RG.resolve_alias(v, events, alias, tag).collect()}
    assert of("champion", "Archived") == {"m": 2, "n": 1}  # the latest event; without one, the tag
    assert of("shadow", "Staging") == {"m": 1, "n": None}
    assert of("challenger", "Staging") == {"m": 2, "n": None}


def test_versions_and_aliases_as_events(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert RG.versions(spark, path).count() == 0
    assert [RG.register_version(spark, path, "m", f"r{k}", "text", at=f"2024-01-0{k + 1}") for k in range(3)] == [1, 2, 3]
    assert RG.register_version(spark, path, "other", "r9") == 1
    for version, at in ((1, "2024-02-01"), (3, "2024-02-02"), (2, "2024-02-03")):
        RG.set_alias(spark, path, "m", "champion", version, at)
    stages = {(r.model_name, r.version): r.stage for r in RG.versions(spark, path).collect()}
    assert stages == {("m", 1): "Archived", ("m", 2): "Production", ("m", 3): "Archived", ("other", 1): "None"}


def test_counter_increase_with_resets(spark):
    at = lambda m, s: dt.datetime(2024, 1, 1, 0, m, s)
    rows = [("p", at(0, 0), 10.0), ("p", at(0, 30), 14.0), ("p", at(1, 0), 3.0), ("p", at(3, 0), 5.0), ("q", at(0, 10), 1.0)]
    df = spark.createDataFrame(rows, "pod string, ts timestamp_ntz, x double")
    got = {(r.pod, r.window_start.strftime("%M")): r.increase for r in
           MO.counter_increase(df, "x", ["pod"], "ts", "2 minutes", "1 minute").collect()}
    assert got == {("p", "59"): 4.0, ("p", "00"): 7.0, ("p", "01"): 0.0, ("p", "02"): 0.0, ("p", "03"): 0.0, ("q", "59"): 0.0, ("q", "00"): 0.0}


def test_promote_archives_previous_champion(spark):
    v = _versions(spark)
    winners = spark.createDataFrame([("m", 2)], "model_name string, version long")
    out = {(r.model_name, r.version): (r.stage, r.alias) for r in RG.promote(v, winners).collect()}
    assert out[("m", 2)] == ("Production", "champion")
    assert out[("m", 1)] == ("Archived", "archived")
    assert out[("m", 3)] == ("None", "none") and out[("n", 1)] == ("Archived", "archived")


def test_compare_runs_pivot(spark):
    log = spark.createDataFrame([("r1", "metric", "r2", "0.5", 2), ("r1", "metric", "r2", "0.9", 1), ("r1", "metric", "mae", "1.0", 1),
                                 ("r2", "metric", "r2", "0.7", 1), ("r2", "param", "depth", "8", 1)],
                                "run_id string, kind string, name string, value string, logged_at long")
    out = {r.run_id: (r.r2, r.mae) for r in RG.compare_runs(log, ["r2", "mae"]).collect()}
    assert out == {"r1": (0.5, 1.0), "r2": (0.7, None)}
