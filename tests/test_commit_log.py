"""The registry's commit log: writers at once, conflicts, partitions, compaction."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from autoprice.operators import registry as RG
from autoprice.sources.commit_log import CommitLog


def test_two_writers_get_different_versions(spark, tmp_path):
    path, got, failed = str(tmp_path / "r"), [], []

    def write(w):
        try:
            for k in range(5):
                got.append(RG.register_version(spark, path, "m", f"{w}-{k}"))
        except Exception as e:  # noqa: BLE001 - shown by the assertion
            failed.append(e)
    threads = [threading.Thread(target=write, args=(w,)) for w in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and sorted(got) == list(range(1, 16))
    rows = RG.versions(spark, path).collect()
    assert sorted(r.version for r in rows) == list(range(1, 16)) and len({r.run_id for r in rows}) == 15
    assert [c.number for c in RG.registry_log(spark, path).commits()] == list(range(1, 16))
    # what lost a race is gone: one folder a commit
    assert len(os.listdir(tmp_path / "r" / "versions")) == 15


def test_conflict_builds_anew_from_the_new_state(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "l"), {"t": "model_name string, n bigint"}, "model_name")
    rival = CommitLog(spark, str(tmp_path / "l"), log.schemas, "model_name")
    one = lambda n: {"t": spark.range(1).select(F.lit("m").alias("model_name"), F.lit(n).alias("n"))}
    seen = []

    def build(state):
        seen.append(state.number)
        if len(seen) == 1:
            rival.append(lambda s: one(100))
        return one(log.read("t", state).count())
    assert log.append(build) == 2 and seen == [0, 1]
    assert sorted(r.n for r in log.read("t").collect()) == [1, 100]
    assert not log._create(2, {"replaces": False, "adds": {}}) and log._create(3, {"replaces": False, "adds": {}})
    assert not [f for f in os.listdir(tmp_path / "l" / "_commits") if f.endswith(".tmp")]


def test_uncommitted_folders_are_not_read(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "l"), {"t": "model_name string, n bigint"}, "model_name")
    log._write("t", spark.range(3).select(F.lit("m").alias("model_name"), F.col("id").alias("n")))
    assert log.read("t").count() == 0 and log.state().number == 0


def test_version_alias_and_run_in_one_commit(spark, tmp_path):
    path = str(tmp_path / "r")
    run = RG.run_log_rows(spark.sql("select '0.5' as r2, '8' as depth"), F.lit("a"), {"depth": "depth"}, {"r2": "r2"}, model=F.lit("m"))
    assert RG.register_version(spark, path, "m", "a", alias="champion", run=run) == 1
    (c,) = RG.registry_log(spark, path).commits()
    assert set(c.adds) == {"versions", "aliases", "runs"}
    assert [(r.model_name, r.name, r.value) for r in RG.runs(spark, path).orderBy("name").collect()] == [("m", "depth", "8"), ("m", "r2", "0.5")]
    assert [r.stage for r in RG.versions(spark, path).collect()] == ["Production"]
    with pytest.raises(KeyError):
        RG.set_alias(spark, path, "m", "champion", 9)
    assert RG.registry_log(spark, path).state().number == 1


def test_partitions_by_model_prune(spark, tmp_path):
    path = str(tmp_path / "r")
    d = spark.range(6).select(F.concat(F.lit("m"), (F.col("id") % 3).cast("string")).alias("model"), F.col("id").cast("string").alias("x"))
    RG.log_run(RG.run_log_rows(d, F.col("x"), {}, {"x": "x"}, model=F.col("model")), path)
    (folder,) = os.listdir(tmp_path / "r" / "runs")
    assert sorted(x for x in os.listdir(tmp_path / "r" / "runs" / folder) if "=" in x) == ["model_name=m0", "model_name=m1", "model_name=m2"]
    plan = RG.runs(spark, path).where("model_name = 'm1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(model_name" in plan
    assert RG.runs(spark, path).where("model_name = 'm1'").count() == 2


def test_compaction_and_vacuum(spark, tmp_path):
    path = str(tmp_path / "r")
    rows = spark.createDataFrame([("m", f"r{k}", "", "None") for k in range(4)] + [("n", "r9", "", "None")], "model_name string, run_id string, description string, stage string")
    assert RG.register_versions(spark, path, rows) == 1 and RG.register_versions(spark, path, rows) == 2
    before = sorted(map(tuple, RG.versions(spark, path).select("model_name", "version", "run_id").collect()))
    assert [v for m, v, _ in before if m == "m"] == list(range(1, 9)) and [v for m, v, _ in before if m == "n"] == [1, 2]
    log = RG.registry_log(spark, path)
    old = log.state()
    assert log.compact() == 3 and len(log.state().folders["versions"]) == 1
    assert log.read("versions", old).count() == 10  # an older state can still be read
    assert sorted(log.vacuum()) == sorted(old.folders["versions"]) and log.vacuum() == []
    assert RG.register_version(spark, path, "n", "r10") == 3
    assert sorted(map(tuple, RG.versions(spark, path).select("model_name", "version", "run_id").collect())) == sorted([*before, ("n", 3, "r10")])
