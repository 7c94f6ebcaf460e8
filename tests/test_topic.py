"""The folder topic: offsets, resuming, groups, producers at once."""

import threading

import pytest
from pyspark.sql import functions as F

from autoprice.sources import topic as TP
from autoprice.streaming import scoring as SC


def _append(spark, path, ids, partitions=3):
    return TP.append(spark.createDataFrame([(i, f"v{i}\n\"ü\"") for i in ids], "id long, v string").repartition(3), path, "id", "v", ["id"], partitions=partitions)


def _drain(spark, path, tmp_path, name="q", **options):
    return SC.run_to_table(TP.read_topic(spark, path, **options), name, f"{tmp_path}/ck-{name}", path=f"{tmp_path}/out-{name}")


def test_a_restarted_query_neither_loses_nor_repeats(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(3):
        assert _append(spark, path, range(k * 10, k * 10 + 10)) == k + 1
        rows = _drain(spark, path, tmp_path).collect()
        assert sorted(int(r.key) for r in rows) == list(range(k * 10 + 10))
    _drain(spark, path, tmp_path)  # nothing new
    rows = _drain(spark, path, tmp_path).collect()
    assert len(rows) == 30 and all(r.value == f"v{r.key}\n\"ü\"" and r.timestamp is not None for r in rows)
    for p in {r.partition for r in rows}:
        mine = sorted((r.offset, int(r.key)) for r in rows if r.partition == p)
        assert [o for o, _ in mine] == list(range(len(mine))) and [k for _, k in mine] == sorted(k for _, k in mine)
    _append(spark, path, [], partitions=50)
    assert {a["partitions"] for a in TP.list_appends(path)} == {3} and len({r.partition for r in rows}) <= 3
    batch = spark.read.format("topic").option("path", path).load()
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, rows))


def test_starting_offsets_and_groups(spark, tmp_path):
    path = str(tmp_path / "t")
    _append(spark, path, range(6))
    assert _drain(spark, path, tmp_path, "new", startingOffsets="latest").count() == 0
    _drain(spark, path, tmp_path, "first", group="g")
    _append(spark, path, range(6, 9))
    assert {int(r.key) for r in _drain(spark, path, tmp_path, "new", startingOffsets="latest").collect()} == {6, 7, 8}
    # another query of the group goes on where the first had committed; a batch is committed when the next one begins
    done = TP.group_offsets(path, "g")
    assert sum(done.values()) in (0, 6)
    TP.commit_group(path, "g", TP.end_offsets(TP.list_appends(path)[:1]))
    assert {int(r.key) for r in _drain(spark, path, tmp_path, "second", group="g", startingOffsets="group").collect()} == {6, 7, 8}
    with pytest.raises(ValueError):
        TP._StreamReader({"path": path, "startingOffsets": "group"})
    with pytest.raises(ValueError):
        TP._StreamReader({"path": path, "startingOffsets": "7"})


def test_producers_at_once_get_different_offsets(spark, tmp_path):
    path, failed = str(tmp_path / "t"), []

    def produce(k):
        try:
            _append(spark, path, range(k * 100, k * 100 + 20))
        except Exception as e:  # noqa: BLE001 - shown by the assertion
            failed.append(e)
    threads = [threading.Thread(target=produce, args=(k,)) for k in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    rows = spark.read.format("topic").option("path", path).load() if not spark.dataSource.register(TP.TopicSource) else None
    rows = rows.collect()
    assert not failed and len(rows) == 60 and len({(r.partition, r.offset) for r in rows}) == 60
    for p in {r.partition for r in rows}:
        assert sorted(r.offset for r in rows if r.partition == p) == list(range(sum(r.partition == p for r in rows)))


def test_empty_topic_null_values_and_a_hot_key(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.dataSource.register(TP.TopicSource)
    assert TP.list_appends(path) == [] and _drain(spark, path, tmp_path).count() == 0
    hot = spark.range(500).select(F.lit("k").alias("key"), F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("v"), "id")
    TP.append(hot, path, "key", "v", ["id"])
    # one key, one partition, in order, from several files
    rows = spark.read.format("topic").option("path", path).load()
    assert [r.value for r in rows.orderBy("offset").collect()] == [str(i) if i % 2 == 0 else None for i in range(500)]
    assert len(TP._files(path, {}, TP.end_offsets(TP.list_appends(path)))) > 1
    TP.append(hot.where("false"), path, "key", "v", ["id"])
    assert rows.count() == 500
