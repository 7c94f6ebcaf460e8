"""Session policy."""

from autoprice.session import CLUSTER_DEFAULTS, ensure_checkpoint_dir, scratch_dir


def test_estimate_based_broadcast_is_off(spark):
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    assert CLUSTER_DEFAULTS["spark.sql.autoBroadcastJoinThreshold"] == "-1"


def test_checkpoint_dir_kept_when_already_set(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == before


def test_scratch_folders_are_fresh_and_beside_the_checkpoints(spark):
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(spark.sparkContext.getCheckpointDir().rstrip("/"))
