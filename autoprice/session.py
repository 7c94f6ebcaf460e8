"""Session construction and the shared checkpoint directory.

On a cluster the checkpoint directory comes from ``spark.checkpoint.dir`` (a shared, reliable
file system path). Only when that setting is absent *and* Spark runs in local mode (tests, the
bench) do we create a scratch directory of our own; on a cluster without the setting we refuse
rather than silently checkpoint to a machine-local folder.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


# Starting points for a large cluster (hundreds of executors, ~100 TB inputs). AQE coalesces the
# generous shuffle partition count down to the advisory size at run time and splits skewed partitions.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    # no broadcast on Catalyst's size *estimates*; AQE broadcasts a join side only after measuring it
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_spark(master: str | None = None, app: str = "autoprice", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """A session with the library's settings. Without ``master`` the launcher's applies (``spark-submit
    --master``), as do its memory settings; the cluster starting points hold where the launcher has not set
    them and the session is not local."""
    b = (SparkSession.builder.appName(app)
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         # broadcast a join side only after AQE has measured it (never on a static estimate)
         .config("spark.sql.autoBroadcastJoinThreshold", "-1")
         .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32m")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if master:
        b = b.master(master)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.master.startswith("local"):
        given = {k for k, _ in spark.sparkContext.getConf().getAll()} | set(extra or {})
        for k, v in CLUSTER_DEFAULTS.items():
            if k.startswith("spark.sql.") and k not in given and not (k == "spark.sql.shuffle.partitions" and shuffle_partitions):
                spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one up only for local sessions."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder of the cluster")
    scratch = tempfile.mkdtemp(prefix="autoprice-ckpt-")
    atexit.register(shutil.rmtree, scratch, ignore_errors=True)  # our own folder goes with the local session
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder beside the checkpoint directory for durable intermediate tables: a path for Spark's
    readers and writers, on whatever file system that directory is."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
