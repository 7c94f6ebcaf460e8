"""Helpers shared by the operators: durable intermediate tables, checked broadcasts, column names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from autoprice.session import ensure_checkpoint_dir

# A side is broadcast only after a count has shown it to hold at most this many (narrow) rows.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint directory (the session's own setting)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


BATCH_ROWS = 1000


def text_batches(df: DataFrame) -> DataFrame:
    """Let Arrow batches of the session hold BATCH_ROWS rows, where its setting is Spark's default of 10,000:
    texts are long rows, and a batch exists several times between the JVM and Python. Returns ``df``."""
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


#: Spark's setting (4.1) that removes an execution's shuffle files when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str, drop_shuffles: bool = False) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage, survives the
    loss of an executor, and later reads take only the columns they use. ``drop_shuffles`` removes the shuffle
    files of this write at its end, not when the driver collects garbage."""
    spark = text_batches(df).sparkSession
    path, before = shared_path(spark, name), spark.conf.get(SHUFFLE_CLEANUP, None)
    if drop_shuffles:
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if drop_shuffles:
            spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a materialised narrow table for broadcast if its counted size allows it; otherwise leave
    it to a shuffle join. The rows of the result are the same either way."""
    return F.broadcast(df) if df.count() <= max_rows else df


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def release_memory() -> None:
    """Give freed memory of a Python worker back to the system: the worker lives on beside others and a JVM."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def releasing(run):
    """The function of a ``mapInArrow``, giving its task's memory back when it ends."""
    def wrapped(batches):
        yield from run(batches)
        release_memory()
    return wrapped
