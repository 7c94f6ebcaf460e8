"""Streaming scoring.

The per-message HTTP round trip of the reference becomes a micro-batch plan: records are parsed
with ``from_json`` against a fixed schema, validated, scored by a ``PipelineModel`` (shipped to the
executors once per query, not per message) and written as JSON. Offsets and sink commits are
tracked in the checkpoint location, so a restarted query resumes without loss; invalid records go
to a dead-letter sink instead of being printed and dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field names and types of a scoring request.
REQUEST_FIELDS = [("Year", T.IntegerType()), ("Present_Price", T.DoubleType()), ("Kms_Driven", T.IntegerType()),
                  ("Owner", T.IntegerType()), ("Car_Age", T.IntegerType()), ("Kms_Per_Year", T.DoubleType()),
                  ("Fuel_Type", T.StringType()), ("Seller_Type", T.StringType()), ("Transmission", T.StringType())]
REQUEST_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in REQUEST_FIELDS])
REQUEST_NAMES = [n for n, _ in REQUEST_FIELDS]


def stream_source(spark: SparkSession, fmt: str = "kafka", options: dict | None = None, schema=None,
                  path: str | None = None) -> DataFrame:
    """A streaming source. ``kafka`` (topic, bootstrap servers and ``startingOffsets=earliest`` in
    ``options``; needs the Kafka connector on the classpath) yields a string ``value``; ``topic`` (``path``, ``options`` as
    for ``sources.topic``) does the same from a shared folder, with offsets and groups; file formats
    (parquet / json / text) read a directory with an explicit schema."""
    if fmt == "topic":
        from autoprice.sources.topic import read_topic
        return read_topic(spark, path, **(options or {}))
    r = spark.readStream.format(fmt)
    if fmt == "kafka":
        opts = {"startingOffsets": "earliest", **(options or {})}
        return r.options(**opts).load().select(F.col("key").cast("string").alias("key"),
                                               F.col("value").cast("string").alias("value"), "timestamp")
    if schema is not None:
        r = r.schema(schema)
    return r.options(**(options or {})).load(path)


def parse_request(df: DataFrame, value: str = "value") -> DataFrame:
    """Typed parse of the 9-field request; a record is ``ok`` only when it is valid JSON and every
    field is present with the right type (the service's 422 becomes ``status = 'rejected'``)."""
    parsed = F.from_json(F.col(value), REQUEST_SCHEMA, {"mode": "PERMISSIVE"})
    d = df.withColumn("_r", parsed)
    ok = None
    for n in REQUEST_NAMES:
        c = F.col("_r").getField(n).isNotNull()
        ok = c if ok is None else ok & c
    return d.select(*[c for c in df.columns], *[F.col("_r").getField(n).alias(n) for n in REQUEST_NAMES],
                    F.when(F.coalesce(ok, F.lit(False)), "ok").otherwise("rejected").alias("status"))


def nest_prediction_json(df: DataFrame, prediction: str = "predicted_price") -> DataFrame:
    """P13 + X6: ``{"car_data": {...request...}, "predicted_price": p}`` as the JSON ``value``."""
    body = F.struct(F.struct(*[F.col(n) for n in REQUEST_NAMES]).alias("car_data"),
                    F.col(prediction).cast("double").alias("predicted_price"))
    return df.withColumn("value", F.to_json(body))


def score_requests(parsed: DataFrame, model, prediction: str = "prediction", rename: dict[str, str] | None = None) -> DataFrame:
    """W1 on parsed rows: ``value`` becomes the prediction JSON of a valid row and NULL of a rejected one; the
    request columns and ``status`` stay, so nothing is lost and a sink can route both.

    Rejected rows pass the model with zeros and empty strings in place of NULLs, in the same scan, and their
    prediction is discarded. ``rename`` maps request fields to the model's column names (default: the same)."""
    others = [c for c in parsed.columns if c not in [*REQUEST_NAMES, "value"]]
    filled = [F.coalesce(F.col(n), F.lit("" if isinstance(t, T.StringType) else 0).cast(t)).alias((rename or {}).get(n, n))
              for n, t in REQUEST_FIELDS]
    scored = model.transform(parsed.select(F.struct(*others).alias("_others"), F.struct(*REQUEST_NAMES).alias("_asked"), *filled))
    ok = F.col("status") == "ok"
    back = scored.select("_others.*", "_asked.*", F.col(prediction).alias("predicted_price"))
    back = nest_prediction_json(back.withColumn("predicted_price", F.when(ok, F.col("predicted_price"))))
    return back.withColumn("value", F.when(ok, F.col("value")))


def score_stream(requests: DataFrame, model, prediction: str = "prediction", rename: dict[str, str] | None = None) -> DataFrame:
    """Parse -> validate -> predict -> wrap as JSON. Both branches come back with ``status`` and the raw
    ``payload``, so a sink can route them (F7)."""
    return score_requests(parse_request(requests.withColumn("payload", F.col("value"))), model, prediction, rename)


def write_stream(df: DataFrame, fmt: str, checkpoint: str, options: dict | None = None, query_name: str | None = None,
                 mode: str = "append", available_now: bool = False, path: str | None = None):
    """K5: ``value`` to Kafka / files / memory with a checkpoint location (exactly-once for
    idempotent file and memory sinks, at-least-once to Kafka)."""
    w = df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint)
    if options:
        w = w.options(**options)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start(path) if path else w.start()


def _write_epoch(df: DataFrame, path: str, epoch_id: int, fmt: str) -> None:
    """Idempotent micro-batch write: the batch lands in its own ``epoch_id`` partition with dynamic
    overwrite, so a batch replayed after a failure replaces its earlier attempt instead of adding
    duplicates (exactly-once output with an at-least-once ``foreachBatch``)."""
    (df.withColumn("epoch_id", F.lit(epoch_id)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("epoch_id").format(fmt).save(path))


def route_batches(good_path: str, dead_path: str, fmt: str = "parquet", transform=None):
    """F7 as a ``foreachBatch`` function: each micro-batch is persisted once, valid rows (after the
    optional ``transform``, e.g. scoring and JSON wrapping) go to the output, invalid rows with
    their raw payload to the dead-letter table."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            good = batch.where(F.col("status") == "ok")
            _write_epoch(transform(good) if transform else good, good_path, epoch_id, fmt)
            _write_epoch(batch.where(F.col("status") != "ok"), dead_path, epoch_id, fmt)
        finally:
            batch.unpersist()
    return run


def dedupe_stream(df: DataFrame, key: str, ts: str, delay: str = "10 minutes") -> DataFrame:
    """Drop redelivered messages (same key) within the watermark delay. TIMESTAMP_NTZ event
    times are cast to TIMESTAMP first (watermarks need a time-zone-aware column)."""
    d = df.withColumn(ts, F.col(ts).cast("timestamp")) if isinstance(df.schema[ts].dataType, T.TimestampNTZType) else df
    return d.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def formula_price_model(spark: SparkSession):
    """A fixed linear price rule packaged as a ``PipelineModel`` (a ``SQLTransformer`` stage), used
    where a deterministic model is needed (stream-equals-batch checks)."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer
    rule = SQLTransformer(statement="SELECT *, floor((Present_Price * 0.6 + Owner * 0.1 - Car_Age * 0.05) * 100) / 100 "
                                    "AS prediction FROM __THIS__")
    return PipelineModel(stages=[rule])


def drain(query) -> int:
    """Wait for a bounded query to end, however long it takes (a failure raises), and return the rows that
    stateful operators dropped as later than the watermark."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return sum(int(op.numRowsDroppedByWatermark) for p in query.recentProgress for op in p.stateOperators)


class LateRows(RuntimeError):
    """Rows came later than the watermark allows and would be missing from the result."""


def run_to_table(df: DataFrame, name: str, checkpoint: str, mode: str = "append", path: str | None = None,
                 allow_late: bool = False) -> DataFrame:
    """Drain a bounded streaming input (``availableNow``) into a Parquet table and return it.

    Output never accumulates on the driver (unlike the memory sink): append mode uses the file sink
    (exactly-once through its commit log); complete / update mode rewrites the table from each
    micro-batch's full result in ``foreachBatch``. Rows dropped as late are an error (``LateRows``, with their
    number) unless ``allow_late``.
    """
    from autoprice.session import scratch_dir
    spark = df.sparkSession
    path = path or scratch_dir(spark, f"stream-{name}")
    w = df.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint) \
          .trigger(availableNow=True)
    if mode == "append":
        q = w.format("parquet").start(path)
    else:
        spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)
        q = w.foreachBatch(lambda batch, _epoch: batch.write.mode("overwrite").parquet(path)).start()
    late = drain(q)
    if late and not allow_late:
        raise LateRows(f"{name}: {late} rows were later than the watermark")
    return spark.read.schema(df.schema).parquet(path)
