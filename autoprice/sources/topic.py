"""A topic of records in a shared folder: partitions, offsets, consumer groups.

For where no broker is at hand. ``append`` writes a table's records as JSON lines into partitions by key, in order, and
commits them under the next offsets (``commit_log``: two producers at once get different ones). ``TopicSource`` is a streaming source
(and a batch one) with offsets per partition: a query's checkpoint holds where it stands, so a restarted query goes on
without loss or repeats, and ``group`` additionally publishes what a query has finished, for another query to start from.

    spark.dataSource.register(TopicSource)
    spark.readStream.format("topic").option("path", folder).load()     # partition, offset, key, value, timestamp

Options: ``path``; ``startingOffsets`` ``earliest`` (default), ``latest`` or ``group``; ``group``.

A partition's records of one append lie in the files of one folder, written by as many tasks as their number needs; a micro-batch reads a
file a task. Offsets are listed from the commits alone (one small file an append). Paths may be on any file system that pyarrow opens
by URI, or on a mounted folder.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from autoprice.operators.ranking import global_index
from autoprice.sources.commit_log import CommitLog

SCHEMA = "partition int, offset long, key string, value string, timestamp timestamp"
PARTITIONS = 4


# ------------------------------------------------------------------ producing

class _Commits(CommitLog):
    """Appends to a topic: each commit names its folder and the first offset and number of records of each partition."""

    def append_records(self, folder: str, counts: dict[int, int], partitions: int, tries: int = 100) -> int:
        for _ in range(tries):
            appends = list_appends(self.path)
            ends = end_offsets(appends)
            ranges = {str(p): [ends.get(p, 0), n] for p, n in counts.items()}
            if self._create(len(appends) + 1, {"replaces": False, "adds": {"records": folder}, "ranges": ranges, "partitions": partitions}):
                return len(appends) + 1
        raise TimeoutError(f"no commit to {self.path} within {tries} tries: too many producers")


def append(df: DataFrame, path: str, key: str | Column, value: str | Column, order: list[str], timestamp: str | Column | None = None,
           partitions: int = PARTITIONS) -> int:
    """Append one record per row: a record's partition follows from its key, its place there from ``order`` (unique). Returns the number
    of the append. A topic keeps the number of partitions of its first append."""
    import uuid
    spark = df.sparkSession
    col = lambda c: F.col(c) if isinstance(c, str) else c
    before = list_appends(path)
    partitions = before[0]["partitions"] if before else partitions
    at = F.current_timestamp() if timestamp is None else col(timestamp).cast("timestamp")
    rows = df.select(F.pmod(F.xxhash64(col(key).cast("string")), F.lit(partitions)).cast("int").alias("topic_partition"),
                     col(key).cast("string").alias("key"), col(value).cast("string").alias("value"), F.unix_micros(at).alias("ts"),
                     *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order)])
    idx = global_index(rows, ["topic_partition", *[f"_order{i}" for i in range(len(order))]], "_i")
    first = {r[0]: (r[1], r[2]) for r in idx.groupBy("topic_partition").agg(F.min("_i"), F.count(F.lit(1))).collect()}  # one row a partition
    begin = F.coalesce(*[F.when(F.col("topic_partition") == p, F.lit(i)) for p, (i, _) in first.items()]) if first else F.lit(0)
    folder = f"records/append={uuid.uuid4().hex}"
    lines = F.to_json(F.struct((F.col("_i") - begin).alias("o"), "key", "value", "ts"), {"ignoreNullFields": "false"})
    idx.select("topic_partition", lines.alias("line")).write.partitionBy("topic_partition").text(f"{path.rstrip('/')}/{folder}")
    return _Commits(spark, path, {}, "topic_partition").append_records(folder, {p: n for p, (_, n) in first.items()}, partitions)


# ------------------------------------------------------------------ the log as plain files (no Spark session: also runs in workers)

def _open(path: str):
    """(file system, path on it) of a URI or a plain path."""
    from pyarrow import fs
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def list_appends(path: str) -> list[dict]:
    """The commits of a topic in order; none where it was never written."""
    from pyarrow import fs
    files, root = _open(path.rstrip("/"))
    found = files.get_file_info(fs.FileSelector(posixpath.join(root, "_commits"), allow_not_found=True))
    names = sorted(f.path for f in found if f.path.endswith(".json"))
    out = []
    for n in names:
        with files.open_input_stream(n) as f:
            out.append(json.loads(f.read()))
    return out


def end_offsets(appends: list[dict]) -> dict[int, int]:
    """The next offset of each partition."""
    out: dict[int, int] = {}
    for a in appends:
        for p, (first, n) in a["ranges"].items():
            out[int(p)] = max(out.get(int(p), 0), first + n)
    return out


def group_offsets(path: str, group: str) -> dict[int, int]:
    """What a consumer group has finished; nothing where it has not begun."""
    files, root = _open(path.rstrip("/"))
    name = posixpath.join(root, "_groups", f"{group}.json")
    if files.get_file_info(name).type.name == "NotFound":
        return {}
    with files.open_input_stream(name) as f:
        return {int(p): o for p, o in json.loads(f.read()).items()}


def commit_group(path: str, group: str, offsets: dict[int, int]) -> None:
    files, root = _open(path.rstrip("/"))
    name = posixpath.join(root, "_groups", f"{group}.json")
    files.create_dir(posixpath.dirname(name))
    with files.open_output_stream(name + ".tmp") as f:
        f.write(json.dumps({str(p): o for p, o in sorted(offsets.items())}).encode())
    files.move(name + ".tmp", name)


class _File(InputPartition):
    """One file of one append and partition, with the offset of the append's first record there and the wanted range."""

    def __init__(self, path: str, partition: int, first: int, begin: int, end: int) -> None:
        self.path, self.partition, self.first, self.begin, self.end = path, partition, first, begin, end


def _files(path: str, start: dict[int, int], end: dict[int, int]) -> list[_File]:
    from pyarrow import fs
    files, root = _open(path.rstrip("/"))
    out = []
    for a in list_appends(path):
        for p, (first, n) in sorted((int(p), r) for p, r in a["ranges"].items()):
            begin, stop = max(first, start.get(p, 0)), min(first + n, end.get(p, 0))
            if begin < stop:
                folder = posixpath.join(root, a["adds"]["records"], f"topic_partition={p}")
                names = sorted(f.path for f in files.get_file_info(fs.FileSelector(folder)) if posixpath.basename(f.path).startswith("part-"))
                out += [_File(name, p, first, begin, stop) for name in names]
    return out


def _records(path: str, file: _File) -> Iterator:
    """Record batches of a file's records with offsets in its range."""
    import datetime as dt

    import pyarrow as pa
    files, _ = _open(path)
    utc = dt.timezone.utc
    schema = pa.schema([("partition", pa.int32()), ("offset", pa.int64()), ("key", pa.string()), ("value", pa.string()), ("timestamp", pa.timestamp("us", "UTC"))])

    def batch(rows: list[dict]):
        return pa.RecordBatch.from_arrays([pa.array([file.partition] * len(rows), pa.int32()), pa.array([file.first + r["o"] for r in rows], pa.int64()),
                                           pa.array([r["key"] for r in rows], pa.string()), pa.array([r["value"] for r in rows], pa.string()),
                                           pa.array([r["ts"] for r in rows], pa.int64()).cast(schema.field("timestamp").type)], schema=schema)
    rows: list[dict] = []
    size = 0
    with files.open_input_stream(file.path) as raw:
        left = b""
        while True:
            data = raw.read(1 << 20)
            lines = (left + data).split(b"\n")
            left = lines.pop() if data else b""
            for line in lines:
                if line:
                    r = json.loads(line)
                    if file.begin <= file.first + r["o"] < file.end:
                        rows.append(r)
                        size += len(line)
                    if len(rows) >= 5000 or size >= 8 << 20:
                        yield batch(rows)
                        rows, size = [], 0
            if not data:
                break
    if rows:
        yield batch(rows)


# ------------------------------------------------------------------ consuming

class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self._path, self._group = options["path"], options.get("group")
        self._starting = options.get("startingoffsets", options.get("startingOffsets", "earliest"))
        if self._starting not in ("earliest", "latest", "group"):
            raise ValueError(f"startingOffsets: {self._starting}")
        if self._starting == "group" and not self._group:
            raise ValueError("startingOffsets group needs the option group")

    def initialOffset(self) -> dict:
        ends = end_offsets(list_appends(self._path))
        if self._starting == "earliest":
            return {}
        known = ends if self._starting == "latest" else group_offsets(self._path, self._group)
        return {str(p): o for p, o in sorted(known.items())}

    def latestOffset(self) -> dict:
        return {str(p): o for p, o in sorted(end_offsets(list_appends(self._path)).items())}

    def partitions(self, start: dict, end: dict) -> list[_File]:
        number = lambda d: {int(p): o for p, o in d.items()}
        return _files(self._path, number(start), number(end))

    def read(self, partition: _File) -> Iterator:
        return _records(self._path, partition)

    def commit(self, end: dict) -> None:
        if self._group:
            commit_group(self._path, self._group, {int(p): o for p, o in end.items()})


class _BatchReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self._path = options["path"]

    def partitions(self) -> list[_File]:
        return _files(self._path, {}, end_offsets(list_appends(self._path)))

    def read(self, partition: _File | None) -> Iterator:
        return _records(self._path, partition) if partition else iter(())


class TopicSource(DataSource):
    """The format ``topic``."""

    @classmethod
    def name(cls) -> str:
        return "topic"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(dict(self.options))


def read_topic(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A topic as a stream."""
    spark.dataSource.register(TopicSource)
    return spark.readStream.format("topic").options(path=path, **options).load()
