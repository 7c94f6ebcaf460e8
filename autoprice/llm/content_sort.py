"""Exact duplicates by sorting the content itself.

Texts are normalised (each run of ``[\\x20\\x09-\\x0D]`` becomes one space), range-partitioned at sampled
splitters and sorted within the partitions by Spark's external sort, so that equal texts stand next to each
other with their smallest id first. One pass over each sorted partition compares every text with the one
before it, byte for byte, and numbers the runs of equal texts.

The sort key is (first HEAD bytes, SHA-256, id). Splitters are sampled keys and stay small however long
a text is: a splitter of whole texts would bring them to the driver. The id as the last part lets a splitter fall inside a
group of copies, so a group that holds a third of all rows is spread over a third of the partitions. The digest
only orders; equality is decided by comparing the texts.

A run that reaches the end of a partition may go on in the next. The texts at the partition edges (two a
partition) are compared by a join of neighbours; what reaches the driver is one number of rows, one id and one
truth value a partition. The runs so joined, two a partition at most, are a broadcast table.

The text is shuffled once. The open run of a partition keeps its ids in memory (never its texts), at most
the ids of one partition.

Defined cases: a null text is an empty one, and all empty texts are one group; white space at the ends counts as
one space; null ids come last, so they stay only where no row of the group has an id; rows that repeat id and text
are rows like others, and the first of them alone stays; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from autoprice.llm.common import materialise, shuffle_partitions

HEAD = 64
SLICE = 20_000  # rows to an output batch


def normalised(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def sorted_content(docs: DataFrame, id_col: str, text: str, partitions: int | None = None) -> DataFrame:
    """(id, norm, sha) in content order over range partitions."""
    d = docs.select(F.col(id_col).alias("id"), normalised(F.col(text)).alias("norm"))
    d = d.select("id", "norm", F.sha2("norm", 256).alias("sha"), F.substring(F.col("norm").cast("binary"), 1, HEAD).alias("head"))
    key = [F.asc("head"), F.asc("sha"), F.asc_nulls_last("id")]
    n = partitions or shuffle_partitions(docs.sparkSession)
    return d.repartitionByRange(n, *key).sortWithinPartitions(*key).select("id", "norm", "sha")


def _number_runs(schema: pa.Schema):
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.compute as pc
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        none = pa.scalar(None, pa.string())

        def rows(ids: pa.Array, sha: pa.Array, sizes: np.ndarray, run: int, edges: dict[int, pa.Scalar]):
            """Runs of ``sizes`` rows, numbered from ``run``; ``edges``: text by row."""
            begin = np.cumsum(sizes) - sizes
            of = np.repeat(np.arange(len(sizes)), sizes)
            for a in range(0, len(ids), SLICE):
                k = of[a:a + SLICE]
                text = [edges.get(i, none).as_py() for i in range(a, a + len(k))] if any(a <= i < a + len(k) for i in edges) \
                    else pa.nulls(len(k), pa.string())
                yield pa.RecordBatch.from_arrays([
                    ids.slice(a, len(k)), pa.array(np.full(len(k), pid, np.int32)), pa.array(run + k), pa.array(sizes[k]),
                    ids.take(pa.array(begin[k])), pa.array(begin[k] == np.arange(a, a + len(k))), sha.take(pa.array(begin[k])),
                    pa.array(text, pa.string())], schema=schema)

        def close(edge: bool):
            ids = pa.concat_arrays(open_ids)
            return rows(ids, pa.array([open_sha.as_py()] * len(ids), pa.string()), np.array([len(ids)]), run, {0: open_text} if edge else {})

        open_ids, open_sha, open_text, run = [], None, None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids, norm, sha = batch.columns
            new = np.ones(n, bool)
            new[0] = open_text is None or norm[0] != open_text
            new[1:] = pc.not_equal(norm.slice(1), norm.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            start = np.flatnonzero(new)
            first = int(start[0]) if len(start) else n
            if first:
                open_ids.append(ids.slice(0, first))
            if not len(start):
                continue
            if open_ids:
                yield from close(run == 0)
                run += 1
            last = int(start[-1])
            if last > first:
                yield from rows(ids.slice(first, last - first), sha.slice(first, last - first), np.diff(start), run,
                                {0: norm[first]} if run == 0 else {})
                run += len(start) - 1
            # a copy of the open run's values, so that the batch can go
            open_ids, open_sha = [pa.concat_arrays([ids.slice(last)])], pa.scalar(sha[last].as_py(), pa.string())
            open_text = pa.scalar(norm[last].as_py(), norm.type)
        if open_ids:
            yield from close(True)
    return number


def runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", partitions: int | None = None) -> DataFrame:
    """Every row with its run of equal texts within its partition: id, pid, run, size (rows of the run there),
    keep (the first id there), first (whether the row is the first there), sha, and edge (the text, in the first row
    of a partition's first and last run). Written and read back."""
    content = sorted_content(docs, id_col, text, partitions)
    kind = content.schema["id"].dataType
    out = T.StructType([T.StructField("id", kind), T.StructField("pid", T.IntegerType()), T.StructField("run", T.LongType()),
                        T.StructField("size", T.LongType()), T.StructField("keep", kind), T.StructField("first", T.BooleanType()),
                        T.StructField("sha", T.StringType()), T.StructField("edge", T.StringType())])
    from pyspark.sql.pandas.types import to_arrow_schema
    return materialise(content.mapInArrow(_number_runs(to_arrow_schema(out)), out), "content-runs")


def joined_runs(table: DataFrame) -> DataFrame:
    """Runs that go on over a partition's edge, two a partition at most: pid, run, and the group's size, keep,
    and whether this run begins the group."""
    spark = table.sparkSession
    edges = table.where(F.col("edge").isNotNull())
    ends: dict[int, list] = {}
    for r in edges.select("pid", "run", "size", "keep").orderBy("pid", "run").collect():
        ends.setdefault(r.pid, []).append(r)
    pids = sorted(ends)
    before = spark.createDataFrame(list(zip(pids[1:], pids, (ends[p][-1].run for p in pids))), "pid int, left int, run long")
    tail = (edges.join(F.broadcast(before.select(F.col("left").alias("pid"), "run", F.col("pid").alias("right"))), ["pid", "run"])
            .select(F.col("right").alias("pid"), F.col("edge").alias("tail")))
    goes_on = {r.pid for r in edges.where("run = 0").join(tail, "pid").where(F.col("edge") == F.col("tail")).select("pid").collect()}
    groups: list[list] = []  # of runs, in order
    for p in pids:
        head, last = ends[p][0], ends[p][-1]
        if p in goes_on:
            groups[-1].append(head)
        else:
            groups.append([head])
        if last is not head:
            groups.append([last])
    out = T.StructType([T.StructField("pid", T.IntegerType()), T.StructField("run", T.LongType()), T.StructField("all_size", T.LongType()),
                        T.StructField("all_keep", table.schema["keep"].dataType), T.StructField("begins", T.BooleanType())])
    return spark.createDataFrame([(r.pid, r.run, sum(x.size for x in g), g[0].keep, r is g[0]) for g in groups if len(g) > 1 for r in g], out)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", partitions: int | None = None) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, keep_id (the id that stays), group_size, kept, text_sha256."""
    table = runs(docs, id_col, text, partitions)
    d = table.join(F.broadcast(joined_runs(table)), ["pid", "run"], "left")
    over = F.col("begins").isNotNull()
    return d.select(F.col("id").alias(id_col), F.when(over, F.col("all_keep")).otherwise(F.col("keep")).alias("keep_id"),
                    F.coalesce("all_size", "size").alias("group_size"),
                    (F.col("first") & F.coalesce("begins", F.lit(True))).alias("kept"), F.col("sha").alias("text_sha256"))


def keep_one_per_text(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns; of rows that repeat id and text, one."""
    stays = exact_duplicates(docs, id_col, text).where("kept").select(F.col(id_col).alias("_stay_id"), "text_sha256")
    of = F.sha2(normalised(F.col(text)), 256)
    d = docs.select(F.struct(*docs.columns).alias("_row"), F.col(id_col).alias("_own_id"), of.alias("_own_sha"))
    d = d.join(stays, F.col("_own_id").eqNullSafe(F.col("_stay_id")) & (F.col("_own_sha") == F.col("text_sha256")), "left_semi")
    return d.dropDuplicates(["_own_id", "_own_sha"]).select("_row.*")
