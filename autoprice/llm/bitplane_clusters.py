"""Centroid clustering of integer vectors by bit planes.

A vector's DIMS = 64 components become integers floor(scale * x) in two's complement. Plane b of a vector is one
unsigned 64-bit integer whose bit i is bit b of component i, and has the weight 2^b (the top plane -2^b). Then

    x . c = sum over planes a, b of w_a * w_b * popcount(X_a & C_b)

holds exactly, and |x|^2, |c|^2 and the squared distance follow from it. A cluster's componentwise sums are weighted
counts of set bits by position, again plane by plane. Vectors are packed once (8 bytes a plane, 11 planes for
components within [-1, 1) at scale 1024) into a written table. Each round is one pass over it that sends one row per
task and cluster to a grouped sum; centroids (k x 64 integers) are the only thing the driver holds.

The number of planes follows from the largest magnitude in the table. Up to 28 planes any distance fits a signed
64-bit integer; beyond, the call raises ArithmeticError, and a sum over a cluster that does not fit raises Spark's overflow error.

Defined cases: vectors that are null, have another number of components, or hold a null or non-finite one are left
out; null ids are clustered like others but begin no centroid while others can; rows that repeat an id are
vectors of their own, and where they tie for a first centroid, the smaller components go first; with fewer
vectors than k there are as many centroids; distance ties go to the smaller number; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autoprice.llm.common import materialise

DIMS = 64
MAX_PLANES = 28
ROWS = 2048  # rows worked on at a time


def weights(planes: int) -> np.ndarray:
    w = np.int64(1) << np.arange(planes, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def to_planes(x: np.ndarray, planes: int) -> np.ndarray:
    """(n, 64) integers as (n, planes) unsigned 64-bit integers."""
    bits = (x[:, None, :] >> np.arange(planes, dtype=np.int64)[None, :, None] & 1).astype(np.uint8)
    return np.packbits(bits, axis=2, bitorder="little").view("<u8")[:, :, 0]


def dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact dot products of each row of planes ``x`` with the planes ``c`` of one vector, or row by row of many."""
    w = weights(x.shape[1])
    c = np.broadcast_to(c, x.shape)
    out = np.zeros(len(x), np.int64)
    for b in range(x.shape[1]):
        out += w[b] * (np.bitwise_count(x & c[:, b:b + 1]) @ w)
    return out


def distances(x: np.ndarray, square: np.ndarray, c: np.ndarray) -> np.ndarray:
    """(n, k) squared distances of rows of planes, with their squared norms, from k centroids' planes."""
    own = dots(c, c)
    return np.stack([square + own[k] - 2 * dots(x, c[k]) for k in range(len(c))], axis=1)


def component_sums(x: np.ndarray) -> np.ndarray:
    """The sums by component of the integers in planes ``x``."""
    bits = np.unpackbits(np.ascontiguousarray(x).view(np.uint8).reshape(*x.shape, 8), axis=2, bitorder="little")
    return weights(x.shape[1]) @ bits.sum(axis=0, dtype=np.int64)


def _pack(scale: float, planes: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.floor(np.asarray(batch.column(1).flatten(), np.float64).reshape(-1, DIMS) * scale).astype(np.int64)
            p = to_planes(x, planes)
            square = np.concatenate([dots(q, q) for q in np.array_split(p, -(-len(p) // ROWS))]) if len(p) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in p], pa.binary()), pa.array(square)], ["id", "planes", "square"])
    return pack


def packed(vectors: DataFrame, id_col: str, vector: str, scale: float) -> tuple[DataFrame, int]:
    """(id, planes, square) of every usable vector as a written table, and the number of planes."""
    v = F.transform(F.col(vector), lambda e: e.cast("double"))
    usable = (F.size(v) == DIMS) & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < math.inf))
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v")).where(F.coalesce(usable, F.lit(False)))
    scaled = F.transform(F.col("v"), lambda e: F.floor(e * scale).cast("double"))
    low, high = rows.agg(F.min(F.array_min(scaled)), F.max(F.array_max(scaled))).first()
    most = max(-(low or 0) - 1, high or 0, 0)
    planes = int(most).bit_length() + 1
    if planes > MAX_PLANES:
        raise ArithmeticError(f"scaled components up to {most:.0f} need {planes} planes; distances fit 64 bits up to {MAX_PLANES}")
    kind = rows.schema["id"].dataType.simpleString()
    return materialise(rows.mapInArrow(_pack(scale, planes), f"id {kind}, planes binary, square long"), "planes"), planes


def _planes_of(batch: pa.RecordBatch, planes: int) -> np.ndarray:
    """The planes column of a batch, without copying its bytes value by value."""
    col = batch.column("planes")
    data, width = col.buffers()[2], 8 * planes
    first = np.frombuffer(col.buffers()[1], np.int32)[col.offset] if len(col) else 0
    return np.frombuffer(data, "<u8", len(col) * planes, int(first)).reshape(-1, planes) if width and len(col) else np.zeros((0, planes), "<u8")


def _nearest(batch: pa.RecordBatch, c: np.ndarray):
    """(planes, cluster, distance) of a batch's rows, ROWS at a time."""
    x, square = _planes_of(batch, c.shape[1]), batch.column("square").to_numpy()
    for a in range(0, len(x), ROWS):
        d = distances(x[a:a + ROWS], square[a:a + ROWS], c)
        k = d.argmin(axis=1)  # the first of equal ones
        yield x[a:a + ROWS], k, d[np.arange(len(d)), k]


def _partial_sums(c: np.ndarray):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(len(c), np.int64), np.zeros((len(c), DIMS), np.int64)
        for batch in batches:
            for x, k, _ in _nearest(batch, c):
                for j in np.unique(k):
                    mine = x[k == j]
                    n[j] += len(mine)
                    total[j] += component_sums(mine)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(n[used]),
                                          pa.array(total[used].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])
    return sums


def _assign(c: np.ndarray):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = list(_nearest(batch, c))
            if parts:
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.concatenate([k for _, k, _ in parts]).astype(np.int32)),
                                                  pa.array(np.concatenate([d for *_, d in parts]))], ["id", "cluster", "distance"])
    return assign


def first_centroids(table: DataFrame, planes: int, k: int, seed: int) -> np.ndarray:
    """(k, 64) components of the vectors whose id has the smallest SHA-256 of ``<seed>:<id>``."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = table.select(key.alias("key"), "planes").orderBy(F.asc_nulls_last("key"), "planes").limit(k).collect()
    return components(np.array([np.frombuffer(r.planes, "<u8") for r in rows], "<u8").reshape(-1, planes))


def components(p: np.ndarray) -> np.ndarray:
    """(n, 64) integers of (n, planes) planes."""
    bits = np.unpackbits(np.ascontiguousarray(p).view(np.uint8).reshape(*p.shape, 8), axis=2, bitorder="little")
    return np.tensordot(bits.astype(np.int64), weights(p.shape[1]), axes=(1, 0))


def fit(table: DataFrame, planes: int, k: int = 8, rounds: int = 10, seed: int = 3) -> np.ndarray:
    """(k, 64) integer centroids after ``rounds`` rounds over a packed table."""
    c = first_centroids(table, planes, k, seed)
    for _ in range(rounds if len(c) else 0):
        part = table.mapInArrow(_partial_sums(to_planes(c, planes)), "cluster int, n long, sums array<long>")
        whole = part.select("cluster", "n", F.posexplode("sums").alias("i", "s")).groupBy("cluster", "i").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        for r in whole.collect():  # k x 64 rows
            c[r.cluster, r.i] = r.s // r.n
    return c


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = 8, rounds: int = 10, seed: int = 3,
            scale: float = 1024.0) -> DataFrame:
    """One row per usable vector: ``id_col``, cluster, distance (squared, from its final centroid),
    cluster_inertia, inertia, centroid_sha256 (of its components as decimal integers joined by commas)."""
    spark = vectors.sparkSession
    table, planes = packed(vectors, id_col, vector, scale)
    c = fit(table, planes, k, rounds, seed)
    kind = table.schema["id"].dataType.simpleString()
    if not len(c):
        return spark.createDataFrame([], f"`{id_col}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    done = materialise(table.mapInArrow(_assign(to_planes(c, planes)), f"id {kind}, cluster int, distance long"), "assigned")
    inertia = {r.cluster: r.s for r in done.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    digest = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in c.tolist()]
    facts = spark.createDataFrame([(j, s, sum(inertia.values()), digest[j]) for j, s in inertia.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return done.join(F.broadcast(facts), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
