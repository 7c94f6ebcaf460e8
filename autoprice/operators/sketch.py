"""Mergeable summaries: quantiles by logarithmic buckets, and heavy hitters.

``log_bucket``      values as integers: neighbouring buckets differ by the factor (1 + a) / (1 - a), so a bucket's value is within the
                    relative error ``a`` of each value in it
``sketch``          counts by bucket and group: one aggregate; sketches merge by adding counts, so panes make any window, on a
                    stream as well
``sketch_quantiles`` quantiles of merged sketches: each order statistic within the relative error ``a``
``top_values``      the k most frequent values, exactly, without shuffling the others: candidates by Misra-Gries counters in each task, an
                    exact recount of these, and a proof by the counters' error that no other value can be among them
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from autoprice.session import ensure_checkpoint_dir

ALPHA = 0.01
TINY = 1e-12       # smaller magnitudes count as zero
LARGEST = 1.7e308  # infinities count as this
COUNTERS = 1000    # Misra-Gries counters of a task
BROADCAST = 200_000


def _gamma(alpha: float) -> float:
    return (1 + alpha) / (1 - alpha)


def _offset(alpha: float) -> int:
    return math.ceil(-math.log(TINY) / math.log(_gamma(alpha))) + 1


def log_bucket(value: str | Column, alpha: float = ALPHA) -> Column:
    """The bucket of a value: 0 for zero, positive in order of magnitude, negative for negative values; null for null and NaN. At most
    about 1470 / ln((1 + a) / (1 - a)) buckets exist (73,000 at one per cent)."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    size = F.least(F.abs(v), F.lit(LARGEST))
    i = F.ceil(F.log(size) / math.log(_gamma(alpha))) + _offset(alpha)
    return F.when(v.isNull() | F.isnan(v), None).when(size <= TINY, F.lit(0)).otherwise(F.when(v < 0, -i).otherwise(i)).cast("int")


def bucket_value(bucket: Column, alpha: float = ALPHA) -> Column:
    g = _gamma(alpha)
    size = F.pow(F.lit(g), F.abs(bucket) - _offset(alpha)) * (2 / (g + 1))
    return F.when(bucket == 0, 0.0).when(bucket < 0, -size).otherwise(size)


def sketch(df: DataFrame, value: str | Column, keys: list[str | Column] | None = None, alpha: float = ALPHA) -> DataFrame:
    """(keys, bucket, n): counts by group and bucket. Also an aggregate of a stream."""
    d = df.withColumn("bucket", log_bucket(value, alpha)).where(F.col("bucket").isNotNull())
    return d.groupBy(*(keys or []), "bucket").agg(F.count(F.lit(1)).alias("n"))


def merge(sketches: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The sketch of the rows of several, by ``keys``."""
    return sketches.groupBy(*(keys or []), "bucket").agg(F.sum("n").alias("n"))


def sketch_quantiles(sketches: DataFrame, qs: list[float], names: list[str], keys: list[str] | None = None, alpha: float = ALPHA) -> DataFrame:
    """Quantiles of merged sketches (one row a group and bucket), interpolated like ``ranking.exact_quantiles`` between order statistics that
    are each within ``alpha`` of the exact ones; so is the result, where both have one sign. A group's buckets are few."""
    keys = keys or []
    along = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("bucket")
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    d = sketches.select(*keys, bucket_value(F.col("bucket"), alpha).alias("_v"), "n",
                        (F.sum("n").over(along) - F.col("n")).alias("_before"), F.sum("n").over(whole).alias("_n"))
    aggs, out = [], []
    for q, name in zip(qs, names):
        pos = F.lit(float(q)) * (F.col("_n") - 1)
        at = lambda r: F.max(F.when((F.col("_before") <= r) & (r < F.col("_before") + F.col("n")), F.col("_v")))
        aggs += [at(F.floor(pos)).alias(f"_lo_{name}"), at(F.ceil(pos)).alias(f"_hi_{name}"), F.max(pos - F.floor(pos)).alias(f"_f_{name}")]
        out.append((F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * F.col(f"_f_{name}")).alias(name))
    g = d.groupBy(*keys).agg(*aggs) if keys else d.agg(*aggs)
    return g.select(*keys, *out)


# ------------------------------------------------------------------ heavy hitters

def _misra_gries(counters: int):
    """A task's candidates with lower bounds of their counts, and (as a row without a value) by how much any count may be too low."""
    def shrink(held: dict, error: int) -> tuple[dict, int]:
        if len(held) <= counters:
            return held, error
        cut = sorted(held.values(), reverse=True)[counters]
        return {v: n - cut for v, n in held.items() if n > cut}, error + cut

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        error, kind = 0, None
        for b in batches:
            kind = b.column(0).type
            for pair in b.column(0).drop_null().value_counts().to_pylist():
                held[pair["values"]] = held.get(pair["values"], 0) + pair["counts"]
            held, error = shrink(held, error)
        if kind is not None:
            yield pa.RecordBatch.from_arrays([pa.array([*held, None], kind), pa.array([*held.values(), error], pa.int64())], ["v", "n"])
    return run


def top_values(df: DataFrame, col: str, k: int = 1, counters: int = COUNTERS) -> DataFrame:
    """The k most frequent non-null values with their exact counts (``col``, cnt; ties: smaller value first).

    A value that no task kept occurs at most as often as the tasks' errors add up to. If the k-th candidate's exact count is larger, the
    answer is proved. Otherwise (counts too flat for ``counters``) all values are counted."""
    ensure_checkpoint_dir(df.sparkSession)
    d = df.select(F.col(col).alias("v"))
    kind = d.schema["v"].dataType.simpleString()
    order = [F.desc("cnt"), F.asc("v")]
    found = d.mapInArrow(_misra_gries(counters), f"v {kind}, n long").checkpoint()
    error = found.where(F.col("v").isNull()).agg(F.sum("n")).first()[0] or 0
    low = found.where(F.col("v").isNotNull()).groupBy("v").agg(F.sum("n").alias("low"))
    best = low.orderBy(F.desc("low")).limit(k).collect()
    least = best[-1].low if len(best) == k else 0
    kept = low.where(F.col("low") + error >= least).select("v").checkpoint()
    side = F.broadcast(kept) if kept.count() <= BROADCAST else kept
    top = d.join(side, "v", "left_semi").groupBy("v").agg(F.count(F.lit(1)).alias("cnt")).orderBy(*order).limit(k).checkpoint()
    rows = top.collect()  # k rows
    if error and (len(rows) < k or rows[-1].cnt <= error):
        top = all_counts(d).orderBy(*order).limit(k)
    return top.withColumnRenamed("v", col)


def all_counts(d: DataFrame) -> DataFrame:
    """Counts of all values of the column ``v``, by one shuffle of its distinct values."""
    return d.where(F.col("v").isNotNull()).groupBy("v").agg(F.count(F.lit(1)).alias("cnt"))
