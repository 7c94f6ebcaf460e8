"""Order statistics without funnelling a group through one task.

Two building blocks used by several operators:

``global_index``   0-based position of every row in a total order (time-ordered splits, k-folds).
``exact_quantiles`` exact linear-interpolated quantiles per group (medians, quartiles, p95).

Both range-partition the data on (group, value), so one hot group is spread over many
partitions, then derive each partition's starting rank from small per-partition totals. The
range-partitioned data is checkpointed to the reliable checkpoint directory: that pins the
sampled range bounds, so recomputation after a lost executor sees identical partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from autoprice.session import ensure_checkpoint_dir


def _num_partitions(df: DataFrame, override: int | None = None) -> int:
    if override:
        return override
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def global_index(df: DataFrame, order_cols: list[str], index_col: str = "_idx",
                 num_partitions: int | None = None, with_count: bool = False):
    """Add a 0-based ``index_col`` following ``order_cols`` (which must be unique); with
    ``with_count`` also return the row count (known from the partition totals, no extra job).

    Plan: range shuffle on the order key -> local sort -> tag (partition id, local position)
    -> checkpoint. Per-partition row counts (one number per partition, so bounded by the
    partition count, not the data) give each partition's offset, joined back as a table of one row
    per partition.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = _num_partitions(df, num_partitions)
    mid = F.monotonically_increasing_id()
    tagged = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_local", mid.bitwiseAND(F.lit((1 << 33) - 1))))
    tagged = tagged.checkpoint(eager=True)
    counts = dict(tagged.groupBy("_pid").count().collect())
    offsets, acc = [], 0
    for p in range(max(counts.keys(), default=-1) + 1):
        offsets.append((p, acc))
        acc += counts.get(p, 0)
    # one row per partition: the broadcast is bounded by the partition count
    off = F.broadcast(spark.createDataFrame(offsets, "_pid int, _off bigint"))
    out = tagged.join(off, "_pid").withColumn(index_col, F.col("_off") + F.col("_local")).select(*df.columns, index_col)
    return (out, acc) if with_count else out


# Up to this many distinct (group, value) pairs, Spark's weighted ``percentile`` runs directly on the
# histogram: its per-group buffer can never exceed the (counted) histogram size. The range path beyond
# interpolates by the same formula, so the results are equal to the last bit on either side.
SMALL_HISTOGRAM_ROWS = 1_000_000


def _histogram(df: DataFrame, value: str | Column, g: list[str]) -> DataFrame:
    """Distinct (group, value) pairs with their count ``_c`` (NULL and NaN values skipped; repeated
    values combined map-side before the shuffle), checkpointed."""
    ensure_checkpoint_dir(df.sparkSession)
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    hist = (df.select(*g, v.alias("_v"))
            .where(F.col("_v").isNotNull() & ~F.isnan("_v"))
            .groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c")))
    return hist.checkpoint(eager=True)


def _range_partition(hist: DataFrame, g: list[str], num_partitions: int | None) -> DataFrame:
    """The histogram range-partitioned on (group, value), sorted, tagged with ``_pid`` and
    checkpointed (pins the sampled range bounds against recomputation)."""
    n = _num_partitions(hist, num_partitions)
    part = (hist.repartitionByRange(n, *g, "_v").sortWithinPartitions(*g, "_v")
            .withColumn("_pid", F.spark_partition_id()))
    return part.checkpoint(eager=True)


def exact_quantiles(df: DataFrame, value: str | Column, qs: list[float], names: list[str],
                    group_cols: list[str] | None = None, num_partitions: int | None = None,
                    small_rows: int = SMALL_HISTOGRAM_ROWS, histogram: DataFrame | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation between order statistics
    (the pandas / numpy default, Spark ``percentile``, DuckDB ``quantile_cont``).

    1. (group, value, count) histogram, checkpointed and counted. If it has at most ``small_rows``
       pairs, Spark's weighted ``percentile`` runs on it directly (bounded by that count).
    2. Otherwise the histogram is range-partitioned on (group, value), so a hot group spreads over
       many partitions, and checkpointed; per (partition, group) totals give each slice's starting
       rank within its group (a group spans at most as many slices as there are partitions).
    3. Only the slices that contain a target rank are kept (at most a few per group; the slice
       table is checkpointed and broadcast when a count proves it small), and only their rows get a
       running count: a global median re-reads about one partition of the histogram, not all of it.

    Groups with no non-null value are absent from the result; callers left-join or coalesce as
    the operator requires.
    """
    g = list(group_cols or [])
    hist = histogram if histogram is not None else _histogram(df, value, g)
    if hist.count() <= small_rows:
        aggs = [F.percentile("_v", float(q), F.col("_c")).alias(n) for q, n in zip(qs, names)]
        return hist.groupBy(*g).agg(*aggs) if g else hist.agg(*aggs)
    part = _range_partition(hist, g, num_partitions)
    tot = part.groupBy("_pid", *g).agg(F.sum("_c").alias("_pc"))
    # per group at most one row per range partition (without groups: one row per partition)
    wg = Window.partitionBy(*g).orderBy("_pid")
    offs = tot.select("_pid", *g, "_pc",
                      F.coalesce(F.sum("_pc").over(wg.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
                      F.sum("_pc").over(Window.partitionBy(*g)).alias("_n"))
    offs = offs.checkpoint(eager=True)  # one row per (partition, group) slice: small
    ranks = []
    for q in qs:
        pos = F.lit(float(q)) * (F.col("_n") - 1)
        ranks += [F.floor(pos), F.ceil(pos)]
    inside = [(F.col("_off") <= r) & (r < F.col("_off") + F.col("_pc")) for r in ranks]
    hit = inside[0]
    for c in inside[1:]:
        hit = hit | c
    targets = offs.where(hit).select(F.col("_pid").alias("_tpid"), *[F.col(c).alias(f"_t_{c}") for c in g], "_off", "_n")
    cond = part["_pid"] == targets["_tpid"]
    for c in g:
        cond = cond & part[c].eqNullSafe(targets[f"_t_{c}"])
    rows = part.join(targets, cond, "inner").drop("_tpid", *[f"_t_{c}" for c in g])
    wl = Window.partitionBy("_pid", *g).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    rh = rows.withColumn("_before", F.col("_off") + F.coalesce(F.sum("_c").over(wl), F.lit(0)))
    picks, aggs = [], []
    for q, name in zip(qs, names):
        pos = F.lit(float(q)) * (F.col("_n") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        cov_lo = (F.col("_before") <= lo) & (lo < F.col("_before") + F.col("_c"))
        cov_hi = (F.col("_before") <= hi) & (hi < F.col("_before") + F.col("_c"))
        picks.append(cov_lo | cov_hi)
        aggs += [F.max(F.when(cov_lo, F.col("_v"))).alias(f"_lo_{name}"),
                 F.max(F.when(cov_hi, F.col("_v"))).alias(f"_hi_{name}"),
                 F.max(pos).alias(f"_pos_{name}")]
    keep = picks[0]
    for p in picks[1:]:
        keep = keep | p
    sel = rh.where(keep).groupBy(*g).agg(*aggs) if g else rh.where(keep).agg(*aggs)
    # the interpolation formula of Spark's ``percentile``
    outs = []
    for nm in names:
        lo, hi, pos = F.col(f"_lo_{nm}"), F.col(f"_hi_{nm}"), F.col(f"_pos_{nm}")
        between = (F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi
        outs.append(F.when(lo == hi, lo).otherwise(between).alias(nm))
    return sel.select(*g, *outs)


def quantiles(df: DataFrame, value: str | Column, qs: list[float], names: list[str],
              group_cols: list[str] | None = None, approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """Exact quantiles (``exact_quantiles``) or, with ``approx``, Spark's ``percentile_approx``
    sketch: one aggregate with bounded memory per group, rank error about 1 / ``accuracy``."""
    if not approx:
        return exact_quantiles(df, value, qs, names, group_cols)
    g = list(group_cols or [])
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    d = df.select(*g, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    aggs = [F.percentile_approx("_v", float(q), accuracy).alias(n) for q, n in zip(qs, names)]
    return d.groupBy(*g).agg(*aggs) if g else d.agg(*aggs)
