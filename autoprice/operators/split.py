"""Ordering, sampling, splitting and folds.

Row position has no meaning in Spark, so every order-dependent operator takes an explicit unique
key. Random choices come from md5 of (key, seed), so a row always falls on the same side, on every
engine and every task retry. Operators that need an exact count (``round(n*f)`` rows, the first
``int(0.6 n)`` rows, contiguous folds) find the keys at the cut ranks by radix selection
(``selection.segments``): counting passes over the key columns, then a comparison in place, with no shuffle of rows.
Only folds dealt round-robin need every row's position (``global_index``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from autoprice.functions.scalar import hash32, uniform
from autoprice.operators.ranking import global_index
from autoprice.operators.selection import segments


def top_k(df: DataFrame, by: str, k: int, tie: str | None = None, descending: bool = True) -> DataFrame:
    """O1: the k largest (or smallest) rows; a bounded top-k (TakeOrderedAndProject)."""
    o = F.desc_nulls_last(by) if descending else F.asc_nulls_last(by)
    return df.orderBy(o, *([F.asc(tie)] if tie else [])).limit(k)


def head_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """O2: first n rows in key order."""
    return df.orderBy(F.asc(key)).limit(n)


def draw(key: str | Column, seed: int, salt: str = "s") -> Column:
    """Per-row uniform in [0, 1) from md5('key-salt-seed')."""
    return uniform(key, F.lit(salt), seed)


def _first_drawn(df: DataFrame, key: str, seed: int, size, out: str) -> DataFrame:
    """``df`` with the int column ``out``: 0 for the ``size(number of rows)`` rows of the smallest draws, else 1."""
    return segments(df, [hash32(key, F.lit("s"), seed), key], lambda n: [size(n)], out, bounds=(0, (1 << 32) - 1))[0]


def sample_fraction(df: DataFrame, key: str, frac: float, seed: int = 42, exact: bool = False) -> DataFrame:
    """O3: rows kept with probability ``frac`` (one pass, no shuffle). With ``exact``: exactly
    ``round(n * frac)`` rows, those with the smallest draws."""
    if not exact:
        return df.where(draw(key, seed) < F.lit(float(frac)))
    return _first_drawn(df, key, seed, lambda n: round(n * frac), "_seg").where("_seg = 0").drop("_seg")


def sample_rows(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """K random rows for inspection (the limit is the operator)."""
    return df.withColumn("_u", draw(key, seed)).orderBy("_u", key).limit(k).drop("_u")


def split_random(df: DataFrame, key: str, test_frac: float = 0.2, seed: int = 42, exact: bool = False,
                 split_col: str = "split") -> DataFrame:
    """Seeded train / test assignment. Default: md5 threshold (one pass). ``exact``: the test
    side holds exactly ``ceil(n * test_frac)`` rows (scikit-learn's size rule)."""
    if not exact:
        return df.withColumn(split_col, F.when(draw(key, seed) < F.lit(float(test_frac)), "test").otherwise("train"))
    return _test_first(df, key, seed, lambda n: math.ceil(n * test_frac), split_col)


def _test_first(df: DataFrame, key: str, seed: int, size, split_col: str) -> DataFrame:
    d = _first_drawn(df, key, seed, size, "_seg")
    return d.withColumn(split_col, F.when(F.col("_seg") == 0, "test").otherwise("train")).drop("_seg")


def split_small_guarded(df: DataFrame, key: str, seed: int = 42, split_col: str = "split") -> DataFrame:
    """Test fraction ``min(0.2, 2 / n)``; fewer than 4 rows is an error."""
    def size(n: int) -> int:  # the number of rows is known from the selection's own count
        if n < 4:
            raise ValueError(f"not enough rows to train: {n} < 4")
        return math.ceil(n * min(0.2, 2.0 / n))
    return _test_first(df, key, seed, size, split_col)


def subsample_train(df: DataFrame, key: str, split_col: str = "split", keep_frac: float = 0.5,
                    seed: int = 7) -> DataFrame:
    """Keep ``keep_frac`` of the training rows (test rows untouched)."""
    u = draw(key, seed, "sub")
    return df.where((F.col(split_col) != "train") | (u < F.lit(float(keep_frac))))


def split_time_ordered(df: DataFrame, order_key: str, old_frac: float = 0.6, new_train_frac: float = 0.7,
                       segment_col: str = "segment") -> DataFrame:
    """``old`` = first ``max(2, int(0.6 n))`` rows in order; of the rest, the first
    ``max(1, int(0.7 n_new))`` are ``new_train`` (model B's extra training rows), the tail ``new_test``."""
    def cuts(n: int) -> list[int]:
        split_point = max(2, int(n * old_frac))
        return [split_point, split_point + max(1, int(max(n - split_point, 0) * new_train_frac))]
    d, _ = segments(df, [order_key], cuts, "_seg")
    name = F.when(F.col("_seg") == 0, "old").when(F.col("_seg") == 1, "new_train").otherwise("new_test")
    return d.withColumn(segment_col, name).drop("_seg")


def union_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bag union by column name (duplicates kept)."""
    return a.unionByName(b)


def kfold_assign(df: DataFrame, order_key: str, k: int = 5, fold_col: str = "fold") -> DataFrame:
    """K contiguous folds in key order, the first ``n mod k`` folds one row longer.
    Fewer than 2k rows -> ``min(2, n // 2)`` folds; fewer than 2 folds -> no fold (NULL)."""
    def folds(n: int) -> int:
        return k if n >= 2 * k else min(2, n // 2)

    def cuts(n: int) -> list[int]:
        q, r = divmod(n, max(folds(n), 1))
        return [f * q + min(f, r) for f in range(1, folds(n))]
    d, n = segments(df, [order_key], cuts, "_seg")
    return d.withColumn(fold_col, F.col("_seg") if folds(n) >= 2 else F.lit(None).cast("int")).drop("_seg")


def kfold_stratified(df: DataFrame, key: str, label: str, k: int = 3, seed: int = 42,
                     fold_col: str = "fold") -> DataFrame:
    """Class-balanced folds: within each label, rows in md5 order are dealt round-robin.

    The position within a label is a global index over (label, draw, key) minus the label's first
    index, so even a label holding most rows is ranked by many tasks.
    """
    idx = global_index(df.withColumn("_u", draw(key, seed, "cv")), [label, "_u", key], "_i")
    # one row per label; whether it is broadcast is left to AQE's measured size
    first = idx.groupBy(F.col(label).alias("_l")).agg(F.min("_i").alias("_first"))
    out = idx.join(first, F.col(label).eqNullSafe(F.col("_l")), "inner").drop("_l")
    return out.withColumn(fold_col, ((F.col("_i") - F.col("_first")) % k).cast("int")).drop("_u", "_i", "_first")
