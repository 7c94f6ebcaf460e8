"""Least squares on any number of features from mergeable Gram matrices.

One scan gives, for each group of rows (fold, segment), the Gram matrix of (1, x - c, y - c_y): a sum over rows, so parts of
any tasks and groups add, and a group's complement is the total less the group. From it follow the coefficients of
every fold's complement and every A/B segment, and R2 and RMSE of any model on any group, without another scan.

Tasks multiply their rows block by block (BLAS) and send one matrix a group; Spark sums the matrices entry by entry. What
reaches the driver is groups x (features + 2)^2 / 2 numbers, whatever the rows.

``c`` is the mean of a few rows, and only keeps sums of squares from cancelling: results do not depend on it beyond
rounding. Rows with a null or NaN in a feature or in y are left out. A feature that is constant, or is a linear combination of the others,
takes no weight of its own (least norm over the scaled features).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from autoprice.operators.metrics import regression_aggs, regression_from_aggs
from autoprice.operators.split import kfold_assign, split_time_ordered

CENTRE_ROWS = 1000   # rows whose mean is the common offset
RANK_TOLERANCE = 1e-10


@dataclass
class Linear:
    """y = intercept + sum of coefficient * feature."""
    features: list[str]
    intercept: float
    coefficients: list[float]

    def predict(self) -> Column:
        """The prediction as an expression over the feature columns."""
        return reduce(lambda a, b: a + b, [F.lit(w) * F.col(c).cast("double") for c, w in zip(self.features, self.coefficients)], F.lit(self.intercept))


@dataclass
class Gram:
    """Sums of products of (1, x - centre, y - centre); ``+`` and ``-`` join and remove groups."""
    features: list[str]
    centre: np.ndarray  # of the features and y
    matrix: np.ndarray

    def __add__(self, other: Gram) -> Gram:
        return Gram(self.features, self.centre, self.matrix + other.matrix)

    def __sub__(self, other: Gram) -> Gram:
        return Gram(self.features, self.centre, self.matrix - other.matrix)

    @property
    def n(self) -> int:
        return round(self.matrix[0, 0])

    def moments(self) -> tuple[np.ndarray, np.ndarray]:
        """(means, covariances) of the offset features and y."""
        mean = self.matrix[0, 1:] / self.n
        cov = self.matrix[1:, 1:] / self.n - np.outer(mean, mean)
        flat = np.diag(cov) <= 1e-14 * np.diag(self.matrix)[1:] / self.n  # constant up to rounding
        cov[flat, :] = cov[:, flat] = 0.0
        return mean, cov

    def fit(self) -> Linear | None:
        """Least squares; None without rows."""
        if not self.n:
            return None
        mean, cov = self.moments()
        scale = np.sqrt(np.diag(cov)[:-1])
        used = scale > 0
        beta = np.zeros(len(scale))
        if used.any():
            unit = 1 / scale[used]
            beta[used] = unit * (np.linalg.pinv(cov[:-1, :-1][np.ix_(used, used)] * np.outer(unit, unit), RANK_TOLERANCE, hermitian=True)
                                 @ (cov[:-1, -1][used] * unit))
        intercept = mean[-1] + self.centre[-1] - beta @ (mean[:-1] + self.centre[:-1])
        return Linear(self.features, float(intercept), beta.tolist())

    def score(self, model: Linear) -> tuple[int, float | None, float | None]:
        """(rows, R2, RMSE) of ``model`` on this group: R2 as in ``metrics.regression_from_aggs``."""
        if not self.n:
            return 0, None, None
        mean, cov = self.moments()
        w = np.array([*model.coefficients, -1.0])
        offset = model.intercept + np.array(model.coefficients) @ (mean[:-1] + self.centre[:-1]) - (mean[-1] + self.centre[-1])
        mse, var = max(float(w @ cov @ w), 0.0) + float(offset) ** 2, float(cov[-1, -1])
        if self.n < 2:
            return self.n, None, mse ** .5
        return self.n, (1 - mse / var if var else float(mse == 0)), mse ** .5


def _known(features: list[str], y: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).cast("double").isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in [*features, y]])


def _products(centre: list[float]):
    size = len(centre) + 1
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            group = batch.column(0).to_numpy(zero_copy_only=False)
            z = np.ones((batch.num_rows, size))
            for i, c in enumerate(centre):
                z[:, i + 1] = batch.column(i + 1).to_numpy(zero_copy_only=False) - c
            for g in np.unique(group).tolist():
                rows = z[group == g]
                held[g] = held.get(g, 0.0) + rows.T @ rows
        groups = sorted(held)
        yield pa.RecordBatch.from_arrays([pa.array(groups, pa.int32()), pa.array([held[g][upper].tolist() for g in groups], pa.list_(pa.float64()))],
                                         ["g", "m"])
    return run


def grams(df: DataFrame, features: list[str], y: str, group: str | None = None) -> dict[int, Gram]:
    """The Gram matrix of each value of the integer column ``group`` (null: left out; without one: of all rows as 0)."""
    known = df.where(_known(features, y))
    if group is not None:
        known = known.where(F.col(group).isNotNull())
    values = [F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate([*features, y])]
    head = known.select(*values).limit(CENTRE_ROWS)
    centre = [v or 0.0 for v in head.agg(*[F.avg(c) for c in head.columns]).first()]
    rows = known.select((F.lit(0) if group is None else F.col(group)).cast("int").alias("g"), *values)
    parts = rows.mapInArrow(_products(centre), "g int, m array<double>")
    whole = parts.select("g", F.posexplode("m").alias("i", "s")).groupBy("g", "i").agg(F.sum("s").alias("s")).collect()
    size = len(features) + 2
    upper = np.triu_indices(size)
    out: dict[int, Gram] = {}
    for r in whole:
        m = out.setdefault(r.g, Gram(features, np.array(centre), np.zeros((size, size)))).matrix
        i, j = upper[0][r.i], upper[1][r.i]
        m[i, j] = m[j, i] = r.s
    return out


def fit_linear(df: DataFrame, features: list[str], y: str) -> Linear | None:
    """M2: ordinary least squares from one scan; None where no row is complete."""
    g = grams(df, features, y)
    return g[0].fit() if g else None


def cross_validate_linear(df: DataFrame, key: str, features: list[str], y: str, k: int = 5) -> DataFrame:
    """M4: contiguous k folds in key order (O10) over the complete rows; each fold is scored by the model of the others. One
    scan gives all fits and scores. Rows: fold, n, intercept, coefficients, r2, rmse, and over the folds cv_r2_mean, cv_r2_std,
    cv_rmse_mean, cv_rmse_std (population deviation). Too few rows for two folds give no rows."""
    folds = kfold_assign(df.select(key, *features, y).where(_known(features, y)), key, k, "_fold")
    by = grams(folds, features, y, "_fold")
    total = reduce(lambda a, b: a + b, by.values()) if by else None
    rows = []
    for f in sorted(by):
        model = (total - by[f]).fit()
        rows.append((f, *by[f].score(model), model))
    known = [[r[i] for r in rows if r[i] is not None] for i in (2, 3)]
    spread = [v for x in known for v in ((float(np.mean(x)), float(np.std(x))) if x else (None, None))]
    return df.sparkSession.createDataFrame(
        [(f, n, m.intercept, m.coefficients, r2, rmse, *spread) for f, n, r2, rmse, m in rows],
        "fold int, n long, intercept double, coefficients array<double>, r2 double, rmse double, "
        "cv_r2_mean double, cv_r2_std double, cv_rmse_mean double, cv_rmse_std double")


def time_ab_linear(df: DataFrame, order_key: str, features: list[str], y: str) -> DataFrame:
    """Model A fitted on the old segment (O8) and tested on all newer rows; B fitted on old plus the first 70 per cent of
    the new and tested on the rest. One scan fits both; a second scores both (mean absolute error is no function of the
    Gram matrix). Rows: model, n_train, n_test, r2, mae, rmse; a test set of fewer than two rows has R2 0, a model without training rows none."""
    seg = split_time_ordered(df.select(order_key, *features, y).where(_known(features, y)), order_key, segment_col="_segment")
    number = F.when(F.col("_segment") == "old", 0).when(F.col("_segment") == "new_train", 1).otherwise(2)
    seg = seg.withColumn("_part", number)
    by = grams(seg, features, y, "_part")
    rows = []
    for name, train, test in (("A", [0], F.col("_part") > 0), ("B", [0, 1], F.col("_part") == 2)):
        parts = [by[p] for p in train if p in by]
        model = reduce(lambda a, b: a + b, parts).fit() if parts else None
        n_train = sum(p.n for p in parts)
        yhat = model.predict() if model else F.lit(None).cast("double")
        rows.append(seg.where(test).select(F.lit(name).alias("model"), F.lit(n_train).cast("long").alias("n_train"),
                                           F.col(y).cast("double").alias("_y"), yhat.alias("_yhat")))
    both = rows[0].unionByName(rows[1]).groupBy("model", "n_train").agg(*regression_aggs("_y", "_yhat"))
    return both.select("model", "n_train", *regression_from_aggs("zero")).select("model", "n_train", F.col("n").alias("n_test"), "r2", "mae", "rmse")
