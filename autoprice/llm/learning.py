"""Labelled rows, held-out rows and the small logistic fits that the two text classifiers share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from autoprice.llm.common import text_batches

FOLDS, HELD_OUT = 3, 1


def held_out(id_col: Column) -> Column:
    """Whether a row's label may not be learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, bound: int, id_col: str, text: str) -> DataFrame:
    """(id, text, label) of at most ``bound`` labelled rows that are not held out, the first by a hash of
    the id. An id with contradicting labels is left out; null labels and ids are none."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(id_col)))
             .groupBy(F.col(id_col).alias("_id")).agg(F.min(label).alias("label"), F.max(label).alias("_other"))
             .where("label = _other").orderBy(F.xxhash64("_id"), "_id").limit(bound).select("_id", "label"))
    # ``bound`` narrow rows: the size of this broadcast is fixed
    own = text_batches(docs).select(F.col(id_col).alias("_doc_id"), F.col(text).alias("_doc_text"))  # whatever else docs has
    return (own.join(F.broadcast(known), F.col("_doc_id") == F.col("_id"))
            .select(F.col("_id").alias("id"), F.col("_doc_text").alias("text"), F.col("label").cast("int").alias("label")))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 40) -> np.ndarray:
    """Weights of a logistic regression without intercept (add a constant column for one), by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        slope = x.T @ (y - p) - ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        step *= min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w
