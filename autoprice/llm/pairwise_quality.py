"""Quality scores by Bradley-Terry pairwise ranking.

Every document has a strength ``s = w . f(text)``; a document of label 1 is preferred to one of label 0
with probability ``sigmoid(s_1 - s_0)``. The weights are learned by logistic loss on the feature
differences of preference pairs, drawn from a bounded number of labelled rows (MAX_TRAIN rows, PAIRS
pairs, both parameters). The cutoff is a quantile of the training rows' strengths, at the level that
separates their labels best, and the score is ``sigmoid(s - cutoff)``: above one half beyond it.

Features come from the text alone and are computed in Arrow batches; each document is scored in the one
pass over the table.

Defined cases: null and empty texts have all counts zero and a score like any other; without rows of both
labels every score is 0.5; rows that repeat an id are scored row by row; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autoprice.llm.common import text_batches
from autoprice.llm.learning import fit_logistic, held_out, sigmoid, training_rows
from autoprice.llm.textcore import shingles, slices, split_words, utf8

MAX_TRAIN = 20_000
PAIRS = 100_000

_MARKS = [b"#*$%&<>", b"|", b"!?", b".,;:", b"0123456789", bytes(range(65, 91)), b"\n"]
_TABLES = np.zeros((len(_MARKS), 256), bool)
for _t, _m in zip(_TABLES, _MARKS):
    _t[list(_m)] = True
N_FEATURES = len(_MARKS) + 8


def _repeats(h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Per row, the share of its hashes that repeat an earlier one."""
    n = np.bincount(row, minlength=rows)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    same = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    return np.bincount(row[1:][same], minlength=rows) / np.maximum(n, 1)


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of features per text of a slice."""
    w = split_words(data, off)
    rows, bounds = len(off) - 1, off - off[0]
    total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[bounds])
    n, size, of = np.diff(w.first), np.maximum(np.diff(bounds), 1), w.row_of()
    length = (w.end - w.start).astype(float)
    some = np.maximum(n, 1)
    mean = np.bincount(of, length, rows) / some
    spread = np.sqrt(np.maximum(np.bincount(of, length ** 2, rows) / some - mean ** 2, 0))
    next_same = np.zeros(len(w.hash), bool)
    next_same[1:] = (w.hash[1:] == w.hash[:-1]) & (of[1:] == of[:-1])
    out = [total(t[w.buf]) / size for t in _TABLES]
    out += [np.log1p(n), (n == 0).astype(float), mean / 10, spread / 10, _repeats(w.hash, of, rows),
            _repeats(*shingles(w, 3), rows), _repeats(*shingles(w, 8), rows), np.bincount(of, next_same, rows) / some]
    return np.stack(out, axis=1)


def _batch_features(batch_text: pa.Array) -> np.ndarray:
    data, off = utf8(batch_text)
    parts = [features(data, off[i:j + 1]) for i, j in slices(off)]
    return np.concatenate(parts) if parts else np.zeros((0, N_FEATURES))


@dataclass
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cutoff: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.strength(x) - self.cutoff)


def best_quantile(strength: np.ndarray, label: np.ndarray) -> float:
    """The quantile of the strengths whose level leaves the fewest rows on the wrong side (halfway to the next)."""
    order = np.argsort(strength, kind="stable")
    s, y = strength[order], label[order]
    wrong = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0]])
    ok = np.concatenate([[True], s[1:] > s[:-1], [True]])
    level = int(np.flatnonzero(ok)[np.argmin(wrong[ok])])
    if level in (0, len(s)):
        return float(s[0] - 1 if level == 0 else s[-1] + 1)
    return float((s[level - 1] + s[level]) / 2)


def learn(x: np.ndarray, label: np.ndarray, pairs: int = PAIRS) -> Ranking | None:
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return None
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    model = Ranking(mean, scale, np.zeros(x.shape[1]), 0.0)
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.Generator(np.random.PCG64(7))
    n = min(pairs, 16 * len(x))
    difference = z[rng.choice(good, n)] - z[rng.choice(bad, n)]
    sign = np.where(np.arange(n) % 2 == 0, 1.0, -1.0)  # either order of a pair, so both outcomes occur
    model.weights = fit_logistic(difference * sign[:, None], (sign > 0).astype(float), ridge=1.0)
    model.cutoff = best_quantile(model.strength(x), label)
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text: str = "text",
        max_train: int = MAX_TRAIN) -> Ranking | None:
    rows = training_rows(docs, labels, label, max_train, id_col, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _batch_features(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["id", "label", "x"])

    id_type = rows.schema["id"].dataType.simpleString()
    got = sorted(rows.mapInArrow(run, f"id {id_type}, label int, x array<double>").collect())
    if not got:
        return None
    return learn(np.array([r.x for r in got]), np.array([r.label for r in got]))


def score(docs: DataFrame, model: Ranking | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every document."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> pa.Array:
        x = _batch_features(texts)
        return pa.array(np.full(len(x), 0.5) if known.value is None else known.value.score(x))

    scored = text_batches(docs).select(F.col(id_col).alias("id"), F.arrow_udf(run, "double")(F.col(text)).alias("score"))
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
