"""Toxicity by compression distance: how much shorter a window becomes with a dictionary of toxic text.

zstandard dictionaries are trained on labelled rows that are not held out (at most MAX_TRAIN, a
parameter). The ordinary one comes from zstandard's trainer on windows of ordinary texts. A toxic one is
the ordinary one followed by toxic segments (the match finder gives up after a number of places, nearest first): beginnings of words that tell toxic rows apart, by
``share * ln(share / ordinary share) >= LEAST_INFORMATION`` and a ratio of shares of at least LEAST_RATIO that is not chance
(G statistic of at least LEAST_EVIDENCE), less those that another begins. Sharing the ordinary part makes the compressed lengths of an ordinary window equal under both, so that the difference
isolates what only toxic text explains (separately trained dictionaries differ by several bytes on any window).

Segments that stand in the same toxic rows form a source (at most SOURCES, by average linkage), and each source has a toxic
dictionary of its own: how much an ordinary text gains differs between languages, so one weight for all does not fit.

A segment is a beginning of words, but its bytes can be ordinary within words, where the ordinary dictionary
holds them. So each byte is shifted by its place in the word before compression, and equal bytes match only at equal places;
and words that begin with a segment are left out of the ordinary sample.

A text is cut into windows of WINDOW words, each compressed with the dictionaries after the fixed LEAD, which
ends all of them: every block then holds a match, so that the fixed cost of compressed blocks is
the same under all and does not hide the gain of a single word. A window that all segments together do not shorten has no
gain; the others are compressed once per source. The gains (bytes saved) become three figures per source and
document, the share of windows with each GAINS and the largest gain, and the number of windows (log). A logistic fit on the
training rows weighs them, and its threshold with the best F1 on these rows becomes the score CUTOFF.

Defined cases: null and empty texts have no window (all gains 0); without rows of both labels, or without
a toxic segment, the score is the share of toxic training rows (0.5 without any); rows that repeat an id
are scored row by row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autoprice.llm.common import materialise, text_batches
from autoprice.llm.learning import fit_logistic, held_out, sigmoid, training_rows
from autoprice.llm.textcore import utf8

MAX_TRAIN = 20_000
MAX_SAMPLES = 40_000
WINDOW = 8
DICTIONARY_BYTES = 16_384
SEGMENT = (4, 14)
LEAST_INFORMATION, LEAST_RATIO, LEAST_EVIDENCE = 0.1, 3, 20
SOURCES = 6
GAINS = (1, 3)
CUTOFF = 0.7
LEAD = b"[a window of a text begins here]"
WHITE_SPACE = r"[\x20\x09-\x0D]+"


# what is added to a byte at each place of a word (place 0: the space before it)
_SHIFT = (np.arange(21) * 73 % 256).astype(np.uint8)


def shifted(words: list[bytes]) -> tuple[bytes, np.ndarray]:
    """The words with a space before each, every byte shifted by its place; and where each word's space stands."""
    size = np.array([len(w) + 1 for w in words], np.int64)
    begin = np.cumsum(size) - size
    raw = np.frombuffer(b"".join([b" " + w for w in words]), np.uint8)
    place = np.arange(len(raw)) - np.repeat(begin, size)
    return (raw + _SHIFT[np.minimum(place, len(_SHIFT) - 1)]).tobytes(), begin


def windows(raw: bytes) -> list[bytes]:
    if not (words := raw.split()):
        return []
    data, begin = shifted(words)
    cuts = [*begin[::WINDOW].tolist(), len(data)]
    return [b"%b%b " % (LEAD, data[i:j]) for i, j in zip(cuts, cuts[1:])]


def spelled(segment: str) -> bytes:
    """A segment (a space, a word's beginning, and a space if the word ends there) as it stands in windows."""
    word = segment[1:].encode()
    return shifted([word.rstrip(b" ")])[0] + b" " * word.endswith(b" ")


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Compressor of short windows that finds matches from four bytes in the given dictionary."""
    p = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, strategy=zstandard.STRATEGY_GREEDY, min_match=4, search_log=5, hash_log=14,
        chain_log=14, window_log=15, write_content_size=False, write_checksum=False, write_dict_id=False)
    d = zstandard.ZstdCompressionDict(content + LEAD, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=p)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=p)


@dataclass
class Distance:
    ordinary: bytes
    toxic: list[bytes]  # segments of each source
    weights: np.ndarray
    base: float
    threshold: float = 0.0

    def figures(self, texts: pa.Array) -> np.ndarray:
        data, off = utf8(texts)
        out = np.zeros((len(texts), len(self.toxic) * (len(GAINS) + 1) + 2))
        out[:, -1] = 1
        if not self.toxic:
            return out
        # filled to one size: an ordinary match lies equally far back, and costs the same, under all
        size = sum(map(len, self.toxic))
        plain, whole, *each = (compressor(self.ordinary + x.rjust(size, b"\0")).compress
                               for x in (b"", b"".join(self.toxic), *self.toxic))
        for r in range(len(texts)):
            w = windows(data[off[r]:off[r + 1]].tobytes())
            found = [(n, x) for x in w if (n := len(plain(x))) > len(whole(x))]
            for k, of in enumerate(each if found else ()):
                gains = np.array([n - len(of(x)) for n, x in found])
                at = k * (len(GAINS) + 1)
                out[r, at:at + len(GAINS)] = [10 * (gains >= g).sum() / (len(w) + WINDOW) for g in GAINS]
                out[r, at + len(GAINS)] = np.clip(gains.max(), 0, 12) / 4
            out[r, -2] = np.log1p(len(w)) / 4
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.toxic:
            return np.full(len(x), self.base)
        return sigmoid(x @ self.weights - self.threshold + np.log(CUTOFF / (1 - CUTOFF)))


def best_threshold(strength: np.ndarray, label: np.ndarray) -> float:
    """The threshold with the best F1 (halfway to the next strength below)."""
    order = np.argsort(-strength, kind="stable")
    s, y = strength[order], label[order]
    f1 = 2 * np.cumsum(y) / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][s[1:] == s[:-1]] = 0  # equal strengths stay together
    k = int(f1.argmax())
    return float(s[k] if k + 1 == len(s) else (s[k] + s[k + 1]) / 2)


def sources(held: np.ndarray, most: int = SOURCES) -> list[list[int]]:
    """Segments (columns) in at most ``most`` groups of those that the same rows hold: average linkage by cosine."""
    size = np.sqrt(np.maximum(held.sum(axis=0), 1))
    near = (held.T @ held) / np.outer(size, size)
    groups, n = [[i] for i in range(held.shape[1])], np.ones(held.shape[1])
    while len(groups) > most:
        mean = near / np.outer(n, n)
        mean[np.tril_indices(len(groups))] = -1
        a, b = np.unravel_index(int(mean.argmax()), mean.shape)
        near[a] += near[b]
        near[:, a] += near[:, b]
        near, n[a] = np.delete(np.delete(near, b, 0), b, 1), n[a] + n[b]
        groups[a] += groups.pop(b)
        n = np.delete(n, b)
    return [sorted(g) for g in groups]


def evidence(a: int, n: int, b: int, m: int) -> float:
    """G statistic of a in n against b in m rows."""
    p = (a + b) / (n + m)
    cells = ((a, n * p), (n - a, n * (1 - p)), (b, m * p), (m - b, m * (1 - p)))
    return 2 * sum(x * np.log(x / want) for x, want in cells if x)


def toxic_segments(rows: DataFrame, n_toxic: int, n_ordinary: int) -> list[list[str]]:
    """Beginnings of words that set the toxic rows apart, longest common form of each, by source."""
    least, most = SEGMENT
    words = F.array_distinct(F.split(F.coalesce("text", F.lit("")), WHITE_SPACE))
    padded = F.transform(F.filter(words, lambda w: w != ""), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))
    starts = F.flatten(F.transform(padded, lambda w: F.transform(
        F.sequence(F.lit(least), F.greatest(F.lit(least), F.least(F.length(w), F.lit(most)))), lambda k: F.substring(w, 1, k))))
    each = rows.select("label", F.explode(F.array_distinct(starts)).alias("segment"))
    # a segment with the information needed is in this share of the toxic rows at least
    share = LEAST_INFORMATION / np.log(n_ordinary + 1.0)
    common = (each.where("label = 1").groupBy("segment").agg(F.count("*").alias("toxic"))
              .where(F.col("toxic") >= max(2, share * n_toxic)))
    # at most (beginnings per row) / share segments pass, whatever the number of rows
    common = materialise(common, "segments")
    ordinary = (each.where("label = 0").join(F.broadcast(common.select("segment")), "segment")
                .groupBy("segment").agg(F.count("*").alias("ordinary")))
    got = common.join(ordinary, "segment", "left").fillna(0).collect()
    ratio = lambda r: (r.toxic / n_toxic) / ((r.ordinary + 1) / n_ordinary)
    apart = {r.segment: r.toxic for r in got
             if ratio(r) >= LEAST_RATIO and evidence(r.toxic, n_toxic, r.ordinary, n_ordinary) >= LEAST_EVIDENCE and r.toxic / n_toxic * np.log(ratio(r)) >= LEAST_INFORMATION}
    longer: dict[str, int] = {}
    for s, n in apart.items():
        longer[s[:-1]] = max(n, longer.get(s[:-1], 0))
    kept = [s for s, n in apart.items() if longer.get(s, 0) < 0.7 * n]
    # a longer segment adds little but ordinary endings
    forms = set(kept)
    kept = sorted((s for s in kept if not any(s[:k] in forms for k in range(least, len(s)))), key=lambda s: (apart[s], s))
    place = {s: i for i, s in enumerate(kept)}
    held = np.zeros((n_toxic, len(kept)))
    by_row = (rows.where("label = 1").select("id", F.array_distinct(starts).alias("s"))
              .select(F.array_intersect("s", F.array(*map(F.lit, kept)).cast("array<string>")).alias("s")).collect())
    for i, r in enumerate(by_row):
        held[i, [place[s] for s in r.s]] = 1
    return [[kept[i] for i in g] for g in sources(held)]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text: str = "text",
        max_train: int = MAX_TRAIN) -> Distance:
    spark = docs.sparkSession
    rows = materialise(training_rows(docs, labels, label, max_train, id_col, text), "toxicity-rows")
    count = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    n_toxic, n_ordinary = count.get(1, 0), count.get(0, 0)
    base = n_toxic / (n_toxic + n_ordinary) if count else 0.5
    nothing = Distance(b"", [], np.zeros(2), base)
    if not n_toxic or not n_ordinary:
        return nothing
    segments = toxic_segments(rows, n_toxic, n_ordinary)
    if not segments:
        return nothing

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column(0))
            got = [w[len(LEAD):] for r in range(batch.num_rows) for w in windows(data[off[r]:off[r + 1]].tobytes())]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.binary())], names=["w"])

    sample = (rows.where("label = 0").select("text").mapInArrow(cut, "w binary")
              .orderBy(F.xxhash64("w"), "w").limit(MAX_SAMPLES).collect())
    # else the ordinary dictionary explains what it is to be compared on
    forms = sorted({spelled(s) for g in segments for s in g}, key=lambda f: (len(f), f))
    told = re.compile(b"|".join(re.escape(f.rstrip(b" ")) + (b"(?= )" if f.endswith(b" ") else b"[^ ]*") for f in forms))
    sample = [told.sub(b"", bytes(r.w)) for r in sample]
    try:
        ordinary = zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except zstandard.ZstdError:  # too little text for the trainer: the text itself is the dictionary
        ordinary = b"".join(sample)[-DICTIONARY_BYTES:]
    model = Distance(ordinary, [b"".join(map(spelled, g)) for g in segments], np.zeros(2), base)
    sent = spark.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = sent.value.figures(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(x.tolist(), pa.list_(pa.float64()))],
                                             names=["id", "label", "x"])

    id_type = rows.schema["id"].dataType.simpleString()
    got = sorted(rows.mapInArrow(measure, f"id {id_type}, label int, x array<double>").collect())
    x, y = np.array([r.x for r in got]), np.array([float(r.label) for r in got])
    model.weights = fit_logistic(x, y, ridge=1e-1)
    model.threshold = best_threshold(x @ model.weights, y)
    return model


def score(docs: DataFrame, model: Distance, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> pa.Array:
        return pa.array(sent.value.score(sent.value.figures(texts)))

    scored = text_batches(docs).select(F.col(id_col).alias("id"), F.arrow_udf(run, "double")(F.col(text)).alias("score"))
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
                         (F.col("score") >= CUTOFF).cast("int").alias("predicted"))
