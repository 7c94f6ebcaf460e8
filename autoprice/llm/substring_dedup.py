"""Removal of repeated passages by suffix automata over reference shards.

A window is WINDOW consecutive words. A word goes when a window that covers it has the same words as a
window that starts earlier in the corpus (smaller id, or the same document further ahead); windows are
judged on the input.

Matching every document against an automaton of every shard would cost documents x shards, so text is
routed first: equal windows choose the same anchor, the leftmost least hash among their runs of ANCHOR
words, and neighbouring windows mostly share one (13 runs a window: about one anchor in seven words).

1. Anchors that occur once cannot lie in a repeated window; their windows stay. Only counts and
   fixed-size anchor rows are shuffled, never texts.
2. For the others, the words from an anchor's first window to its last are its span. Spans equal to an
   earlier span of the anchor go whole; the first of each is reference text.
3. Reference spans are dealt by anchor to shards of about SHARD_WORDS words. In each shard one suffix
   automaton reads them in corpus order; the matching statistic after each word tells whether the window
   that ends there has been read before. So each shard's automaton meets just the text that can match it.
   An anchor with more than HOT_SPANS different spans (a short common line in ever new surroundings) is
   dealt by whole windows instead, each with its first occurrence as the reference.
4. The windows that go are gathered per document (bounded by its own length), and its words are cut.

Defined cases: a null text has no words; fewer than WINDOW words lose nothing; a row that repeats an id
must repeat its text, and both rows stay whole on that account (equal windows at the same place);
a row with a null id is neither cut nor a reason to cut; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autoprice.llm.common import broadcast_checked, fresh, materialise, releasing
from autoprice.llm.suffix_automaton import SuffixAutomaton
from autoprice.llm.textcore import _BASE, _PLACE, U, mix, powers, slices, split_words, utf8

WINDOW = 20
ANCHOR = 8
SHARD_WORDS = 100_000
HOT_SPANS = 4096
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))


def _range_hash(h: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words ``begin:end`` of each pair, from prefix sums of a polynomial."""
    total = np.concatenate([np.zeros(1, U), np.cumsum(h * powers(len(h)), dtype=U)])
    back = np.full(len(h) + 1, _INVERSE, U)
    back[0] = 1
    back = np.multiply.accumulate(back)
    return mix((total[end] - total[begin]) * back[begin] + (end - begin).astype(U))


def anchors(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor hash, span hash, row, first window, windows - 1) of every anchor, windows counted within the row."""
    n, counts = len(h), np.diff(first)
    row = np.repeat(np.arange(len(counts)), counts)
    left = first[1:][row] - np.arange(n)
    at = np.flatnonzero(left >= WINDOW)
    if not len(at):
        return (np.zeros(0, U),) * 2 + (np.zeros(0, np.int64),) * 3
    runs = np.zeros(n - ANCHOR + 1, U)
    for j in range(ANCHOR):
        runs += h[j:n - ANCHOR + 1 + j] * _PLACE[j]
    runs = mix(runs)
    place = at + np.lib.stride_tricks.sliding_window_view(runs, WINDOW - ANCHOR + 1)[at].argmin(axis=1)
    begin = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    lo, hi = at[begin], at[np.append(begin[1:], len(at)) - 1]
    return runs[place[begin]], _range_hash(h, lo, hi + WINDOW), row[lo], lo - first[row[lo]], hi - lo


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(U, copy=False).view(np.int64))


def repeated_windows(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, place): windows to remove, ``place`` = first window * 32 + further windows in a row."""
    spark = docs.sparkSession
    base = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    id_type = base.schema["id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column(1))
            for i, j in slices(off):
                w = split_words(data, off[i:j + 1])
                anchor, span, row, lo, more = anchors(w.hash, w.first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row + i)), _signed(anchor), _signed(span), pa.array(lo * 32 + more)],
                    names=["id", "anchor", "span", "place"])

    found = base.mapInArrow(releasing(find), f"id {id_type}, anchor bigint, span bigint, place bigint")
    # a table of its own, so that both sides of the join come straight from shuffles and a hot anchor is split
    again = materialise(found.groupBy("anchor").count().where("count > 1").select("anchor"), "again")
    found = materialise(found.join(again, "anchor", "left_semi"), "repeated-anchors")
    spans = materialise(found.groupBy("anchor", "span").agg(F.min(F.struct("id", "place")).alias("first")), "spans")
    later = (found.join(spans, ["anchor", "span"])
             .where((F.col("id") != F.col("first.id")) | (F.col("place") != F.col("first.place"))).select("id", "place"))
    later = materialise(later, "later-spans")

    several = spans.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    reference = materialise(spans.join(several, "anchor").select(
        "anchor", F.col("first.id").alias("id"), F.col("first.place").alias("place"), (F.col("n") > HOT_SPANS).alias("hot")),
        "reference")
    shards = max(1, -(-reference.count() * (WINDOW + 7) // SHARD_WORDS))
    wanted = materialise(reference.groupBy("id").agg(F.collect_set(F.struct("anchor", "place", "hot")).alias("spans")),
                         "wanted")
    texts = base.join(broadcast_checked(wanted.select("id")), "id", "left_semi").join(wanted, "id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column("text"))
            lists = batch.column("spans").to_pylist()
            for i, j in slices(off):
                w = split_words(data, off[i:j + 1])
                rows = []
                for r in range(i, j):
                    h = w.hash[w.first[r - i]:w.first[r - i + 1]]
                    for s in lists[r]:
                        lo, more = s["place"] >> 5, s["place"] & 31
                        shard = s["anchor"] % shards
                        if s["hot"]:
                            rows += [(r, shard, (lo + k) * 32, True, h[lo + k:lo + k + WINDOW].tobytes()) for k in range(more + 1)]
                        else:
                            rows.append((r, shard, s["place"], False, h[lo:lo + more + WINDOW].tobytes()))
                c = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(c[0], pa.int64())), pa.array(c[1], pa.int64()),
                     pa.array(c[2], pa.int64()), pa.array(c[3], pa.bool_()), pa.array(c[4], pa.binary())],
                    names=["id", "shard", "place", "hot", "words"])

    pieces = materialise(texts.mapInArrow(releasing(cut), f"id {id_type}, shard bigint, place bigint, hot boolean, words binary")
                         .distinct(), "pieces")
    hot = pieces.where("hot").select("id", "place", F.unhex(F.md5("words")).alias("key"))
    heads = hot.groupBy("key").agg(F.min(F.struct("id", "place")).alias("first"))
    hot = (hot.join(heads, "key").where((F.col("id") != F.col("first.id")) | (F.col("place") != F.col("first.place")))
           .select("id", "place"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, automaton = None, None
        for batch in batches:
            out_row, out_place = [], []
            for r, (s, place, words) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("shard", "place", "words")))):
                if s != shard:
                    shard, automaton = s, SuffixAutomaton()
                automaton.start()
                extend = automaton.extend
                lo = place >> 5
                for k, symbol in enumerate(np.frombuffer(words, np.int64).tolist()):
                    if extend(symbol) >= WINDOW:
                        out_row.append(r)
                        out_place.append((lo + k + 1 - WINDOW) * 32)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(out_row, pa.int64())),
                                              pa.array(out_place, pa.int64())], names=["id", "place"])

    matched = (pieces.where("not hot").select("shard", "id", "place", "words").repartition("shard")
               .sortWithinPartitions("shard", "id", "place").mapInArrow(releasing(read), f"id {id_type}, place bigint"))
    return later.unionByName(hot).unionByName(matched)


def _mask(n: int, places: list[int] | None) -> np.ndarray:
    gone = np.zeros(n + 1, np.int64)
    if places:
        p = np.array(places, np.int64)
        np.add.at(gone, np.minimum(p >> 5, n), 1)
        np.add.at(gone, np.minimum((p >> 5) + (p & 31) + WINDOW, n), -1)
    return np.cumsum(gone[:-1]) > 0


def _with_places(docs: DataFrame, id_col: str, text: str, name: str) -> DataFrame:
    gone = (repeated_windows(docs, id_col, text).groupBy(F.col("id").alias(name + "_id"))
            .agg(F.collect_list("place").alias(name)))
    gone = materialise(gone, "windows")
    return docs.join(gone, docs[id_col] == F.col(name + "_id"), "left").drop(name + "_id")


def passage_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)."""
    both = _with_places(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), "id", "text", "places")
    id_type = both.schema["id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column("text"))
            n, removed, sha = [], [], []
            for r, places in enumerate(batch.column("places").to_pylist()):
                words = data[off[r]:off[r + 1]].tobytes().split()
                gone = _mask(len(words), places) if places else None
                kept = words if gone is None else [w for w, g in zip(words, gone.tolist()) if not g]
                n.append(len(words))
                removed.append(len(words) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(sha, pa.string())], names=["id", "n_words", "n_removed", "kept_sha256"])

    return both.mapInArrow(releasing(digest), f"id {id_type}, n_words bigint, n_removed bigint, kept_sha256 string") \
        .withColumnRenamed("id", id_col)


def _cut_texts(texts: pa.Array, places: pa.Array) -> pa.Array:
    data, off = utf8(texts)
    out = []
    for r, p in enumerate(places.to_pylist()):
        raw = data[off[r]:off[r + 1]].tobytes()
        if p:
            words = raw.split()
            raw = b" ".join([w for w, g in zip(words, _mask(len(words), p).tolist()) if not g])
        out.append(raw.decode())
    return pa.array(out, pa.string())


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with the repeated passages cut: a text that loses words becomes its kept words joined by one
    space (perhaps empty), the others stay as they are. ``length``, if there is such a column, is set anew."""
    places = fresh(docs, "_places")
    both = _with_places(docs, id_col, text, places)
    cut = F.when(F.col(places).isNotNull(), F.arrow_udf(_cut_texts, "string")(F.col(text), F.col(places))).otherwise(F.col(text))
    out = both.withColumn(text, cut)
    if length in docs.columns:
        out = out.withColumn(length, F.when(F.col(places).isNotNull(), F.char_length(text).cast(docs.schema[length].dataType))
                             .otherwise(F.col(length)))
    return out.select(*docs.columns)
