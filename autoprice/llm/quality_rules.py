"""Quality rules with adaptive thresholds.

Every document is measured (words, symbols, repeated lines, repeated three-word windows). Fixed base
rules reject what is too short or mostly repetition. For the rest, each (language, source) has its own
cutoffs: the metrics are summarised in a mergeable quantile sketch, a histogram over buckets that keep
the seven leading bits of an integer metric (relative error below 1/64, exact below 128). Sketches of
a language's sources merge by adding counts, so a group with few documents falls back to its
language's sketch, then to the whole corpus. A cutoff is a Tukey fence, ``Q3 + reach * max(IQR, floor)``,
and for the mean word length also ``Q1 - reach * max(IQR, floor)``. The table of fences is joined back
on (language, source) and filters the documents.

Nothing but bucket counts is shuffled: a hot source adds up inside the map tasks first.

Defined cases: a null text has no words (base rule fails); a null language or source counts as the
empty string; repeated rows are judged row by row; an empty table gives an empty result; other columns
are kept, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from autoprice.llm.common import broadcast_checked, fresh, materialise
from autoprice.llm.textcore import WHITE, slices, utf8

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
REACH = 3
MIN_GROUP = 30

#: rule -> least IQR that counts (in the metric's unit); metrics are integers.
#: symbols, repeated lines, repeated words: per 10,000 words, lines, words; word length: hundredths.
FLOORS = {"symbol_rate": 300, "dup_line_rate": 1500, "repeat_rate": 1500, "word_length": 100}
TWO_SIDED = {"word_length"}

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_FIELDS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
_STRUCT = "struct<" + ",".join(f"{f}:bigint" for f in _FIELDS) + ">"


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more, the first occurrence included."""
    windows = list(zip(words, words[1:], words[2:]))
    seen: set = set()
    again = {w for w in windows if w in seen or seen.add(w)}
    if not again:
        return 0
    n, upto = 0, 0
    for i, w in enumerate(windows):
        if w in again:
            n += i + 3 - max(i, upto)
            upto = i + 3
    return n


def _measure(text: pa.Array) -> pa.Array:
    data, off = utf8(text)
    out: dict[str, list] = {f: [] for f in _FIELDS}
    for i, j in slices(off):
        buf = data[off[i]:off[j]]
        bounds = off[i:j + 1] - off[i]
        total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[bounds])
        out["word_chars"].append(total(~WHITE[buf] & ((buf & 0xC0) != 0x80)))
        out["n_symbols"].append(total(_SYMBOLS[buf]))
        rows = []
        for r in range(j - i):
            raw = buf[bounds[r]:bounds[r + 1]].tobytes()
            words = raw.split()
            lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
            rows.append((len(words), len(lines), len(lines) - len(set(lines)), repeat_words(words)))
        for f, v in zip(("n_words", "n_lines", "n_dup_lines", "n_repeat_words"), np.array(rows, np.int64).T):
            out[f].append(v)
    cols = [pa.array(np.concatenate(out[f]) if out[f] else np.zeros(0, np.int64), pa.int64()) for f in _FIELDS]
    return pa.StructArray.from_arrays(cols, names=_FIELDS)


def measure(text: Column) -> Column:
    """Struct of the counts of one text."""
    udf = F.arrow_udf(_measure, _STRUCT)
    return udf(text)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (m["n_repeat_words"] * 100 > m["n_words"] * MAX_REPEAT_PERCENT)


def rates(m: Column) -> dict[str, Column]:
    per = lambda n, of, unit: (n * unit).cast("bigint") / F.greatest(of, F.lit(1))
    return {"symbol_rate": F.floor(per(m["n_symbols"], m["n_words"], 10_000)),
            "dup_line_rate": F.floor(per(m["n_dup_lines"], m["n_lines"], 10_000)),
            "repeat_rate": F.floor(per(m["n_repeat_words"], m["n_words"], 10_000)),
            "word_length": F.floor(per(m["word_chars"], m["n_words"], 100))}


def bucket(value: Column) -> Column:
    """Lower end of the sketch bucket: the seven leading bits stay."""
    drop = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def fences(measured: DataFrame, m: str, lang: str = "lang", source: str = "source") -> DataFrame:
    """Cutoffs per (lang, source) from the sketches of the documents that pass the base rules.

    ``measured`` has the struct of ``measure`` in column ``m``. Returns _lang, _source and, per rule,
    ``<rule>_high`` (and ``<rule>_low`` where the rule has two sides).
    """
    rules = list(FLOORS)
    r = rates(F.col(m))
    sketch = (measured.where(~base_failed(F.col(m)))
              .select(F.coalesce(F.col(lang), F.lit("")).alias("_lang"),
                      F.coalesce(F.col(source), F.lit("")).alias("_source"),
                      F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), bucket(r[k]).alias("bucket"))
                                          for k in rules])).alias("p"))
              .groupBy("_lang", "_source", "p.rule", "p.bucket").agg(F.count("*").alias("n")))
    sketch = materialise(sketch, "quality-sketch")

    def quartiles(keys: list[str]) -> DataFrame:
        merged = sketch.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))
        group = Window.partitionBy(*keys, "rule")
        ranked = (merged.withColumn("upto", F.sum("n").over(group.orderBy("bucket")))
                  .withColumn("all", F.sum("n").over(group)))
        at = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("all") * q, F.col("bucket")))
        return ranked.groupBy(*keys, "rule").agg(at(1).alias("q1"), at(3).alias("q3"), F.max("all").alias("all"))

    own, by_lang, whole = quartiles(["_lang", "_source"]), quartiles(["_lang"]), quartiles([])
    as_ = lambda df, p: df.select(*[c for c in df.columns if c not in ("q1", "q3", "all")],
                                  *[F.col(c).alias(p + c) for c in ("q1", "q3", "all")])
    t = (own.join(as_(by_lang, "l_"), ["_lang", "rule"]).join(as_(whole, "w_"), ["rule"]))
    pick = lambda q: (F.when(F.col("all") >= MIN_GROUP, F.col(q)).when(F.col("l_all") >= MIN_GROUP, F.col("l_" + q))
                      .otherwise(F.col("w_" + q)))
    t = t.select("_lang", "_source", "rule", pick("q1").alias("q1"), pick("q3").alias("q3"))
    out = []
    for k in rules:
        of = lambda c, k=k: F.max(F.when(F.col("rule") == k, F.col(c)))
        reach = F.greatest(of("q3") - of("q1"), F.lit(FLOORS[k])) * REACH
        out.append((of("q3") + reach).alias(f"{k}_high"))
        if k in TWO_SIDED:
            out.append((of("q1") - reach).alias(f"{k}_low"))
    return materialise(t.groupBy("_lang", "_source").agg(*out), "quality-fences")


def judge(measured: DataFrame, limits: DataFrame, m: str, kept: str, lang: str = "lang",
          source: str = "source") -> DataFrame:
    """Join the cutoffs to the documents and add the boolean ``kept``; every row stays."""
    r = rates(F.col(m))
    ok = F.lit(True)
    for k in FLOORS:
        ok = ok & (r[k] <= F.col(f"_f.{k}_high"))
        if k in TWO_SIDED:
            ok = ok & (r[k] >= F.col(f"_f.{k}_low"))
    names = measured.columns
    key = lambda c: F.coalesce(F.col(f"_d.{c}"), F.lit(""))
    joined = measured.alias("_d").join(
        broadcast_checked(limits).alias("_f"),
        (key(lang) == F.col("_f._lang")) & (key(source) == F.col("_f._source")), "left")
    verdict = ~base_failed(F.col(f"_d.`{m}`")) & F.coalesce(ok, F.lit(False))
    return joined.select(*[F.col(f"_d.`{c}`") for c in names], verdict.alias(kept))


def quality_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
                   source: str = "source") -> DataFrame:
    """One row per document: id, the measures, base_failed and kept. Texts are read once; the cutoffs
    and the verdicts come from the materialised measures."""
    measured = materialise(docs.select(F.col(id_col).alias("id"), F.col(lang).alias("lang"),
                                       F.col(source).alias("source"), measure(F.col(text)).alias("m")),
                           "quality-measures")
    judged = judge(measured, fences(measured, "m"), "m", "kept")
    return judged.select(F.col("id").alias(id_col), *[F.col(f"m.{f}").alias(f) for f in _FIELDS if f != "n_lines"],
                         base_failed(F.col("m")).alias("base_failed"), "kept", F.col("m.n_lines").alias("n_lines"))


def quality_filter(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that pass, with their columns as they came. The texts are measured twice (for the
    cutoffs, then for the verdict) rather than shuffled."""
    m = fresh(docs, "_measures")
    measured = docs.withColumn(m, measure(F.col(text)))
    kept = fresh(measured, "_kept")
    limits = fences(measured, m, lang, source)
    return judge(measured, limits, m, kept, lang, source).where(F.col(kept)).select(*docs.columns)
