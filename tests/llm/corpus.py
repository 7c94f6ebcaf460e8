"""Small corpora with planted cases, and plain Python versions of the operators to compare with."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])


def words(rng: random.Random, n: int, vocabulary: int = 3000) -> list[str]:
    return [f"w{int(vocabulary * rng.random() ** 2)}é" if rng.random() < .1 else f"w{int(vocabulary * rng.random() ** 2)}"
            for _ in range(n)]


def texts(seed: int, n: int = 120) -> list[str | None]:
    rng = random.Random(seed)
    passages = [words(rng, k) for k in (12, 25, 40, 90)]
    out: list[str | None] = [None, "", " \t\n ", "one two", "a b c d e"]
    base: list[list[str]] = []
    for _ in range(n):
        kind = rng.random()
        if base and kind < .1:
            w = list(rng.choice(base))
        elif base and kind < .3:
            w = list(rng.choice(base))
            for _ in range(rng.randint(1, 4)):
                at = rng.randrange(len(w))
                w[at:at + rng.randint(0, 2)] = words(rng, rng.randint(0, 2))
        else:
            w = words(rng, rng.choice([8, 19, 20, 21, 60, 150, 400]))
        if rng.random() < .4:
            at = rng.randint(0, len(w))
            w[at:at] = rng.choice(passages)
        if rng.random() < .1:
            w += w[:30]
        base.append(w)
        out.append("".join(x + rng.choice([" "] * 12 + ["\n", "\t", "  "]) for x in w))
    out.append("x " * 3000)
    out += ["| # $ " * 40, "Same line\n" * 30]
    return out


def corpus(spark, seed: int = 1, n: int = 120, extra: bool = False):
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None][i % 2 + (i % 7 == 0)], len(t or ""))
            for i, t in enumerate(texts(seed, n))]
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    if extra:
        for c in ("id", "key", "h", "places", "piece", "m", "kept", "n_words", "class_id"):
            df = df.selectExpr("*", f"'z' AS {c}")
    return df, {r[0]: r[1] for r in rows}


def split(text: str | None) -> list[str]:
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def near_classes(docs: dict[int, str | None], threshold: float, share: float) -> dict[int, int]:
    bags = {}
    for i, t in docs.items():
        w = split(t)
        if w:
            bags[i] = Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4)))
    df = Counter(s for b in bags.values() for s in b)
    idf = {s: 1 + math.log(len(docs) / max(n, share * len(docs))) for s, n in df.items()}
    parent = {i: i for i in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(bags)
    for a in range(len(ids)):
        for b in range(a + 1, len(ids)):
            x, y = bags[ids[a]], bags[ids[b]]
            both = sum(idf[s] * min(x[s], y[s]) for s in x.keys() & y.keys())
            total = sum(idf[s] * n for s, n in x.items()) + sum(idf[s] * n for s, n in y.items())
            if both >= threshold * (total - both) - 1e-12:
                p, q = find(ids[a]), find(ids[b])
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in docs}


def kept_words(docs: dict[int, str | None], window: int) -> dict[int, list[str]]:
    seen: set = set()
    out = {}
    for i in sorted(docs):
        w = split(docs[i])
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            if key in seen:
                gone[s:s + window] = [True] * window
            seen.add(key)
        out[i] = [x for x, g in zip(w, gone) if not g]
    return out


def contained(docs: dict[int, str | None], items: dict[int, str | None], threshold: float) -> dict[tuple[int, int], tuple[int, int]]:
    def shingles(t):
        w = "".join(c.lower() if c.isalnum() else " " for c in t or "").split()
        return {tuple(w[k:k + 5]) for k in range(max(len(w) - 4, min(len(w), 1)))}
    out = {}
    own = {j: shingles(t) for j, t in items.items()}
    for i, t in docs.items():
        s = shingles(t)
        for j, q in own.items():
            if q and len(q & s) >= threshold * len(q):
                out[i, j] = len(q & s), len(q)
    return out


def quality(text: str | None) -> tuple[int, ...]:
    t = text or ""
    w = split(t)
    windows: dict = defaultdict(list)
    for k in range(len(w) - 2):
        windows[tuple(w[k:k + 3])].append(k)
    again = {k + d for at in windows.values() if len(at) > 1 for k in at for d in range(3)}
    lines = [x for x in t.split("\n") if split(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again))
