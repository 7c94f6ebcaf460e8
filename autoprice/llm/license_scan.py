"""License notices found by patience alignment of texts with templates.

Words are lower-case runs of ASCII letters and digits and of all non-ASCII characters. A text is cut into
regions, runs in which words of the template lie at most GAP words apart, and each region that holds
enough of the template's words is aligned with it: words that occur once in both are anchors, the longest
increasing subsequence of the anchors is kept, and the gaps between (and before and after) are aligned the
same way; a gap without anchors falls back to a longest common subsequence. Coverage is the share of the
template's words that are aligned; a notice is reported from MIN_COVERAGE on.

Whether a text holds enough of a template's distinct words at all is counted for all templates at once on
word hashes; only such texts, where the coverage can be reached, are aligned.

Defined cases: null and empty texts have no notice; a notice that stands several times is reported once
per place; overlapping templates are reported each; rows that repeat an id are scanned row by row; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autoprice.llm.common import text_batches
from autoprice.llm.textcore import slices, split_words, utf8

MIN_COVERAGE = 0.8
GAP = 6

# Wordings of public license notices.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "MIT-line": "Released under the MIT License.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
           "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
           "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
           "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                  "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
                  "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                  "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
                  "the specific language governing permissions and limitations under the License.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                        "option) any later version.",
}

# Letters in lower case, digits and non-ASCII bytes stay; all other bytes separate words.
_FOLD = np.full(256, 32, np.uint8)
for _b in [*range(48, 58), *range(97, 123), *range(128, 256)]:
    _FOLD[_b] = _b
for _b in range(65, 91):
    _FOLD[_b] = _b + 32


def words_of(text: bytes) -> list[bytes]:
    return _FOLD[np.frombuffer(text, np.uint8)].tobytes().split()


def _longest_increasing(values: Sequence[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence, by patience piles."""
    tops: list[int] = []
    pile_of: list[int] = []
    below: list[int] = []
    for i, v in enumerate(values):
        p = bisect_left(tops, v)
        below.append(pile_of[p - 1] if p else -1)
        if p == len(tops):
            tops.append(v)
            pile_of.append(i)
        else:
            tops[p], pile_of[p] = v, i
    out, i = [], pile_of[-1] if pile_of else -1
    while i >= 0:
        out.append(i)
        i = below[i]
    return out[::-1]


def _common_subsequence(a: Sequence, b: Sequence) -> list[tuple[int, int]]:
    """A longest common subsequence, for gaps without anchors."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def align(a: Sequence, b: Sequence) -> list[tuple[int, int]]:
    """Patience alignment: pairs (i, j) with ``a[i] == b[j]``, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        in_a, in_b = Counter(a[i:m]), Counter(b[j:n])
        place = {w: k for k, w in enumerate(b[j:n], j) if in_b[w] == 1 and in_a.get(w) == 1}
        once = [(k, place[w]) for k, w in enumerate(a[i:m], i) if w in place]
        anchors = [once[k] for k in _longest_increasing([p for _, p in once])]
        if not anchors:
            shared = in_a.keys() & in_b.keys()
            if shared:
                x = [k for k in range(i, m) if a[k] in shared]
                y = [k for k in range(j, n) if b[k] in shared]
                out += [(x[p], y[q]) for p, q in _common_subsequence([a[k] for k in x], [b[k] for k in y])]
            continue
        out += anchors
        edges = [(i - 1, j - 1), *anchors, (m, n)]
        todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:])]
    return sorted(out)


def notices(words: list[bytes], template: list[bytes], least: float = MIN_COVERAGE) -> list[tuple[int, int, int]]:
    """(first word, end, aligned words) of every region of ``words`` that covers ``template``."""
    known = Counter(template)
    at = [i for i, w in enumerate(words) if w in known]
    out, k = [], 0
    while k < len(at):
        e = k
        while e + 1 < len(at) and at[e + 1] - at[e] <= GAP:
            e += 1
        region = words[at[k]:at[e] + 1]
        held = Counter(w for w in region if w in known)
        if sum(min(n, known[w]) for w, n in held.items()) >= least * len(template):
            begin = 0
            while begin < len(region):  # a region can hold the notice several times
                pairs = align(region[begin:], template)
                if len(pairs) < least * len(template):
                    break
                out.append((at[k] + begin + pairs[0][0], at[k] + begin + pairs[-1][0] + 1, len(pairs)))
                begin += pairs[-1][0] + 1
        k = e + 1
    return out


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None,
                  least: float = MIN_COVERAGE) -> DataFrame:
    """One row per notice: id, license, coverage, start_word, end_word (half open), n_aligned."""
    names = sorted(templates or TEMPLATES)
    forms = [words_of((templates or TEMPLATES)[n].encode()) for n in names]
    vocabulary = sorted({w for f in forms for w in f})
    joined = np.frombuffer(b" ".join(vocabulary), np.uint8)
    hashes = split_words(joined, np.array([0, len(joined)])).hash
    order = np.argsort(hashes)
    member = np.array([[w in set(f) for f in forms] for w in vocabulary])[order].astype(np.int64)
    need = np.array([len(set(f)) - (len(f) - int(np.ceil(least * len(f) - 1e-9))) for f in forms])
    known = hashes[order]
    base = text_batches(docs).select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    id_type = base.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column(1))
            rows = []
            for i, j in slices(off):
                part, bounds = _FOLD[data[off[i]:off[j]]], off[i:j + 1] - off[i]
                w = split_words(part, bounds)
                at = np.minimum(np.searchsorted(known, w.hash), len(known) - 1)
                hit = known[at] == w.hash
                has = np.zeros((j - i, len(known)), np.int64)
                has[w.row_of()[hit], at[hit]] = 1
                for r, t in zip(*np.nonzero(has @ member >= need)):
                    own = part[bounds[r]:bounds[r + 1]].tobytes().split()
                    rows += [(i + r, names[t], n / len(forms[t]), b, e, n) for b, e, n in notices(own, forms[t], least)]
            c = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(c[0], pa.int64())), pa.array(c[1], pa.string()), pa.array(c[2], pa.float64())]
                + [pa.array(x, pa.int64()) for x in c[3:]],
                names=["id", "license", "coverage", "start_word", "end_word", "n_aligned"])

    return base.mapInArrow(run, f"id {id_type}, license string, coverage double, start_word bigint, end_word bigint, "
                                "n_aligned bigint").withColumnRenamed("id", id_col)
