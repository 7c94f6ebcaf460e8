"""The operators outside the pipeline: round trips, brute force and held-out accuracy."""

import random
import zlib

import numpy as np
import pytest
from corpus import SCHEMA, corpus, words

from autoprice.llm import huffman, license_scan, pairwise_quality, toxicity, warc_audit
from autoprice.llm.common import shared_path

tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")
WORD = P.path("word_bpe_49k.json")
PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def made(spark):
    df, docs = corpus(spark, 5, extra=True)
    return df.cache(), docs


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# Huffman store

def test_code_lengths_are_optimal_and_limited():
    import heapq
    rng = np.random.default_rng(1)
    for _ in range(40):
        counts = rng.integers(0, 50, 70)
        lengths = huffman.code_lengths(counts)
        heap, cost = [c for c in counts.tolist() if c], 0
        heapq.heapify(heap)
        while len(heap) > 1:
            pair = heapq.heappop(heap) + heapq.heappop(heap)
            cost += pair
            heapq.heappush(heap, pair)
        assert (lengths * counts).sum() == cost
    fibonacci = [1, 1]
    while len(fibonacci) < 40:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    lengths = huffman.code_lengths(np.array(fibonacci))
    assert lengths.max() == 16 and (2.0 ** -lengths).sum() == 1


@pytest.mark.parametrize("block", [1 << 16, 700])
def test_store_round_trip(spark, made, monkeypatch, block):
    monkeypatch.setattr(huffman, "BLOCK", block)
    df, docs = made
    plain = tokenizers.Tokenizer.from_file(WORD)
    path = shared_path(spark, "test-store")
    huffman.write_store(df, WORD, 1, path, parts=3)
    got = {r.id: r for r in huffman.read_store(spark, path).collect()}
    digests = {r.doc_id: r for r in huffman.stored_documents(df, WORD, 1).collect()}
    assert got.keys() == docs.keys() == digests.keys()
    start = 0
    for i in sorted(docs):
        ids = plain.encode(docs[i] or "", add_special_tokens=False).ids + [1]
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids and got[i].start == start
        d = digests[i]
        assert (d.start, d.n_tokens, d.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.where(f"size(doc) > 1 and aggregate(doc_ids, 0L, (a, x) -> a + x) > {block}").count() == 0
    order = [(r.part, r.block, i) for r in blocks.collect() for i in r.doc]
    assert [i for *_, i in sorted(order)] == sorted(docs)


def test_store_repeated_and_null_ids(spark):
    rows = [(None, "a b", None, None, None), (3, "one two", None, None, None), (3, "one two", None, None, None), (1, "x", None, None, None)]
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in huffman.stored_documents(spark.createDataFrame(rows, SCHEMA), WORD, 1).collect())
    assert [(i, n) for _, i, n in got] == [(None, 3), (1, 2), (3, 3), (3, 3)]
    assert [s for s, *_ in got] == [0, 3, 5, 8]


# classifiers

def labelled(spark, n=500):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        w = words(rng, rng.randint(40, 200))
        bad, toxic = rng.random() < .3, rng.random() < .3
        if bad:
            w = [x + "$$$" for x in w] if rng.random() < .5 else w[:10] * 8
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["vilefoo", "nastybar", "grim" + words(rng, 1)[0]]))
        rows.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, int(not bad), int(toxic)))
    rows += [(n, None, None, None, None), (n + 1, "", "en", "s", 0), (n + 2, "y " * 20000, "en", "s", 0)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_held_out_accuracy(spark):
    df, labels, known = labelled(spark)
    for module, at, cutoff in ((pairwise_quality, 1, .5), (toxicity, 2, .7)):
        got = {r.doc_id: r for r in module.score(df, module.fit(df, labels)).collect()}
        assert len(got) == 503
        for r in got.values():
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= cutoff)
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        held = [row for row in known if got[row[0]].held_out]
        right = sum(got[row[0]].predicted == row[at] for row in held)
        assert right >= .95 * len(held)


def test_toxic_beginnings_of_ordinary_syllables(spark):
    """Toxic rows differ in which of the ordinary syllables begin a word, in two languages of unlike gains."""
    rng = random.Random(11)
    syllables = (["réeu", "xan", "oui", "ell", "ment", "aux", "que"], ["ach", "lich", "ver", "keit", "ung", "ein", "sch"])
    rows, labels = [], []
    for i in range(600):
        s, toxic = syllables[i % 2], int(rng.random() < .2)
        first = [x for x in s if x != s[0]]
        w = [rng.choice(first) + "".join(rng.choice(s) for _ in range(rng.randint(0, 3))) for _ in range(rng.randint(80, 200))]
        for k in range(0, len(w), 16 if toxic else 150):
            w[k] = s[0] + s[1] + rng.choice(s)
        rows.append((i, " ".join(w), "x", "s", 0))
        labels.append((i, 1, toxic))
    df = spark.createDataFrame(rows, SCHEMA)
    got = toxicity.score(df, toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))).collect()
    held = [(labels[r.doc_id][2], r.predicted) for r in got if r.held_out]
    assert sum(t and p for t, p in held) >= .9 * sum(t for t, _ in held)
    assert sum(p and not t for t, p in held) <= .02 * len(held)


def test_held_out_labels_are_not_read(spark):
    df, labels, _ = labelled(spark, 200)
    from pyspark.sql import functions as F

    from autoprice.llm.learning import held_out
    flipped = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(pairwise_quality.score(df, pairwise_quality.fit(df, x)).collect()) for x in (labels, flipped))
    assert a == b


def test_pairwise_learning_orders_strengths():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, pairwise_quality.N_FEATURES))
    y = (x[:, 0] - x[:, 1] > .5).astype(int)
    model = pairwise_quality.learn(x, y)
    assert ((model.score(x) >= .5) == y).mean() > .97
    assert pairwise_quality.learn(x, np.ones(600, int)) is None


def test_classifiers_without_labels(spark, made):
    df, docs = made
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(i, 1, 0) for i in list(docs)[:20]] + [(None, 1, 1), (3, None, None)], none.schema)
    assert {r.score for r in pairwise_quality.score(df, pairwise_quality.fit(df, none)).collect()} == {.5}
    assert {r.score for r in pairwise_quality.score(df, pairwise_quality.fit(df, one)).collect()} == {.5}
    assert {r.score for r in toxicity.score(df, toxicity.fit(df, none)).collect()} == {.5}
    assert {r.score for r in toxicity.score(df, toxicity.fit(df, one)).collect()} == {0}


# license scan

def common_length(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, best[j] = best[j], last + 1 if x == y else max(best[j], best[j - 1])
    return best[-1]


def test_patience_alignment():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randrange(12) for _ in range(rng.randint(0, 14))] for _ in range(2))
        pairs = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p < r and q < s for (p, q), (r, s) in zip(pairs, pairs[1:]))
        assert len(pairs) <= common_length(a, b)
        # without repeats, anchoring is exact
        a, b = rng.sample(range(20), 12), rng.sample(range(20), 12)
        assert len(license_scan.align(a, b)) <= common_length(a, b)
        assert license_scan.align(a, a) == [(k, k) for k in range(12)]
        first = [x for x in a if x in b]
        assert len(license_scan._longest_increasing([b.index(x) for x in first])) == common_length(a, b)


def test_license_scan(spark, empty):
    rng = random.Random(2)
    t = license_scan.TEMPLATES
    rows, want = [], set()
    for i in range(60):
        w = words(rng, rng.randint(30, 300))
        at = rng.randint(0, len(w))
        if i % 3 == 0:
            name = sorted(t)[i // 3 % len(t)]
            notice = t[name].upper().split() if i % 2 else t[name].split()
            if i % 4 == 0 and len(notice) > 20:
                notice[7] = "otherwise"
                del notice[15]
            w[at:at] = notice
            want.add((i, name))
        rows.append((i, " ".join(w), "en", "s", 0))
    rows += [(60, None, None, None, None), (61, "", None, None, None), (62, "z " * 30000 + t["MIT-line"] + "\n" + t["MIT-line"], None, None, None),
             (63, "the license of the software under the law is the version of the terms and conditions", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'q' AS id", "1 AS license")
    got = license_scan.scan_licenses(df).collect()
    assert want <= {(r.doc_id, r.license) for r in got}
    assert {r.doc_id for r in got} == {i for i, _ in want} | {62}
    assert sorted((r.start_word, r.end_word) for r in got if r.doc_id == 62) == [(30000, 30005), (30005, 30010)]
    text = dict((r[0], r[1]) for r in rows)
    for r in got:
        assert r.coverage >= .8 and r.n_aligned <= r.end_word - r.start_word
        if (r.doc_id, r.license) in want and r.doc_id % 4:
            form = license_scan.words_of(t[r.license].encode())
            assert license_scan.words_of(text[r.doc_id].encode())[r.start_word:r.end_word] == form
    assert license_scan.scan_licenses(empty).count() == 0


# WARC audit

def audited(left, right):
    """The rows of an audit of two lists of (id, record), by a plain walk over each file."""
    def contents(side):
        out = {}
        for i, r in side:
            out.setdefault(i, []).append(r)
        return {i: sorted(x) for i, x in out.items()}
    a, b = contents(left), contents(right)
    size = lambda side, i: sum(map(len, side.get(i, [])))
    want, at, to, file = [], 0, 0, None
    for i in sorted(a.keys() | b.keys()):
        if i // 256 != file:
            at, to, file = 0, 0, i // 256
        n, m = size(a, i), size(b, i)
        status = ("missing" if i not in b else "extra" if i not in a else "damaged" if a[i] != b[i] else
                  "shifted" if at != to else None)
        if status:
            want.append((i, status, *((at, at + n) if i in a else (None, None)), *((to, to + m) if i in b else (None, None))))
        at, to = at + n, to + m
    return sorted(want, key=str)


def test_warc_audit(spark):
    rng = random.Random(3)
    pages = [(i, None if i % 17 == 0 else f"http://h/{i}", None if i % 23 == 0 else "x" * rng.randint(0, 50)) for i in
             rng.sample(range(-700, 5000), 900)] + [(None, "u", "h"), (-2 ** 63, "least", "h"), (2 ** 63 - 1, "most", "h")]
    pages += pages[:3] + [(pages[5][0], "again", "other")]
    left = warc_audit.archive(spark.createDataFrame(pages, PAGES).selectExpr("*", "1 AS id", "'r' AS record"))
    assert warc_audit.audit(left, left).count() == 0
    rows = [(r.id, bytes(r.record)) for r in left.collect()]
    ids = sorted({i for i, _ in rows})

    def check(right):
        got = warc_audit.audit(left, spark.createDataFrame(right, left.schema)).collect()
        want = audited(rows, right)
        assert sorted(map(tuple, got), key=str) == want
        return want
    behind = [i for i in ids if i // 256 == ids[300] // 256 and i > ids[300]]
    assert len(behind) > 3
    # a lost record is a row, and each record behind it in its file is one
    assert len(check([r for r in rows if r[0] != ids[300]])) == 1 + len(behind)
    assert len(check([r for r in rows if r[0] != behind[-1]])) == 1  # the last of its file moves nothing
    lost, changed, longer, extra = {*ids[100:103], ids[0], ids[-1]}, {ids[301], ids[5]}, set(ids[400:600:40]), 4999 if 4999 not in ids else 5001
    check([(i, b"?" + r[1:] if i in changed else r + b"." if i in longer else r) for i, r in rows if i not in lost]
          + [(extra, b"new"), (ids[50] + 1 if ids[50] + 1 not in ids else 6001, b"another")])
    check([r for r in rows if r[0] in ids[700:]])
    nothing = spark.createDataFrame([], left.schema)
    assert warc_audit.audit(nothing, nothing).count() == 0
    assert {r.status for r in warc_audit.audit(left, nothing).collect()} == {"missing"}
    assert {r.status for r in warc_audit.audit(nothing, left).collect()} == {"extra"}


def test_empty_tables(spark, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert huffman.stored_documents(empty, WORD, 1).count() == 0
    assert pairwise_quality.score(empty, pairwise_quality.fit(empty, none)).count() == 0
    assert toxicity.score(empty, toxicity.fit(empty, none)).count() == 0
