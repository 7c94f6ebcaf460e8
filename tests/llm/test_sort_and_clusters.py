"""Content sort and bit-plane clusters against plain Python."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from corpus import SCHEMA, corpus

from autoprice.llm import bitplane_clusters as B
from autoprice.llm import content_sort as C


# content sort

def plain_duplicates(rows):
    """Rows (id, text) -> sorted (id, keep_id, group_size, kept, sha)."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", t or "")].append(i)
    out = []
    for t, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        out += [(i, ids[0], len(ids), n == 0, hashlib.sha256(t.encode()).hexdigest()) for n, i in enumerate(ids)]
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_equal_texts_in_any_number_of_partitions(spark, partitions):
    rng = random.Random(partitions)
    rows = [(i, rng.choice(["", " ", None, "a  b", "a\tb", "a b", " a b", "é", "e", "x" * 70 + "1", "x" * 70 + "2"])) for i in range(300)]
    rows += [(i, "a third of all rows\n" + "z" * 200) for i in range(1000, 1400)]
    rows += [(7, "a b"), (7, "a b"), (None, "a b"), (None, "only null ids"), (None, "only null ids"), (5000, "long " * 300_000), (5001, "long  " * 300_000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = C.exact_duplicates(df, partitions=partitions).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_duplicates(rows)


def test_hot_group_is_spread(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "'same' AS text")
    t = C.runs(df, partitions=8)
    assert t.groupBy("pid").count().count() == 8
    assert C.joined_runs(t).select("all_size", "all_keep").distinct().collect() == [(4000, 0)]


def test_batches_do_not_matter(spark):
    rows = [(i, f"t{i // 7}") for i in range(500)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = C.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), partitions=2).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted((tuple(r) for r in got), key=str) == plain_duplicates(rows)


def test_kept_rows_and_odd_columns(spark):
    df, docs = corpus(spark, 4, extra=True)
    for c in ("norm", "sha", "head", "pid", "run", "keep", "first", "edge", "_row"):
        df = df.selectExpr("*", f"'z' AS {c}")
    want = plain_duplicates(docs.items())
    assert sorted((tuple(r) for r in C.exact_duplicates(df).collect()), key=str) == want
    kept = C.keep_one_per_text(df.unionAll(df))
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in want if r[3])
    none = spark.createDataFrame([], SCHEMA)
    assert C.exact_duplicates(none).collect() == [] and C.keep_one_per_text(none).collect() == []
    text_ids = spark.createDataFrame([("b", "x"), ("a", "x")], "doc_id string, text string")
    assert {r.keep_id for r in C.exact_duplicates(text_ids).collect()} == {"a"}


# bit planes

def test_planes_give_exact_products():
    rng = np.random.default_rng(2)
    for planes in (1, 2, 11, 28):
        x = rng.integers(-(1 << planes - 1), 1 << planes - 1, (40, 64))
        p = B.to_planes(x, planes)
        assert (B.components(p) == x).all() and (B.component_sums(p) == x.sum(axis=0)).all()
        exact = [[sum((a - b) ** 2 for a, b in zip(r, c)) for c in x[:3].tolist()] for r in x.tolist()]
        assert B.distances(p, B.dots(p, p), p[:3]).tolist() == exact


def plain_clusters(vectors, k=8, rounds=10):
    """(id, list) -> {id: (cluster, distance, digest)} in Python integers."""
    rows = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in vectors
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(rows, key=lambda r: hashlib.sha256(f"3:{r[0]}".encode()).hexdigest())
    c = [list(r[1]) for r in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        of = defaultdict(list)
        for _, v in rows:
            of[nearest(v)[1]].append(v)
        for j, vs in of.items():
            c[j] = [sum(col) // len(vs) for col in zip(*vs)]
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return {i: (nearest(v)[1], nearest(v)[0], digest[nearest(v)[1]]) for i, v in rows}


def test_clusters_equal_plain_integers(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 64))
    vectors = [(i, (centres[i % 5] + rng.normal(size=64) * .4).tolist()) for i in range(160)]
    vectors += [(200, vectors[3][1]), (201, [0.0] * 64), (202, [0.0] * 64)]  # equal vectors
    unusable = [(300, None), (301, []), (302, [1.0] * 63), (303, [1.0] * 65), (304, [None] + [1.0] * 63),
                (305, [float("nan")] + [1.0] * 63), (306, [float("inf")] + [1.0] * 63)]
    df = spark.createDataFrame(vectors + unusable, "vec_id long, embedding array<double>").repartition(5)
    for c in ("id", "planes", "square", "cluster", "distance", "n", "v"):
        df = df.selectExpr("*", f"'z' AS {c}")
    got = B.cluster(df).collect()
    want = plain_clusters(vectors)
    assert {r.vec_id: (r.cluster, r.distance, r.centroid_sha256) for r in got} == want and len(got) == len(want)
    by = defaultdict(int)
    for j, d, _ in want.values():
        by[j] += d
    assert all(r.cluster_inertia == by[r.cluster] and r.inertia == sum(by.values()) for r in got)


def test_few_vectors_ties_and_limits(spark):
    schema = "vec_id long, embedding array<float>"
    assert B.cluster(spark.createDataFrame([], schema)).collect() == []
    few = [(1, [0.5] * 64), (2, [-0.25] * 64), (2, [-0.25] * 64), (None, [0.75] * 64)]
    got = B.cluster(spark.createDataFrame(few, schema)).collect()
    assert len(got) == 4 and {r.inertia for r in got} == {0}
    assert len({r.cluster for r in got if r.vec_id == 2}) == 1  # of equal centroids the smaller number
    with pytest.raises(ArithmeticError):
        B.cluster(spark.createDataFrame([(1, [1e9] * 64)], schema))


def test_training_rows_whatever_else_documents_hold(spark):
    from autoprice.llm.learning import training_rows
    docs = spark.createDataFrame([(i, f"t{i}", 9, "z", "z") for i in range(12)], "doc_id long, text string, label int, _id string, _doc_id string")
    labels = spark.createDataFrame([(i, i % 2, 7) for i in range(12)], "doc_id long, toxic int, label int")
    got = {r.id: (r.text, r.label) for r in training_rows(docs, labels, "toxic", 100, "doc_id", "text").collect()}
    assert got and all(v == (f"t{i}", i % 2) for i, v in got.items())
