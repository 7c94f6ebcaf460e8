"""The registered queries against their SQL, and the pipeline's stages against plain versions, each on its own input."""

import pytest
from corpus import SCHEMA, contained, kept_words, near_classes, split, texts
from conftest import SF_SMALL

import corpus_pipeline
from autoprice.llm import near_dup, queries
from autoprice.llm.common import materialise
from autoprice.llm.quality_rules import quality_report
from autoprice.plans.oracle_check import compare, duck_connect


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, key):
    r = compare(spark, SF_SMALL, key, duck_connect(SF_SMALL))
    assert r["status"] == "match", r


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dup", "substring_dedup", "decontamination", "packing"]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """A folder with documents (copies, near copies, shared passages, benchmark items inside) and a benchmark."""
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, ["en", "de"][i % 2], "s", len(t or "")) for i, t in enumerate(texts(21, 150))]
    long = [w for _, t, *_ in rows for w in split(t)]
    items = {j: " ".join(long[at:at + 30]).replace("|", "w") for j, at in enumerate(range(700, 1900, 300))}
    rows += [(1000 + j, " ".join(long[k * 211:k * 211 + 90]) + " " + t + " " + " ".join(long[k * 97:k * 97 + 60]), "en", "s", 0)
             for k, (j, t) in enumerate(items.items())]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, items


def test_pipeline_stage_by_stage(spark, made):
    folder, items = made
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = materialise(stage(spark, docs, folder), f"test-{name}")
        if name != "packing":
            assert out.columns == columns
            after = {r.doc_id: r.text for r in out.collect()}
        if name == "quality_rules":
            assert set(after) == {r.doc_id for r in quality_report(docs).collect() if r.kept}
            assert all(len(split(t)) >= 50 for t in after.values()) and len(after) < len(before)
        elif name == "near_dup":
            classes = near_classes(before, near_dup.THRESHOLD, near_dup.IDF_SHARE)
            assert set(after) == set(classes.values()) and len(after) < len(before)
        elif name == "substring_dedup":
            assert {i: split(t) for i, t in after.items()} == kept_words(before, 20)
            assert any(after[i] != before[i] for i in before)
        elif name == "decontamination":
            leaked = {i for i, _ in contained(before, items, .8)}
            assert set(after) == set(before) - leaked
            assert leaked
        else:
            rows = out.collect()
            used: dict = {}
            for r in rows:
                used.setdefault(r.sequence_id, []).append((r.offset, r.length))
            for places in used.values():
                at = 0
                for offset, length in sorted(places):
                    assert offset == at
                    at += length
                assert at <= 2048
            assert {r.doc_id for r in rows} == set(before)
        docs, seen[name] = out, out.count()
    assert corpus_pipeline.run(spark, folder).count() == seen["packing"]
