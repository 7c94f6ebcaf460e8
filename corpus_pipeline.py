"""The corpus pipeline: quality rules, near-duplicates, repeated passages, benchmark leaks, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and read again as the next one's documents. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from autoprice.llm import decontaminate, near_dup, packing, quality_rules, substring_dedup
from autoprice.llm.common import materialise, table
from autoprice.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_dup.keep_one_per_class(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that stand earlier in the corpus."""
    return substring_dedup.remove_passages(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, placed in sequences of 2048 ids."""
    return packing.packed_documents(docs, vocabulary("byte_bpe_50k.json"), release=True)


STAGES = [("quality_rules", quality), ("near_dup", near_duplicates), ("substring_dedup", passages),
          ("decontamination", benchmark_leaks), ("packing", packed)]

#: Consistent sampling, tokenizing and packing have no SQL form; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
