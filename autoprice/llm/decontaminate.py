"""Benchmark decontamination: short test items inside long documents, by size-partitioned MinHash.

Texts are sets of hashed five-word shingles (lower case; words are runs of letters, marks and digits). An
item is contained when at least THRESHOLD of its shingles occur in a document, wherever they stand.

Items are partitioned by their number of shingles into classes up to a power of two, ``u``. An item's
sketch is its bottom-s MinHash, the ``s = floor((1 - t) u) + 1`` least hashes (hash order is a random
permutation): a document that contains the item misses at most ``(1 - t) m <= (1 - t) u`` of its ``m``
shingles, so it holds at least one of the sketch. The size of the sketch follows the class, so no
contained item is ever missed, and a small part of the item's shingles is looked up. Documents stream
past the index of sketches; those that meet a sketch become candidates, and only candidates are verified
by exact shingle containment.

Everything is DataFrame functions: no Python runs on the executors. The item index is broadcast only if
its counted size allows, otherwise it is joined by shuffle.

Defined cases: null texts and texts without a word have no shingles; a text of one to four words has one shingle of all its words, so that
an item that short is found where it is a whole document (within a longer text so few words tell nothing); rows with a null id are skipped; rows that repeat an id are taken together; empty tables give an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autoprice.llm.common import broadcast_checked, materialise

SHINGLE = 5
THRESHOLD = 0.8
WORD_BREAK = r"[^\p{L}\p{M}\p{N}]+"


def _shingled(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, h): the 64-bit hash of every run of five words; of all words of a text with fewer."""
    words = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.split(F.lower(F.col(text)), WORD_BREAK).alias("w"))
    words = words.select("id", F.filter("w", lambda w: w != "").alias("w")).where(F.size("w") > 0)
    return words.select("id", F.explode(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("w") - SHINGLE, F.lit(0))),
        # the hash passes over the nulls behind a shorter text's end
        lambda i: F.xxhash64(*[F.get("w", i + j) for j in range(SHINGLE)]))).alias("h"))


def item_shingles(items: DataFrame, item_col: str, text: str, threshold: float) -> DataFrame:
    """(item, h, m, rank, sketch): an item's distinct shingles, their number, and whether in its sketch."""
    each = _shingled(items, item_col, text).distinct()
    sets = each.groupBy("id").agg(F.array_sort(F.collect_list("h")).alias("hs")).withColumn("m", F.size("hs"))
    u = F.pow(F.lit(2.0), F.ceil(F.log2("m")))
    sketch = (F.floor(F.lit(round(1 - threshold, 9)) * u) + 1).cast("int")
    return (sets.select(F.col("id").alias("item"), F.col("m").cast("bigint").alias("m"), sketch.alias("s"),
                        F.posexplode("hs").alias("rank", "h"))
            .select("item", "h", "m", (F.col("rank") < F.col("s")).alias("sketch")))


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text",
                    item_col: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per (document, contained item): ids, n_found, n_item (shingles) and containment."""
    known = materialise(item_shingles(items, item_col, item_text, threshold), "item-shingles")
    index = known.where("sketch").select("h", "item")
    met = (_shingled(docs, id_col, text).join(broadcast_checked(index), "h")
           .select("id", "item").distinct())
    candidates = materialise(met, "candidates")

    some = broadcast_checked(candidates.select("id").distinct())
    own = docs.join(some, docs[id_col] == some["id"], "left_semi")
    pairs = (_shingled(own, id_col, text).join(broadcast_checked(known.select("h", "item", "m")), "h").distinct()
             .groupBy("id", "item").agg(F.count("*").alias("n_found"), F.max("m").alias("n_item"))
             .join(candidates, ["id", "item"], "left_semi"))
    share = F.col("n_found") / F.col("n_item")
    return pairs.where(share >= threshold).select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), "n_found", "n_item", share.alias("containment"))


def remove_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text",
                        item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents that contain no item, columns unchanged."""
    hit = contained_items(docs, items, id_col, text, item_col, item_text).select(F.col(id_col).alias("_hit")).distinct()
    hit = broadcast_checked(materialise(hit, "contaminated"))
    return docs.join(hit, docs[id_col] == hit["_hit"], "left_anti")
