"""The registered queries of this subpackage: each applies one operator to its whole table.

``QUERIES`` and ``ORACLES`` have the shape of ``autoprice.plans.registry``. A query without an oracle
is tested against a brute-force version in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from autoprice.llm import (bitplane_clusters, content_sort, decontaminate, huffman, license_scan, near_dup, packing,
                           pairwise_quality, quality_rules, substring_dedup, token_alignment, toxicity, warc_audit)
from autoprice.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f
    return add


_METRICS = quality_rules.FLOORS
QUALITY_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
win AS (
  SELECT doc_id, i, word AS a, lead(word) OVER s AS b, lead(word, 2) OVER s AS c
  FROM words WINDOW s AS (PARTITION BY doc_id ORDER BY i)),
rep AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) > 1 AS again FROM win WHERE c IS NOT NULL),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep WHERE again) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, d.lang, d.source, len(w) AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
r AS (
  SELECT *, (n_words < {quality_rules.MIN_WORDS}
             OR n_repeat_words * 100 > n_words * {quality_rules.MAX_REPEAT_PERCENT}) AS base_failed,
         (n_symbols * 10000) // greatest(n_words, 1) AS symbol_rate,
         (n_dup_lines * 10000) // greatest(n_lines, 1) AS dup_line_rate,
         (n_repeat_words * 10000) // greatest(n_words, 1) AS repeat_rate,
         (word_chars * 100) // greatest(n_words, 1) AS word_length FROM m),
v AS (UNPIVOT (SELECT doc_id, lang, source, symbol_rate, dup_line_rate, repeat_rate, word_length
               FROM r WHERE NOT base_failed)
      ON symbol_rate, dup_line_rate, repeat_rate, word_length INTO NAME rule VALUE v),
b AS (SELECT *, (v >> greatest(length(bin(v)) - 7, 0)::BIGINT) << greatest(length(bin(v)) - 7, 0)::BIGINT AS bucket FROM v),
own AS (SELECT lang, source, rule, quantile_disc(bucket, 0.25) AS q1, quantile_disc(bucket, 0.75) AS q3, count(*) AS n
        FROM b GROUP BY ALL),
bylang AS (SELECT lang, rule, quantile_disc(bucket, 0.25) AS q1, quantile_disc(bucket, 0.75) AS q3, count(*) AS n
           FROM b GROUP BY ALL),
whole AS (SELECT rule, quantile_disc(bucket, 0.25) AS q1, quantile_disc(bucket, 0.75) AS q3 FROM b GROUP BY ALL),
q AS (
  SELECT own.lang, own.source, own.rule,
         CASE WHEN own.n >= {quality_rules.MIN_GROUP} THEN own.q1
              WHEN bylang.n >= {quality_rules.MIN_GROUP} THEN bylang.q1 ELSE whole.q1 END AS q1,
         CASE WHEN own.n >= {quality_rules.MIN_GROUP} THEN own.q3
              WHEN bylang.n >= {quality_rules.MIN_GROUP} THEN bylang.q3 ELSE whole.q3 END AS q3
  FROM own JOIN bylang USING (lang, rule) JOIN whole USING (rule)),
f AS (
  SELECT lang, source, {', '.join(
      f"max(CASE WHEN rule = '{k}' THEN q3 + {quality_rules.REACH} * greatest(q3 - q1, {v}) END) AS {k}_high"
      for k, v in _METRICS.items())},
         max(CASE WHEN rule = 'word_length' THEN q1 - {quality_rules.REACH} * greatest(q3 - q1, {_METRICS['word_length']}) END)
           AS word_length_low
  FROM q GROUP BY lang, source)
SELECT r.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(symbol_rate <= symbol_rate_high AND dup_line_rate <= dup_line_rate_high
         AND repeat_rate <= repeat_rate_high AND word_length <= word_length_high
         AND word_length >= word_length_low, false) AS kept, n_lines
FROM r LEFT JOIN f USING (lang, source)
"""


@_register("op1_quality_rules", QUALITY_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file on this machine (it is installed, not part of the repository)."""
    import public_tokenizers
    return public_tokenizers.path(name)


@_register("op2_sum_of_squares_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


# The second replica of the audit is the first with damage at fixed ids: a record lost, one cut
# short, one with a changed byte.
LOST, CUT, CHANGED = (1009, 7), (1013, 11), (997, 5)

WARC_SQL = f"""
WITH rec AS (
  SELECT page_id AS id, concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10),
         'WARC-Record-ID: <urn:page:', page_id, '>', chr(13), chr(10), 'WARC-Target-URI: ', coalesce(url, ''), chr(13), chr(10),
         'Content-Type: text/html', chr(13), chr(10), 'Content-Length: ', strlen(coalesce(html, '')), chr(13), chr(10), chr(13), chr(10),
         coalesce(html, ''), chr(13), chr(10), chr(13), chr(10)) AS r
  FROM pages WHERE page_id IS NOT NULL),
other AS (
  SELECT id, CASE WHEN id % {CUT[0]} = {CUT[1]} THEN strlen(r) // 2 ELSE strlen(r) END AS length,
         CASE WHEN id % {CUT[0]} = {CUT[1]} THEN 'cut' WHEN id % {CHANGED[0]} = {CHANGED[1]} THEN 'changed' ELSE 'same' END AS state
  FROM rec WHERE id % {LOST[0]} <> {LOST[1]}),
base AS (SELECT min(id) // 256 * 256 AS base FROM rec),
a AS (SELECT id, sum(strlen(r)) OVER (PARTITION BY (id - base) // 256 ORDER BY id) AS e, strlen(r) AS length FROM rec, base),
b AS (SELECT id, sum(length) OVER (PARTITION BY (id - base) // 256 ORDER BY id) AS e, length, state FROM other, base)
SELECT a.id AS page_id,
       CASE WHEN b.id IS NULL THEN 'missing' WHEN state <> 'same' THEN 'damaged' ELSE 'shifted' END AS status,
       (a.e - a.length)::BIGINT AS left_first, a.e::BIGINT AS left_end,
       (b.e - b.length)::BIGINT AS right_first, b.e::BIGINT AS right_end
FROM a LEFT JOIN b USING (id)
WHERE b.id IS NULL OR state <> 'same' OR a.e <> b.e
"""


@_register("op3_warc_audit", WARC_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = warc_audit.archive(table(spark, sf_dir, "pages"))
    hit = lambda rule: F.pmod("id", F.lit(rule[0])) == rule[1]
    size = F.octet_length("record")
    cut = F.substring("record", F.lit(1), F.floor(size / 2).cast("int"))
    changed = F.concat(F.lit(b"X"), F.substring("record", F.lit(2), size))
    right = left.where(~hit(LOST)).withColumn(
        "record", F.when(hit(CUT), cut).when(hit(CHANGED), changed).otherwise(F.col("record")))
    return warc_audit.audit(left, right).withColumnRenamed("id", "page_id")


@_register("op4_huffman_ids")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.stored_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1)


@_register("op5_pairwise_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pairwise_quality.score(docs, pairwise_quality.fit(docs, table(spark, sf_dir, "labels")))


@_register("op6_license_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


CONTAINED_SQL = f"""
WITH s AS (
  SELECT src, id, [array_to_string(w[i:i + least(5, len(w)) - 1], ' ') FOR i IN range(1, len(w) - least(5, len(w)) + 2)] AS sh
  FROM (SELECT src, id, list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+'), lambda x: x <> '') AS w
        FROM (SELECT 'd' AS src, doc_id AS id, text FROM documents WHERE doc_id IS NOT NULL
              UNION ALL SELECT 'b', item_id, text FROM benchmark WHERE item_id IS NOT NULL))
  WHERE len(w) > 0),
e AS (SELECT DISTINCT src, id, unnest(sh) AS g FROM s),
items AS (SELECT id, g, count(*) OVER (PARTITION BY id) AS m FROM e WHERE src = 'b')
SELECT e.id AS doc_id, items.id AS item_id, count(*) AS n_found, max(m) AS n_item, count(*) / max(m) AS containment
FROM e JOIN items USING (g) WHERE src = 'd' GROUP BY e.id, items.id HAVING count(*) / max(m) >= {decontaminate.THRESHOLD}
"""


@_register("op7_contained_items", CONTAINED_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_register("op8_near_dup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicate_classes(table(spark, sf_dir, "documents"))


@_register("op9_substring_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.passage_report(table(spark, sf_dir, "documents"))


@_register("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


CENTROIDS, ROUNDS = 8, 10
_ASSIGN = """
  SELECT rid, min((list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::BIGINT, k)) AS best
  FROM v, {centroids} GROUP BY rid"""
_ROUND = """
a{r} AS MATERIALIZED (""" + _ASSIGN.format(centroids="c{p}") + """),
m{r} AS (
  SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c
  FROM (SELECT best[2] AS k, i, sum(x) AS s, count(*) AS n
        FROM (SELECT rid, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v) JOIN a{r} USING (rid) GROUP BY ALL) GROUP BY k),
c{r} AS MATERIALIZED (SELECT c{p}.k, coalesce(m{r}.c, c{p}.c)::BIGINT[] AS c FROM c{p} LEFT JOIN m{r} USING (k)),"""
CLUSTER_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS k, v AS c FROM (SELECT sha256('3:' || vec_id) AS h, v FROM v ORDER BY h LIMIT {CENTROIDS})),
{''.join(_ROUND.format(r=r, p=r - 1) for r in range(1, ROUNDS + 1))}
a AS MATERIALIZED ({_ASSIGN.format(centroids=f"c{ROUNDS}")})
SELECT vec_id, best[2]::INTEGER AS cluster, best[1] AS distance, (sum(best[1]) OVER (PARTITION BY best[2]))::BIGINT AS cluster_inertia,
       (sum(best[1]) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a JOIN v USING (rid) JOIN c{ROUNDS} ON k = best[2]
"""


@_register("op11_bitplane_clusters", CLUSTER_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplane_clusters.cluster(table(spark, sf_dir, "embeddings"), k=CENTROIDS, rounds=ROUNDS)


CONTENT_SQL = """
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM d
"""


@_register("op12_content_sort", CONTENT_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.exact_duplicates(table(spark, sf_dir, "documents"))


@_register("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
