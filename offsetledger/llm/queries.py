"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from offsetledger.llm import (
    fingerprints,
    html_extract,
    jaccard_join,
    license_scan,
    packing,
    periodic_runs,
    quality_cnn,
    quality_rules,
    sentencepiece_codec,
    suffix_dedup,
    token_alignment,
    topk,
    url_filter,
)
from offsetledger.llm.tables import table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_texts(table(spark, sf_dir, "pages"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digests(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op5_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cnn.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digests(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_alignment.digests(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.with_planted_loops(table(spark, sf_dir, "documents")))


QUERIES = {
    query.__name__: query
    for query in (
        op1_html_extract,
        op2_suffix_dedup,
        op3_sentencepiece,
        op4_packing,
        op5_quality_cnn,
        op6_quality_rules,
        op7_url_filter,
        op8_license_scan,
        op9_topk,
        op10_jaccard_join,
        op11_fingerprints,
        op12_token_alignment,
        op13_periodic_runs,
    )
}

_WORD = r"[^\x20\x09-\x0D]+"
_MARKS = "[#*$%&<>!]"
_END_MARK = quality_rules.END_MARK.replace("'", "''")

_OP6 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '{_WORD}') AS w, string_split(text, chr(10)) AS all_lines FROM docs
), lines AS (
  SELECT r, doc_id, text, w, list_filter(all_lines, lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM words
), good AS (
  SELECT *, list_filter(lines, lambda x: NOT (
      len(regexp_extract_all(x, '{_MARKS}')) * 4 > len(regexp_extract_all(x, '{_WORD}'))
      OR len(regexp_extract_all(x, '[|]')) * 3 > len(regexp_extract_all(x, '{_WORD}'))
      OR ((len(regexp_extract_all(x, '{_WORD}')) < 4 AND length(x) < 30
           OR len(regexp_extract_all(x, '{_WORD}')) < 6 AND regexp_matches(x, '{quality_rules.BULLET}'))
          AND NOT regexp_matches(x, '{_END_MARK}'))
      OR regexp_matches(x, '{quality_rules.BROKEN_OR_LINKS}')
      OR regexp_matches(lower(x), '{quality_rules.BOILERPLATE}'))) AS good
  FROM lines
), windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM words)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1
), repeated AS (
  SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY r
), counts AS (
  SELECT doc_id, len(w) AS n_words, len(list_aggregate(w, 'string_agg', '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, len(lines) - len(good) AS n_failed_lines,
    len(regexp_replace(array_to_string(good, ''), '[\x20\x09-\x0D]', '', 'g')) AS good_chars
  FROM good LEFT JOIN repeated USING (r)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND NOT 100 * (coalesce(word_chars, 0) - good_chars) > 50 * coalesce(word_chars, 0) AS kept,
  CAST(n_failed_lines AS BIGINT) AS n_failed_lines,
  CAST(coalesce(word_chars, 0) - good_chars AS BIGINT) AS lost_chars
FROM counts
"""

_OP7 = r"""
WITH split AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM split
), hosts AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM parts
), rules(rule_host, rule_path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits AS (
  SELECT h.page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    max_by(verdict, length(rule_host || rule_path)) AS verdict
  FROM hosts h JOIN rules r ON (h.host = rule_host OR suffix(h.host, '.' || rule_host)) AND starts_with(h.path, rule_path)
  GROUP BY h.page_id
), judged AS (
  SELECT h.*, rule, verdict FROM hosts h LEFT JOIN fits USING (page_id)
), listed AS (
  SELECT DISTINCT host FROM judged WHERE verdict = 'block'
)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN host IN (SELECT host FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged
"""

_OP9 = """
WITH sound AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM sound q JOIN sound c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_OP10 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(node, least) AS (
  SELECT a, a FROM edges UNION SELECT e.b, r.least FROM reach r JOIN edges e ON e.a = r.node
), components AS (
  SELECT node, min(least) AS component_id FROM reach GROUP BY node
)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id
FROM words w LEFT JOIN sizes s ON s.doc_id = w.doc_id LEFT JOIN components c ON c.node = w.doc_id
"""

ORACLE_SQL = {"op6_quality_rules": _OP6, "op7_url_filter": _OP7, "op9_topk": _OP9, "op10_jaccard_join": _OP10}
