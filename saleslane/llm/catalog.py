"""One query for each operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslane.llm import (
    byte_bpe_tables,
    embedding_dedup,
    exact_topk,
    harmonic_packing,
    lexical_search,
    quality_classifier,
    quality_rules,
    simhash_dedup,
    substring_dedup,
    token_alignment,
    toxicity,
    url_filters,
    warc,
)
from saleslane.llm.shared import fresh_path, ship_package, table

# The rules of the URL query.
URL_RULES = (
    url_filters.Rule("com", "/", "allow"),
    url_filters.Rule("example.com", "/en/", "block"),
    url_filters.Rule("www.example.com", "/en/", "allow"),
    url_filters.Rule("net", "/es/", "block"),
    url_filters.Rule("net", "/fr/", "block"),
)


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), fresh_path(spark, "warc"))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), k=20, every=20, scale=64)


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.judge_urls(pages, URL_RULES).drop("url")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe_tables.digests(table(spark, sf_dir, "documents"), ranks)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score_documents(docs, labels)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_classifier.score_documents(docs, labels)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    packed = harmonic_packing.pack(table(spark, sf_dir, "documents"), tokenizer)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.digests(table(spark, sf_dir, "documents"), a, b)


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_dedup": op1_simhash_dedup,
    "op2_warc": op2_warc,
    "op3_exact_topk": op3_exact_topk,
    "op4_url_filters": op4_url_filters,
    "op5_quality_rules": op5_quality_rules,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_toxicity": op8_toxicity,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_packing": op10_packing,
    "op11_token_alignment": op11_token_alignment,
    "op12_embedding_dedup": op12_embedding_dedup,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL = {
    "op2_warc": """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest,
    CASE WHEN octet_length(payload) >= 1000
      THEN max(page_id) OVER (PARTITION BY payload) END AS response
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id <> response THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM d
""",
    "op3_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.vector, c.vector)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
""",
    "op5_quality_rules": r"""
WITH t AS (
  SELECT row_number() OVER () AS row, doc_id, source AS host, coalesce(text, '') AS text
  FROM documents
), l AS (
  SELECT row, doc_id, host, place, string_split(text, chr(10))[place] AS line
  FROM (SELECT row, doc_id, host, text,
    unnest(range(1, len(string_split(text, chr(10))) + 1)) AS place FROM t)
), lw AS (
  SELECT *, list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM l
), full_lines AS (
  SELECT *, lower(list_aggregate(words, 'string_agg', ' ')) AS norm FROM lw WHERE len(words) > 0
), w AS (
  SELECT row, place, unnest(words) AS word, unnest(range(len(words))) AS spot FROM full_lines
), n AS (
  SELECT row, word, row_number() OVER (PARTITION BY row ORDER BY place, spot) AS i FROM w
), g AS (
  SELECT row, i, word || ' ' || lead(word, 1) OVER q || ' ' || lead(word, 2) OVER q AS gram
  FROM n WINDOW q AS (PARTITION BY row ORDER BY i)
), twice AS (
  SELECT row, i FROM (
    SELECT row, i, count(*) OVER (PARTITION BY row, gram) AS c FROM g WHERE gram IS NOT NULL)
  WHERE c > 1
), covered AS (
  SELECT row, count(DISTINCT j) AS n FROM (SELECT row, unnest([i, i + 1, i + 2]) AS j FROM twice)
  GROUP BY row
), words AS (
  SELECT row, count(*) AS n_words, sum(length(word)) AS word_chars FROM n GROUP BY row
), dup AS (
  SELECT row, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY row
), b AS (
  SELECT row, doc_id, host, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    coalesce(dup.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM t LEFT JOIN words USING (row) LEFT JOIN dup USING (row) LEFT JOIN covered USING (row)
), doc AS (
  SELECT row, host, string_agg(norm, chr(10) ORDER BY place) AS document
  FROM full_lines GROUP BY row, host
), hosts AS (
  SELECT host, count(DISTINCT document) AS host_documents FROM doc GROUP BY host
), frequent AS (
  SELECT f.host, f.norm
  FROM full_lines f JOIN doc USING (row) JOIN hosts h ON f.host IS NOT DISTINCT FROM h.host
  GROUP BY f.host, f.norm, host_documents
  HAVING count(DISTINCT document) > 20 AND count(DISTINCT document) > 0.001 * host_documents
), removed AS (
  SELECT row, sum(len(words)) AS n
  FROM full_lines f JOIN frequent q ON f.norm = q.norm AND f.host IS NOT DISTINCT FROM q.host
  GROUP BY row
), judged AS (
  SELECT b.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    coalesce(n, 0) AS n_removed
  FROM b LEFT JOIN removed USING (row)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND n_words - n_removed >= 0.3 * n_words AS kept
FROM judged
""",
    "op12_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS row, vec_id, embedding::DOUBLE[] AS vector,
    coalesce(vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS usable
  FROM embeddings
), u AS (
  SELECT *, sqrt(list_dot_product(vector, vector)) AS size FROM v WHERE usable
), link AS (
  SELECT a.row, b.row AS other
  FROM u a JOIN u b ON a.row <> b.row AND len(a.vector) = len(b.vector)
  WHERE list_dot_product(a.vector, b.vector) / (a.size * b.size) >= 0.9
), reach(row, other) AS (
  SELECT row, row FROM v UNION SELECT reach.row, link.other FROM reach JOIN link ON reach.other = link.row
), component AS (
  SELECT reach.row, min(v.vec_id) AS component_id FROM reach JOIN v ON v.row = reach.other GROUP BY reach.row
), counts AS (
  SELECT row, count(*) AS n_links FROM link GROUP BY row
)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id,
  vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN component USING (row) LEFT JOIN counts USING (row)
""",
    "op13_lexical_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, list_filter(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: t <> '') AS terms
  FROM documents
), q AS (
  SELECT row_number() OVER () AS item, item_id, unnest(list_filter(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: t <> '')) AS term
  FROM benchmark
), asked AS (
  SELECT item, item_id, term, count(*) AS times FROM q GROUP BY item, item_id, term
), stats AS (
  SELECT count(*) AS documents, sum(len(terms)) AS total FROM d WHERE len(terms) > 0
), held AS (
  SELECT row, doc_id, term, count(*) AS tf, any_value(n) AS n
  FROM (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY row, doc_id, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM held, stats GROUP BY term
), impacts AS (
  SELECT row, doc_id, term,
    (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * documents) // total)) AS impact
  FROM held, stats
), scored AS (
  SELECT item, item_id, row, doc_id, sum(times * w * impact)::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN impacts USING (term) GROUP BY item, item_id, row, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
""",
    "op4_url_filters": """
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), r(rule_host, rule_path, rule_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), m AS (
  SELECT p.*, rule_host || rule_path AS rule, rule_verdict,
    row_number() OVER (PARTITION BY page_id
      ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
  FROM p LEFT JOIN r
    ON ends_with('.' || host, '.' || rule_host) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM m WHERE place = 1
""",
}


def shipping(query: Callable[[SparkSession, str], DataFrame]) -> Callable:
    """The query, with this package sent to the workers first."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {name: shipping(query) for name, query in QUERIES.items()}
