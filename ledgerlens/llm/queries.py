"""The operators' queries over the given tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    byte_bpe, fingerprints, line_dedup, nearest, ngram_join, packing, periodic, pii, quality, repeats, url_filters, warc, whitening,
)
from ledgerlens.llm.common import table

BYTE_VOCABULARY = "byte_bpe_multi_50k.tiktoken"
WORD_VOCABULARY = "word_bpe_49k.json"


def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.linked_groups(table(spark, folder, "documents"), ngram_join.Likeness(words=3, share=90))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(table(spark, folder, "documents"))


def op4_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Pages are judged by the toxic label of the document with their number."""
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("page_id"), F.col("toxic").alias("bad"))
    judged = url_filters.judge_urls(table(spark, folder, "pages"), labels)
    return judged.withColumns({c: F.round(c, 9) for c in ("rate", "lower_bound")})


def op5_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, folder, "documents"))


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_VOCABULARY)
    return byte_bpe.digest(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def op7_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.search(table(spark, folder, "embeddings"))


def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = quality.train(documents, table(spark, folder, "labels"))
    return quality.judge(quality.score_documents(documents, model))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path(WORD_VOCABULARY))


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digest(table(spark, folder, "documents"))


def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.digest(table(spark, folder, "documents"))


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every tenth document has a run planted in it, by the checksum of its id."""
    return periodic.digest(table(spark, folder, "documents"), changed=periodic.looped)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join,
        op2_warc,
        op3_pii,
        op4_url_filters,
        op5_document_fingerprints,
        op6_byte_bpe,
        op7_nearest_neighbours,
        op8_quality_classifier,
        op9_packing,
        op10_suffix_dedup,
        op11_line_dedup,
        op12_embedding_whitening,
        op13_periodic_runs,
    )
}

OP2_SQL = """
WITH page AS (
  SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest,
         CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes
  FROM pages),
typed AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_page
  FROM page)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_page <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_page <> page_id THEN first_page END AS refers_to
FROM typed
"""

OP4_SQL = """
WITH after AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM after),
outcomes AS (SELECT doc_id AS page_id, sum(toxic) AS bad, count(toxic) AS seen FROM labels GROUP BY 1),
hosts AS (
  SELECT host, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS bad, CAST(coalesce(sum(seen), 0) AS DOUBLE) AS seen,
         list_aggregate(list_slice(string_split(split_part(host, ':', 1), '.'), -2, -1), 'string_agg', '.') AS domain,
         string_split(split_part(host, ':', 1), '.')[-1] AS suffix
  FROM split LEFT JOIN outcomes USING (page_id) GROUP BY host),
overall AS (SELECT (sum(bad) + 0.5e0 * 1e0) / (sum(seen) + 1e0) AS rate FROM hosts),
suffixes AS (
  SELECT suffix, (sum(bad) + any_value(overall.rate) * 8e0) / (sum(seen) + 8e0) AS suffix_rate
  FROM hosts, overall GROUP BY suffix),
domains AS (
  SELECT domain, (sum(bad) + any_value(suffix_rate) * 8e0) / (sum(seen) + 8e0) AS domain_rate
  FROM hosts JOIN suffixes USING (suffix) GROUP BY domain),
rated AS (
  SELECT host, (bad + domain_rate * 8e0) / (seen + 8e0) AS rate, seen FROM hosts JOIN domains USING (domain)),
bounds AS (SELECT host, rate, rate - 1e0 * sqrt(rate * (1 - rate) / (seen + 9e0)) AS lower_bound FROM rated),
rules(pattern, rule_host, rule_path, rule_verdict) AS (VALUES
  ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
fitting AS (
  SELECT page_id, arg_max(pattern, length(pattern)) AS rule, arg_max(rule_verdict, length(pattern)) AS rule_verdict
  FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT page_id, host, path, rule,
       coalesce(rule_verdict, CASE WHEN lower_bound > 0.2 THEN 'block' ELSE 'allow' END) AS verdict,
       round(rate, 9) AS rate, round(lower_bound, 9) AS lower_bound
FROM split JOIN bounds USING (host) LEFT JOIN fitting USING (page_id)
"""

OP11_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS place, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM lines),
repeated AS (
  SELECT line_key, max(doc_id) AS last FROM keyed WHERE length(line_key) >= 40
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT k.doc_id, k.place, k.line, r.last IS NOT NULL AND r.last <> k.doc_id AS dropped
  FROM keyed k LEFT JOIN repeated r USING (line_key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(dropped::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

STATEMENTS = {"op2_warc": OP2_SQL, "op4_url_filters": OP4_SQL, "op11_line_dedup": OP11_SQL}
