"""The registered queries of the text operators, with the SQL that some of them are checked against."""

import os
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridegauge.llm import (
    bpe, brown, html, minhash, packing, pii, rules, topk, toxicity, urls, variants, warc,
    whitening,
)
from ridegauge.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

_ROOT = str(Path(__file__).resolve().parents[2])


def registered(query: Query) -> Query:
    """``query`` where Python workers can import this package even if only the driver's path has it."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        own = spark.sparkContext.environment
        paths = own.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
        if _ROOT not in paths:
            own["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
        return query(spark, folder)

    return run


def op1_brown_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    texts = brown.coded(docs, ~brown.held_out())
    return brown.scored(texts, brown.fitted(texts))


def op2_pii_weak_supervision(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.spans(table(spark, folder, "documents"))
    return found.select("doc_id", *(c.alias(name) for name, c in pii.summary().items()))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    learned = rules.learned(docs, table(spark, folder, "labels"))
    return rules.judged(docs, learned).select(
        "doc_id",
        *(F.col(f"judged.{name}").alias(name) for name in
          ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")),
    )


def op4_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_copies(table(spark, folder, "documents"), words=4, similarity=0.8)


def op5_norm_sorted_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.whole_components(table(spark, folder, "embeddings"))
    return topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op6_host_suffix_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.extracted(table(spark, folder, "pages"))


def op7_pattern_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, folder, "documents"), path).drop("ids")


def op8_zip_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.written_and_read(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_bpe_tree(spark: SparkSession, folder: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.digests(table(spark, folder, "documents"), path, pattern)


def op10_toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    chain = toxicity.fitted(docs, table(spark, folder, "labels"))
    scored = toxicity.scored(docs, chain).select("doc_id", "toxicity.*")
    toxic = F.col("p_toxic") >= 0.5
    return scored.withColumn("toxic", toxic).withColumn("kept", ~toxic)


def op11_permuterm_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.spelling_groups(table(spark, folder, "documents"))


# The rules, and the words of host names whose pages are listed.
URL_RULES = (
    urls.Rule("org", "/", "allow"), urls.Rule("example.org", "/es/", "block"),
    urls.Rule("example.org", "/en/1", "block"), urls.Rule("com", "/fr/", "allow"),
    urls.Rule("com", "/de/", "block"),
)
URL_WORDS = ("adult", "ads", "bets", "casino", "pills", "spam")


def op12_bloom_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return urls.judged(pages, urls.listing(pages, URL_WORDS), URL_RULES).drop("possible")


def op13_mixed_precision_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.components_of(table(spark, folder, "embeddings"), components=8)


_ALL: tuple[Query, ...] = (
    op1_brown_scoring, op2_pii_weak_supervision, op3_quality_rules, op4_minhash_near_dedup,
    op5_norm_sorted_topk, op6_host_suffix_text, op7_pattern_packing, op8_zip_warc, op9_bpe_tree,
    op10_toxicity_chain, op11_permuterm_variants, op12_bloom_url_filter,
    op13_mixed_precision_whitening,
)

QUERIES: dict[str, Query] = {query.__name__: registered(query) for query in _ALL}

_SHINGLED = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingled AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i
        FROM worded WHERE len(w) > 0)),
sizes AS (
  SELECT w.doc_id, coalesce(n, 0) AS n FROM worded w
  LEFT JOIN (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id) c ON w.doc_id = c.doc_id),
links AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM shingled x JOIN shingled y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN sizes u ON u.doc_id = p.a JOIN sizes v ON v.doc_id = p.b
  WHERE 100 * p.n >= 80 * (u.n + v.n - p.n)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT s.doc_id, s.n AS n_shingles, r.component_id, s.doc_id = r.component_id AS kept
FROM sizes s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON s.doc_id = r.a"""

_PRODUCTS = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 20"""

_RECORDS = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (
  SELECT payload_digest AS d, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM p LEFT JOIN f ON d = payload_digest"""

_JUDGED = r"""
WITH r AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id, rest,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    array_to_string(list_sort(list_filter(
      string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x,
        '^(utm_[a-z]*|ref|referrer|fbclid|gclid|msclkid|mc_cid|mc_eid)(=|$)'))), '&') AS asked
  FROM r),
c AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(
      host, '^[^@]*@', ''), ':(80|443)?$', ''), '^www\.|\.$', '', 'g') AS site,
    regexp_replace(regexp_replace(regexp_replace(
      path, '/{2,}', '/', 'g'), '/index\.(html?|php)$', '/'), '/$', '') AS page
  FROM p),
u AS (
  SELECT *, CASE WHEN site <> '' THEN site || page || CASE WHEN asked <> '' THEN '?' || asked ELSE '' END END
    AS canonical_url
  FROM c),
l AS (
  SELECT DISTINCT canonical_url AS url FROM u
  WHERE regexp_matches(host, '(^|[.-])(adult|ads|bets|casino|pills|spam)([.-]|$)')),
judged AS (
  SELECT u.*, url IS NOT NULL AS listed,
    CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM u LEFT JOIN l ON canonical_url = url)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN listed THEN 'block' ELSE 'allow' END AS verdict, canonical_url, listed
FROM judged"""

SQL: dict[str, str] = {
    "op5_norm_sorted_topk": _PRODUCTS,
    "op8_zip_warc": _RECORDS,
    "op4_minhash_near_dedup": _SHINGLED,
    "op12_bloom_url_filter": _JUDGED,
}
