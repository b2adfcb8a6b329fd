"""The registered queries of this subpackage: thin callables (spark, sf_dir) -> DataFrame, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm import quality

    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm import urls

    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, urls.default_rules(spark)).select("page_id", "host", "path", "rule", "verdict")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm import toxicity

    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.withColumn("toxic", (F.col("p_toxic") >= toxicity.THRESHOLD).cast("int"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm import warc

    records = warc.read(warc.write(_table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm import tokenfile

    return tokenfile.read(tokenfile.write(_table(spark, sf_dir, "documents")))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.pii import replace_entities

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_entities(docs, key="plumbline-query-key")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.decontaminate import contamination

    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.simhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.minhash import edit_likeness

    return edit_likeness(_table(spark, sf_dir, "documents"))


def minhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of the whole corpus by signature bands and verified Jaccard, beside op10's fingerprints."""
    from plumbline.llm.minhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_urls": op2_urls,
    "op3_toxicity": op3_toxicity,
    "op4_warc": op4_warc,
    "op5_token_files": op5_token_files,
    "op6_pii": op6_pii,
    "op7_decontaminate": op7_decontaminate,
    "op8_simhash": op8_simhash,
    "op9_packing": op9_packing,
    "op10_minhash": op10_minhash,
    "minhash_classes": minhash_classes,
}

_OP7 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS phrase
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)
), gram AS (
  SELECT doc_id, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)
), hit AS (
  SELECT doc_id, i, k, item FROM gram JOIN win USING (k, phrase)
), covered AS (
  SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_OP2 = r"""
WITH rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u AS (
  SELECT row_number() OVER () AS id, page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages
), m AS (
  SELECT id, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS verdict
  FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN m USING (id)
"""

_OP4 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS d, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
g AS (SELECT d, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN g USING (d)
"""

ORACLES: dict[str, str] = {
    "op2_urls": _OP2,
    "op4_warc": _OP4,
    "op7_decontaminate": _OP7,
}
