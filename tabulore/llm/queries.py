"""The queries of this subpackage over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulore.llm import (
    bpe, embedding_dedup, fingerprints, hard_negatives, jaccard_join, language_id, licenses, line_dedup, packing, phrases,
    quality, token_counts, url_filters,
)


#: The entries that op13 applies.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.withColumn("line_licenses", F.array_join("line_licenses", ","))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    model = language_id.fit(documents.where(~F.coalesce(held_out, F.lit(False))), public_tokenizers.path("piece_bpe_32k.model"))
    rows = documents.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    return language_id.identify(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(documents, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality.resample(table(spark, sf_dir, "documents"), good)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_negatives(rows.withColumn("label", moved), anchors=F.col("vec_id") % 50 == 0)


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``run`` of corpus_pipeline.py at the repository top."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses,
    "op2_packing": op2_packing,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_bpe": op4_bpe,
    "op5_line_dedup": op5_line_dedup,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_fingerprints": op7_fingerprints,
    "op8_language_id": op8_language_id,
    "op9_token_counts": op9_token_counts,
    "op10_quality": op10_quality,
    "op11_phrases": op11_phrases,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_url_filters": op13_url_filters,
    "pipeline": pipeline,
}

SQL: dict[str, str] = {
    "op1_licenses": licenses.scan_sql(),
    "op11_phrases": phrases.phrases_sql(),
    "op12_hard_negatives": hard_negatives.mining_sql(),
    "op13_url_filters": url_filters.judge_sql(URL_RULES),
    "op5_line_dedup": f"""
WITH pages AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
lines AS (
  SELECT r, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM pages),
keyed AS (SELECT r, source, line, i, trim(line, ' ' || chr(9) || chr(13)) AS k FROM lines),
totals AS (SELECT source, count(*) AS host_pages FROM pages WHERE source IS NOT NULL GROUP BY source),
bad AS (
  SELECT source, k FROM keyed JOIN totals USING (source) WHERE k <> ''
  GROUP BY source, k, host_pages
  HAVING count(DISTINCT r) >= {line_dedup.LEAST_PAGES} AND count(DISTINCT r) > {line_dedup.BOILERPLATE_RATIO} * host_pages),
marked AS (SELECT l.r, l.line, l.i, b.k IS NOT NULL AS dropped FROM keyed l LEFT JOIN bad b ON l.source = b.source AND l.k = b.k),
joined AS (
  SELECT r, string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped) AS kept, count(*) FILTER (dropped) AS n_dropped
  FROM marked GROUP BY r)
SELECT p.doc_id, p.source, CASE WHEN p.text IS NULL THEN NULL ELSE coalesce(j.kept, '') END AS text,
       coalesce(j.n_dropped, 0) AS n_dropped
FROM pages p LEFT JOIN joined j USING (r)
""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
