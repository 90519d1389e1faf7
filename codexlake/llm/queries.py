"""The registered queries of this package, and their SQL where SQL has any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexlake.llm import language_model, media, packing, pieces, quality, secrets, simhash, topk, toxicity, url_filter
from codexlake.llm.common import held_out, spread, table

URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE))


def op2_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(documents(spark, sf_dir), public_tokenizers.path(PIECE_BPE), n=3)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(documents(spark, sf_dir)).drop("span_list")


def op4_simhash_popcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def labels(spark: SparkSession, sf_dir: str, column: str, modulus: int, remainder: int) -> DataFrame:
    """(id, label) of the rows that may be learnt from."""
    return table(spark, sf_dir, "labels").where(~held_out("doc_id", modulus, remainder)).select(F.col("doc_id").alias("id"), F.col(column).alias("label"))


def op5_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, labels(spark, sf_dir, "toxic", 4, 2))
    return toxicity.score_toxicity(docs, model).drop("passages").withColumn("held_out", held_out("doc_id", 4, 2))


def op6_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.train(docs, labels(spark, sf_dir, "quality", 5, 0))
    return quality.score_quality(docs, model).withColumn("held_out", held_out("doc_id", 5, 0))


def op7_url_digest_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op8_gru_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = language_model.score_documents(docs, docs.where(~held_out("doc_id", 10, 0)))
    return scored.withColumn("held_out", held_out("doc_id", 10, 0))


def op9_media_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.text_media(documents(spark, sf_dir))


def op10_multi_index_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = topk.sign_codes(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    queries = codes.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    return topk.exact_topk(codes, queries, 10, "vec_id", "query_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
OP7_SQL = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS r FROM pages),
parts AS (
  SELECT page_id, coalesce(translate(regexp_extract(r, '^([^/?#]*)', 1), {_LOWER}), '') AS host,
         coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest),
rules(verdict, h, p) AS (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)}),
fits AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM (SELECT DISTINCT page_id, host, path FROM parts), rules
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT parts.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (page_id)
"""

OP10_SQL = """
WITH codes AS (
  SELECT vec_id, list_aggregate(list_transform(range(1, 65), lambda i: CASE WHEN embedding[i] >= 0 THEN (1::HUGEINT << (i - 1)::HUGEINT) ELSE 0::HUGEINT END), 'sum')::UBIGINT AS code
  FROM embeddings),
near AS (
  SELECT q.vec_id AS query_id, c.vec_id, bit_count(xor(q.code, c.code))::BIGINT AS distance
  FROM codes q, codes c WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INT AS rank FROM near)
SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_url_digest_array": OP7_SQL, "op10_multi_index_topk": OP10_SQL}
