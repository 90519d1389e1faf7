"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) with the columns of ``documents`` and
returns the rows it keeps with the same columns; the last returns the pieces of
the packing.  The driver writes each stage and rereads it for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexlake.llm import near_texts, packing, quality, secrets, toxicity
from codexlake.llm.common import cut, spread, table
from codexlake.llm.queries import BYTE_BPE, labels


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the line-level classifier does not reject."""
    docs = spread(docs)
    return quality.keep_good(docs, quality.train(docs, labels(spark, sf_dir, "quality", 5, 0)))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that score as toxic."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels(spark, sf_dir, "toxic", 4, 2)))


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates, the one of least id.

    Near-duplicates share 0.8 of their shingles of five words.
    """
    return near_texts.keep_one(docs)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets by a mark; ``n_chars`` follows the new text."""
    clean = secrets.redact_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path(BYTE_BPE))


STAGES = [
    ("quality classifier", quality_filter),
    ("toxicity", toxicity_filter),
    ("SimHash near-dedup", near_duplicate_filter),
    ("secret scans", secret_redaction),
    ("best-fit packing", best_fit_packing),
]

#: Fitted models and a tokenizer decide: no SQL gives these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = cut(docs, f"stage{n}")
    return docs
