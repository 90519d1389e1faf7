import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from codexlake.llm import packing, quality, queries, secrets, toxicity
from codexlake.llm.common import spread
from tests.llm.helpers import odd
from tests.llm.test_near_texts import survivors
from tests.llm.test_packing import check
from tests.llm.test_secrets import naive


def test_stages_are_those_stated():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "toxicity", "SimHash near-dedup", "secret scans", "best-fit packing"]


def test_run_against_the_operators_own_decisions(spark, tiny):
    """Each stage by its operator's published rows, then the packing checked by hand."""
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    columns = docs.columns
    good = quality.score_quality(docs, quality.train(docs, queries.labels(spark, tiny, "quality", 5, 0)))
    docs = docs.join(good.where("predicted = 1").select("doc_id"), "doc_id")
    toxic = toxicity.score_toxicity(docs, toxicity.train(docs, queries.labels(spark, tiny, "toxic", 4, 2)))
    docs = docs.join(toxic.where("predicted = 0").select("doc_id"), "doc_id")
    kept = survivors([(r["doc_id"], r["text"]) for r in docs.collect()])
    docs = docs.where(F.col("doc_id").isin(kept)).select(columns)
    texts = {r["doc_id"]: secrets.redact(r["text"], naive(r["text"]) + secrets.literal_spans(r["text"])) for r in docs.collect()}
    assert 0 < len(texts) < 200
    check(corpus_pipeline.run(spark, tiny).collect(), texts, 1024)


def test_stages_keep_columns_and_bear_odd_rows(spark, tiny):
    docs = odd(spark).selectExpr("*", "length(text) * 1L AS n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tiny)
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), tiny).count() == 0
    assert corpus_pipeline.best_fit_packing(spark, docs.limit(0), tiny).count() == 0
    assert packing.pack(corpus_pipeline.secret_redaction(spark, docs, tiny), public_tokenizers.path(queries.BYTE_BPE)).count() >= docs.count()


def test_small_tables_are_spread_and_large_ones_left(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and spread(one).count() == 1000
    assert spread(one, most=1).rdd.getNumPartitions() == one.rdd.getNumPartitions()
