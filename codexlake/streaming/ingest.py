"""Incremental ingest as streams: skip what was seen, keep the last writer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codexlake.operators.versions import upsert


def first_seen(stream: DataFrame, keys: list[str], at: str, delay: str) -> DataFrame:
    """Rows whose key has not come within ``delay``; state beyond it is dropped."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def unseen(stream: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in a stored table, as an anti-join with it."""
    return stream.join(known.select(*keys).distinct().withColumn("_known", F.lit(True)), keys, "left_outer").where("_known is null").drop("_known")


def activity(stream: DataFrame, at: str, key: str, window: str, slide: str | None, delay: str) -> DataFrame:
    """Versions in tumbling or sliding windows, late rows up to ``delay``."""
    w = F.window(at, window, slide) if slide else F.window(at, window)
    return stream.withWatermark(at, delay).groupBy(w, key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), key, "n")


def upsert_batches(spark: SparkSession, path: str, keys: list[str], order: list[Column]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` that keeps, under ``path``, the last writer of each key.

    Each batch writes the merged state to a folder of its own number, from that of
    the batch before; a batch that is repeated after a failure writes the same rows
    again, so the sink is idempotent.  Older states than the two that this needs go.
    """
    jvm = spark.sparkContext._jvm

    def write(batch: DataFrame, number: int) -> None:
        before = batch.limit(0) if number == 0 else spark.read.schema(batch.schema).parquet(f"{path}/batch={number - 1}")
        upsert(before.unionByName(batch), keys, order).select(batch.columns).write.mode("overwrite").parquet(f"{path}/batch={number}")
        old = jvm.org.apache.hadoop.fs.Path(f"{path}/batch={number - 2}")
        old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)

    return write
