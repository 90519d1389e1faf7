"""Spans and gaps over ``events``: a user is a page, an event a box on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codexlake.catalog import query, table
from codexlake.operators import overlap


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as spans of ten to fifty minutes, in seconds."""
    lo = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "user_id", lo.cast("double").alias("lo"), (lo + 600 * (F.col("event_id") % 5 + 1)).cast("double").alias("hi"))


_SPANS = "s AS (SELECT event_id AS id, user_id, floor(epoch(ts))::DOUBLE AS lo, floor(epoch(ts))::DOUBLE + 600 * (event_id % 5 + 1) AS hi FROM events)"


@query(f"""
WITH {_SPANS}, m AS (
  SELECT a.user_id, a.id AS left_id, b.id AS right_id, least(a.hi, b.hi) - greatest(a.lo, b.lo) AS overlap FROM s a JOIN s b ON a.user_id = b.user_id AND a.id % 2 = 0 AND b.id % 2 = 1 AND a.lo < b.hi AND b.lo < a.hi)
SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY user_id, left_id ORDER BY overlap DESC, right_id) = 1
""")
def interval_overlap_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _spans(spark, sf_dir)
    return overlap.best_overlap(s.where("id % 2 = 0"), s.where("id % 2 = 1"), ["user_id"], 3600.0)


@query(f"""
WITH {_SPANS}
SELECT a.user_id, a.id AS left_id, (SELECT arg_min(b.id, (b.lo, b.id)) FROM s b WHERE b.user_id = a.user_id AND b.id % 2 = 1 AND b.lo >= a.lo)::VARCHAR AS right_id FROM s a WHERE a.id % 2 = 0
""")
def asof_next_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _spans(spark, sf_dir)
    return overlap.next_after(s.where("id % 2 = 0"), s.where("id % 2 = 1"), ["user_id"], "lo").withColumn("right_id", F.col("right_id").cast("string"))


@query("""
WITH g AS (SELECT event_id, user_id, ts, CASE WHEN floor(epoch(ts)) - lag(floor(epoch(ts))) OVER w < 86400 THEN 0 ELSE 1 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS group_id FROM g
""")
def proximity_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.unix_timestamp(F.col("ts").cast("timestamp"))
    gap = at - F.lag(at).over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return overlap.proximity_groups(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), ["user_id"], ["ts", "event_id"], gap, 86400).select("event_id", "user_id", "group_id")


@query("""
WITH g AS (SELECT event_id, user_id, ts, value, CASE WHEN floor(epoch(ts)) - lag(floor(epoch(ts))) OVER w < 86400 THEN 0 ELSE 1 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS group_id FROM g)
SELECT user_id, group_id, min(floor(epoch(ts)))::DOUBLE AS y0, max(floor(epoch(ts)))::DOUBLE AS y1, round(min(value), 6) AS x0, round(max(value), 6) AS x1, count(*) AS n FROM n GROUP BY user_id, group_id
""")
def group_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The box around each group of near rows."""
    at = F.unix_timestamp(F.col("ts").cast("timestamp"))
    gap = at - F.lag(at).over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    grouped = overlap.proximity_groups(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], gap, 86400)
    return grouped.groupBy("user_id", "group_id").agg(F.min(at).cast("double").alias("y0"), F.max(at).cast("double").alias("y1"), F.round(F.min("value"), 6).alias("x0"), F.round(F.max("value"), 6).alias("x1"), F.count("*").alias("n"))
