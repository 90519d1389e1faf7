"""Version algebra over ``orders``: a customer is a law, an order a version of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexlake.catalog import query, table
from codexlake.operators import hierarchy, versions, workflow


def _day(c: str):
    return F.date_format(c, "yyyy-MM-dd")


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority")


@query("""
SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS latest_date, o_orderstatus = 'O' AS in_force
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1
""")
def latest_version_per_law(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = versions.latest(_versions(spark, sf_dir), "o_custkey", [F.col("o_orderdate"), -F.col("o_orderkey")], ["o_orderkey", "o_orderdate", "o_orderstatus"])
    return out.select("o_custkey", "o_orderkey", _day("o_orderdate").alias("latest_date"), (F.col("o_orderstatus") == "O").alias("in_force"))


@query("""
WITH latest AS (
  SELECT o_custkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1)
SELECT r_name, n_name, (2 - grouping(r_name) - grouping(n_name))::INT AS depth, count(*) AS n_laws, count(*) FILTER (o_orderstatus = 'O') AS n_in_force
FROM latest JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ROLLUP (r_name, n_name)
""")
def latest_version_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = versions.latest(_versions(spark, sf_dir), "o_custkey", [F.col("o_orderdate"), -F.col("o_orderkey")], ["o_orderstatus"])
    named = (
        latest.join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return hierarchy.rollup_counts(named, ["r_name", "n_name"], [F.count("*").alias("n_laws"), F.count_if(F.col("o_orderstatus") == "O").alias("n_in_force")])


@query("""
SELECT a.o_orderkey, a.o_custkey,
  coalesce((SELECT string_agg(b.o_orderkey::VARCHAR, ',' ORDER BY b.o_orderdate, b.o_orderkey) FROM orders b WHERE b.o_custkey = a.o_custkey AND b.o_orderdate < a.o_orderdate), '') AS older,
  coalesce((SELECT string_agg(b.o_orderkey::VARCHAR, ',' ORDER BY b.o_orderdate, b.o_orderkey) FROM orders b WHERE b.o_custkey = a.o_custkey AND b.o_orderdate > a.o_orderdate), '') AS newer
FROM orders a
""")
def older_newer_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = versions.links(_versions(spark, sf_dir), "o_custkey", "o_orderdate", F.col("o_orderkey").cast("string"), "o_orderkey")
    return out.select("o_orderkey", "o_custkey", F.array_join("older", ",").alias("older"), F.array_join("newer", ",").alias("newer"))


@query("""
SELECT o_orderkey, o_custkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) - 1 AS n_older, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) - 1 AS n_newer,
  CASE WHEN rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) > 1 THEN first_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END::VARCHAR AS oldest,
  CASE WHEN rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) > 1 THEN last_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END::VARCHAR AS newest
FROM orders
""")
def older_newer_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = versions.ranks(_versions(spark, sf_dir), "o_custkey", "o_orderdate", "o_orderkey")
    return out.select("o_orderkey", "o_custkey", F.col("n_older").cast("long").alias("n_older"), F.col("n_newer").cast("long").alias("n_newer"), F.col("oldest").cast("string"), F.col("newest").cast("string"))


@query("""
SELECT o_orderkey, o_custkey, (lag(o_orderkey) OVER w)::VARCHAR AS prev, (lead(o_orderkey) OVER w)::VARCHAR AS next,
  last_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS newest
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def prev_next_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.neighbours(_versions(spark, sf_dir), "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderkey").select("o_orderkey", "o_custkey", F.col("prev").cast("string"), F.col("next").cast("string"), "newest")


_PAIRS = """
pairs AS (
  SELECT o_custkey, o_orderkey AS newer, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS older,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)::INT AS rank FROM orders)
"""


@query(f"WITH {_PAIRS} SELECT * FROM pairs WHERE rank < 3 AND older IS NOT NULL")
def consecutive_pairs_last3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.consecutive_pairs(_versions(spark, sf_dir), "o_custkey", [F.desc("o_orderdate"), F.desc("o_orderkey")], "o_orderkey")


@query("""
WITH n AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT count(*) FILTER (n > 1) AS laws_with_pairs, sum(n - 1)::BIGINT AS total_pairs, sum(least(n, 3) - 1)::BIGINT AS limited_pairs,
  count(*) FILTER (n > 3) AS reduced_laws, round(100.0 * (sum(n - 1) - sum(least(n, 3) - 1)) / sum(n - 1), 6) AS reduction_percent FROM n
""")
def pair_reduction_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _versions(spark, sf_dir).groupBy("o_custkey").agg(F.count("*").alias("n"))
    total, limited = F.sum(F.col("n") - 1), F.sum(F.least("n", F.lit(3)) - 1)
    return n.agg(
        F.count_if(F.col("n") > 1).alias("laws_with_pairs"), total.alias("total_pairs"), limited.alias("limited_pairs"), F.count_if(F.col("n") > 3).alias("reduced_laws"),
        F.round((total - limited) * 100.0 / total, 6).alias("reduction_percent"),
    )


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
SELECT o_orderkey, o_custkey, o_orderstatus FROM r WHERE NOT (rn = 1 AND o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT')
""")
def terminal_version_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "1-URGENT")
    return versions.drop_terminal(_versions(spark, sf_dir), "o_custkey", [F.desc("o_orderdate"), F.desc("o_orderkey")], gone).select("o_orderkey", "o_custkey", "o_orderstatus")


@query("""
WITH first AS (SELECT l_orderkey, l_shipdate, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_shipdate ORDER BY l_partkey, l_suppkey) = 1)
SELECT l_orderkey, strftime(l_shipdate, '%Y-%m-%d') AS version, l_partkey FROM first
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'O')
""")
def missing_versions_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    have = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("l_orderkey"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_partkey", "l_suppkey").join(have, "l_orderkey", "left_anti")
    none = lines.select("l_orderkey", "l_shipdate").where(F.lit(False))
    return versions.missing(lines, none, ["l_orderkey", "l_shipdate"], ["l_partkey", "l_suppkey"]).select("l_orderkey", _day("l_shipdate").alias("version"), "l_partkey")


@query("""
WITH cut AS (SELECT count(*) // 2 AS m FROM events)
SELECT DISTINCT user_id, event_type, floor(value)::BIGINT AS version FROM events, cut WHERE event_id >= m
EXCEPT SELECT user_id, event_type, floor(value)::BIGINT FROM events, cut WHERE event_id < m
""")
def incremental_new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the second half that the first half has not; a first run would have stored those."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.floor("value").alias("version"))
    middle = events.count() // 2
    on = ["user_id", "event_type", "version"]
    return events.where(F.col("event_id") >= middle).select(*on).distinct().join(events.where(F.col("event_id") < middle).select(*on), on, "left_anti")


@query("""
SELECT user_id, event_type, event_id, round(value, 6) AS value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def upsert_last_writer_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return versions.upsert(events, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id", F.round("value", 6).alias("value"))


@query("""
SELECT o_custkey, arg_min(o_orderpriority, o.o_orderkey) AS first_priority, count(*) AS n_versions,
  string_agg(strftime(o.o_orderdate, '%Y%m%d'), ',' ORDER BY o.o_orderdate DESC, o.o_orderkey DESC) AS versions FROM orders o GROUP BY o_custkey
""")
def consolidate_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First document supplies the law's fields; its versions follow newest first."""
    rows = F.sort_array(F.collect_list(F.struct("o_orderdate", "o_orderkey")), asc=False)
    out = _versions(spark, sf_dir).groupBy("o_custkey").agg(F.min_by("o_orderpriority", "o_orderkey").alias("first_priority"), F.count("*").alias("n_versions"), rows.alias("rows"))
    return out.select("o_custkey", "first_priority", "n_versions", F.array_join(F.transform("rows", lambda r: F.date_format(r["o_orderdate"], "yyyyMMdd")), ",").alias("versions"))


@query("""
WITH v AS (SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM orders),
latest AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT o_custkey, o_orderkey, row_number() OVER (ORDER BY o_custkey)::INT AS position, (lead(o_custkey) OVER (ORDER BY o_custkey))::VARCHAR AS next_law FROM latest WHERE o_orderstatus <> 'O'
""")
def review_work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laws whose latest version needs review, in order, each with the next one."""
    latest = versions.latest(_versions(spark, sf_dir), "o_custkey", [F.col("o_orderdate"), F.col("o_orderkey")], ["o_orderkey", "o_orderstatus"]).where("o_orderstatus <> 'O'")
    return workflow.positions(latest, "o_custkey").select("o_custkey", "o_orderkey", "position", F.col("next").cast("string").alias("next_law"))
