"""Acquisition and processing state over orders, lineitem, events and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexlake.catalog import query, table
from codexlake.operators import workflow
from codexlake.sources.records import current_laws


@query("""
SELECT DISTINCT o_custkey::VARCHAR AS number, strftime(o_orderdate, '%Y-%m-%d') AS start, o_orderpriority AS url FROM orders
WHERE strftime(o_orderdate, '%Y-%m-%d') <= '1998-01-01' AND (o_orderstatus <> 'F' OR '1998-06-01' >= '1998-01-01')
""")
def current_laws_from_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders taken apart into triples and joined again; finished ones have an end."""
    o = table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    facts = F.array(
        F.struct(F.lit("number").alias("p"), F.col("o_custkey").cast("string").alias("o")), F.struct(F.lit("start").alias("p"), day.alias("o")),
        F.struct(F.lit("url").alias("p"), F.col("o_orderpriority").alias("o")), F.struct(F.when(F.col("o_orderstatus") == "F", "end").alias("p"), F.lit("1998-06-01").alias("o")),
    )
    triples = o.select(F.col("o_orderkey").alias("s"), F.inline(facts)).where("p is not null")
    return current_laws(triples, "number", "start", "end", "url", F.lit("1998-01-01"))


@query("""
SELECT c_custkey, coalesce(arg_max(strftime(o_orderdate, '%Y%m%d'), o_orderkey), '') AS repealed FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' GROUP BY c_custkey
""")
def repeal_dates_of_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("repealed"))
    return workflow.lookup(table(spark, sf_dir, "customer").select("c_custkey"), facts, "c_custkey", "repealed", "o_orderkey")


@query("""
SELECT c_custkey, coalesce(string_agg(strftime(o_orderdate, '%Y%m%d'), ',' ORDER BY o_orderdate, o_orderkey), '') AS versions FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey
""")
def all_versions_of_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderdate", "o_orderkey")
    out = workflow.versions_of(table(spark, sf_dir, "customer").select("c_custkey"), facts, "c_custkey", F.date_format("o_orderdate", "yyyyMMdd"), ["o_orderdate", "o_orderkey"])
    return out.select("c_custkey", F.array_join("versions", ",").alias("versions"))


@query("""
SELECT o_orderkey, coalesce((SELECT min(l_partkey) FROM lineitem WHERE l_orderkey % 1000 = o_orderkey % 1000 AND (l_suppkey = o_custkey OR l_partkey = o_custkey)), -1) AS matched FROM orders
""")
def dispatch_back_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line of the same day that carries an order's number in either column."""
    left = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 1000).alias("day"), F.col("o_custkey").alias("number"))
    right = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 1000).alias("day"), "l_suppkey", "l_partkey")
    return workflow.match_either(left, right, "day", "number", ["l_suppkey", "l_partkey"], "l_partkey").select("o_orderkey", F.coalesce("matched", F.lit(-1)).alias("matched"))


@query("""
SELECT event_id, concat_ws(',', CASE WHEN value > 50 THEN 'repealed' END, CASE WHEN event_type = 'click' THEN 'category' END, CASE WHEN user_id % 3 = 0 THEN 'source' END) AS reasons FROM events
""")
def metadata_change_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    why = workflow.change_reasons({"repealed": F.col("value") > 50, "category": F.col("event_type") == "click", "source": F.col("user_id") % 3 == 0})
    return table(spark, sf_dir, "events").select("event_id", F.array_join(why, ",").alias("reasons"))


@query("""
SELECT o_orderkey, o_orderstatus = 'F' AND o_orderkey % 5 <> 0 AS ready, CASE WHEN o_orderstatus = 'F' THEN 3 ELSE 2 END::INT AS n_steps FROM orders
""")
def process_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Step stamps as a map; a document is ready when the steps it needs are stamped."""
    o = table(spark, sf_dir, "orders")
    steps = F.create_map(F.lit("download"), F.when(F.col("o_orderkey") % 5 == 0, " ").otherwise("20240101-000000"), F.lit("extract"), F.lit("x"))
    o = o.withColumn("steps", steps).withColumn("steps", F.when(F.col("o_orderstatus") == "F", workflow.stamp("steps", "merge", F.lit("20240102-000000"))).otherwise(workflow.stamp("steps", "extract", F.lit("y"))))
    return o.select("o_orderkey", workflow.completed("steps", ["download", "merge"]).alias("ready"), F.size("steps").alias("n_steps"))


@query("""
SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus = 'P') AS failed, round(100.0 * count(*) FILTER (o_orderstatus = 'F') / count(*), 6) AS percent,
  round(avg(o_orderkey % 90) FILTER (o_orderstatus = 'F'), 6) AS mean_seconds, round(avg(o_orderkey % 90) FILTER (o_orderstatus = 'F') * count(*) FILTER (o_orderstatus <> 'F'), 6) AS seconds_left FROM orders
""")
def batch_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflow.progress(table(spark, sf_dir, "orders"), F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "P", F.col("o_orderkey") % 90)


def _review(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("law"), "doc_id")
    decided = table(spark, sf_dir, "labels").join(docs, "doc_id").select("law", "doc_id", F.when(F.col("toxic") == 1, "undefined").otherwise("rejected").alias("status"))
    return docs, decided


@query("""
SELECT source AS law, count(*) AS n_tables, count(*) FILTER (l.doc_id IS NULL OR toxic = 1) AS n_undecided, count(*) FILTER (l.doc_id IS NULL OR toxic = 1) = 0 AS complete
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source
""")
def law_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflow.completion(*_review(spark, sf_dir), "law", "doc_id")


@query("SELECT source AS law, d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.doc_id IS NULL OR toxic = 1")
def undecided_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflow.undecided(*_review(spark, sf_dir), "law", "doc_id")


@query("""
WITH a AS (SELECT user_id AS doc, floor(epoch(ts))::BIGINT AS at, event_id FROM events)
SELECT h.doc, (SELECT arg_max(x.event_id, (x.at, x.event_id)) FROM a x WHERE x.doc = h.doc AND x.event_id % 10 = 0 AND x.at <= h.at)::VARCHAR AS anchor, count(*) AS n FROM a h
WHERE h.event_id % 10 <> 0 AND EXISTS (SELECT 1 FROM a x WHERE x.doc = h.doc AND x.event_id % 10 = 0 AND x.at <= h.at) GROUP BY ALL
""")
def search_hits_by_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("doc"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("at"), "event_id")
    anchors = e.where("event_id % 10 = 0").withColumn("anchor", F.lpad(F.col("event_id").cast("string"), 12, "0"))
    return workflow.hits_by_anchor(e.where("event_id % 10 <> 0"), anchors, "doc").withColumn("anchor", F.regexp_replace("anchor", "^0+(?=.)", ""))


@query("SELECT o_orderkey, round(o_totalprice, 2) AS price FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40")
def result_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return workflow.page_of(o, [F.desc("o_totalprice"), "o_orderkey"], 2).select("o_orderkey", F.round("o_totalprice", 2).alias("price"))


@query("""
SELECT 'national' AS collection, c_custkey AS number, c_name AS title FROM customer UNION ALL SELECT 'cantonal', s_suppkey, s_name FROM supplier
""")
def law_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both collections in one index; its order is the writer's."""
    one = table(spark, sf_dir, "customer").select(F.lit("national").alias("collection"), F.col("c_custkey").alias("number"), F.col("c_name").alias("title"))
    return one.unionByName(table(spark, sf_dir, "supplier").select(F.lit("cantonal").alias("collection"), F.col("s_suppkey").alias("number"), F.col("s_name").alias("title")))
