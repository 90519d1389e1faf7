"""Hierarchy queries over region, nation and customer, and over part numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexlake.catalog import query, table
from codexlake.functions import scalar
from codexlake.operators import hierarchy


@query("""
SELECT c_custkey, r_name AS name1, n_name AS name2, c_mktsegment AS name3
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""")
def category_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment").join(nation.select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    segments = table(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    text = lambda c: F.col(c).cast("string")
    codes = (
        region.select(F.lit(1).alias("level"), text("r_regionkey").alias("code"), F.col("r_name").alias("name"))
        .union(nation.select(F.lit(2), text("n_nationkey"), "n_name"))
        .union(segments.select(F.lit(3), "c_mktsegment", "c_mktsegment"))
    )
    return hierarchy.assign(customer, codes, [text("n_regionkey"), text("c_nationkey"), F.col("c_mktsegment")]).select("c_custkey", "name1", "name2", "name3")


@query("""
SELECT r_name, n_name, c_mktsegment, (3 - grouping(r_name) - grouping(n_name) - grouping(c_mktsegment))::INT AS depth, count(*) AS n_laws
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name, c_mktsegment)
""")
def category_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return hierarchy.rollup_counts(named, ["r_name", "n_name", "c_mktsegment"], [F.count("*").alias("n_laws")])


_NUMBER = "CASE WHEN p_partkey % 5 = 0 THEN '0.' ELSE '' END || p_partkey::VARCHAR || CASE WHEN p_partkey % 3 = 0 THEN '.1' ELSE '' END"


@query(f"""
WITH n AS (SELECT p_partkey, {_NUMBER} AS number FROM part),
g AS (SELECT *, CASE WHEN starts_with(number, '0.') THEN '0.' ELSE '' END AS z, regexp_extract(CASE WHEN starts_with(number, '0.') THEN substr(number, 3) ELSE number END, '^([0-9]+)', 1) AS d FROM n)
SELECT p_partkey, number, CASE WHEN length(d) >= 1 THEN z || substr(d, 1, 1) END AS folder, CASE WHEN length(d) >= 2 THEN z || substr(d, 1, 2) END AS section,
  CASE WHEN length(d) >= 3 THEN z || substr(d, 1, 3) END AS subsection FROM g
""")
def derive_category_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    number = F.concat(F.when(key % 5 == 0, "0.").otherwise(""), key.cast("string"), F.when(key % 3 == 0, ".1").otherwise(""))
    out = table(spark, sf_dir, "part").select("p_partkey", number.alias("number"))
    return out.withColumn("codes", scalar.category_codes("number")).select("p_partkey", "number", "codes.folder", "codes.section", "codes.subsection")


@query("""
WITH RECURSIVE walk(node, root, depth) AS (
  SELECT n_nationkey, n_nationkey, 0 FROM nation
  UNION ALL SELECT n_regionkey, root, depth + 1 FROM walk JOIN nation ON node = n_nationkey WHERE n_regionkey < node AND depth < 10)
SELECT root AS n_nationkey, min(node) AS fixpoint, max(depth)::INT AS steps FROM walk GROUP BY root
""")
def fixpoint_asset_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Follow each asset's import until nothing changes, at most ten steps."""
    edges = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("node"), F.col("n_regionkey").alias("to"))
    edges.createOrReplaceTempView("_codexlake_imports")
    return spark.sql("""
      WITH RECURSIVE walk(node, root, depth) AS (
        SELECT node, node, 0 FROM _codexlake_imports
        UNION ALL SELECT i.to, w.root, w.depth + 1 FROM walk w JOIN _codexlake_imports i ON w.node = i.node WHERE i.to < w.node AND w.depth < 10)
      SELECT root AS n_nationkey, min(node) AS fixpoint, max(depth) AS steps FROM walk GROUP BY root""")
