"""Grids, hashes, corrections and review over ``lineitem``, ``documents`` and ``labels``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexlake.catalog import query, table
from codexlake.operators import segment, tables


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two cells a line: an order is a table, a line number a row of it."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    pos = F.struct("l_partkey", "l_suppkey")
    cell = lambda k, c: line.select("l_orderkey", F.concat(F.lit("/Table/TR["), F.col("l_linenumber"), F.lit(f"]/TD[{k}]")).alias("path"), pos.alias("pos"), F.col(c).alias("text"))
    return cell(1, "l_returnflag").unionByName(cell(2, "l_linestatus"))


@query("""
WITH n AS (SELECT l_orderkey, max(l_linenumber) AS nr FROM lineitem GROUP BY l_orderkey),
r AS (SELECT l_orderkey, nr, unnest(range(1, nr + 1)) AS r FROM n),
c AS (SELECT l_orderkey, l_linenumber, string_agg(l_returnflag, ' ' ORDER BY l_partkey, l_suppkey, l_returnflag) AS c1, string_agg(l_linestatus, ' ' ORDER BY l_partkey, l_suppkey, l_linestatus) AS c2 FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT r.l_orderkey, string_agg(coalesce(c1, '') || '|' || coalesce(c2, ''), chr(10) ORDER BY r) AS grid, true AS rectangular
FROM r LEFT JOIN c ON r.l_orderkey = c.l_orderkey AND r.r = c.l_linenumber GROUP BY r.l_orderkey
""")
def grid_from_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tables.grid(_cells(spark, sf_dir), ["l_orderkey"], tables.path_index("path", tables.ROW), tables.path_index("path", tables.CELL), "pos", "text")
    return out.select("l_orderkey", F.array_join(F.transform("grid", lambda r: F.array_join(r, "|")), "\n").alias("grid"), tables.rectangular("grid").alias("rectangular"))


@query("""
WITH c AS (SELECT l_orderkey, '/Table/TR[' || l_linenumber || ']/TD[1]' AS path, l_partkey, l_suppkey, l_returnflag AS t FROM lineitem
  UNION ALL SELECT l_orderkey, '/Table/TR[' || l_linenumber || ']/TD[2]', l_partkey, l_suppkey, l_linestatus FROM lineitem)
SELECT l_orderkey, substr(sha256(string_agg(t, '|' ORDER BY path, l_partkey, l_suppkey, t)), 1, 16) AS hash FROM c GROUP BY l_orderkey
""")
def table_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.content_hash(_cells(spark, sf_dir), ["l_orderkey"], "path", "pos", "text")


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("""
WITH s AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT count(*) AS n_laws, sum(n)::BIGINT AS n_tables, round(avg(n), 6) AS mean_tables, round(median(n), 6) AS median_tables, round(coalesce(stddev_samp(n), 0), 6) AS stdev_tables, min(n) AS min_tables, max(n) AS max_tables,
  count(*) FILTER (n = 1) AS single, count(*) FILTER (n BETWEEN 2 AND 5) AS few, count(*) FILTER (n >= 6) AS many FROM s
""")
def review_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.statistics(_sizes(spark, sf_dir), "n")


_STATUS = "CASE WHEN l.doc_id IS NULL THEN NULL WHEN toxic = 1 THEN 'rejected' WHEN quality = 1 THEN 'confirmed' ELSE 'merged_with_x' END"


def _corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label as a decision on its document's table."""
    status = F.when(F.col("toxic") == 1, "rejected").when(F.col("quality") == 1, "confirmed").otherwise("merged_with_x")
    grid = F.array(F.array(F.col("doc_id").cast("string")))
    other = F.when(F.col("doc_id") % 2 == 0, F.array(F.array(F.lit("x")))).otherwise(grid)
    return table(spark, sf_dir, "labels").select("doc_id", status.alias("status"), grid.alias("original"), other.alias("corrected"))


@query("""
SELECT d.doc_id, CASE WHEN toxic = 1 THEN 'rejected' WHEN quality = 1 AND d.doc_id % 2 = 0 THEN 'confirmed_with_changes' WHEN quality = 1 THEN 'confirmed_without_changes' WHEN l.doc_id IS NOT NULL THEN 'merged' END AS decision,
  CASE WHEN toxic = 1 THEN 'untabled' WHEN quality = 1 AND d.doc_id % 2 = 0 THEN 'rebuilt' WHEN quality = 1 OR l.doc_id IS NULL THEN 'kept' ELSE 'merged' END AS outcome
FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def correction_status_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return tables.apply_corrections(docs, _corrections(spark, sf_dir), ["doc_id"]).select("doc_id", "decision", "outcome")


@query("""
SELECT source, lang, (2 - grouping(source) - grouping(lang))::INT AS depth, count(*) AS n_tables, count(l.doc_id) AS n_decided, count(*) FILTER (toxic = 1) AS n_rejected, count(*) FILTER (l.doc_id IS NULL) AS n_undecided,
  round(100.0 * count(l.doc_id) / count(*), 6) AS percent FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY ROLLUP (source, lang)
""")
def review_progress_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from codexlake.operators.hierarchy import rollup_counts

    both = table(spark, sf_dir, "documents").select("doc_id", "source", "lang").join(table(spark, sf_dir, "labels").select("doc_id", "toxic", F.lit(True).alias("decided")), "doc_id", "left")
    n, decided = F.count("*"), F.count("decided")
    return rollup_counts(both, ["source", "lang"], [n.alias("n_tables"), decided.alias("n_decided"), F.count_if(F.col("toxic") == 1).alias("n_rejected"), (n - decided).alias("n_undecided"), F.round(decided * 100.0 / n, 6).alias("percent")])


@query("""
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)
""")
def new_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that get a first, undefined correction."""
    labels = table(spark, sf_dir, "labels")
    return tables.new_tables(table(spark, sf_dir, "documents"), labels, ["doc_id"]).select("doc_id")


@query("""
SELECT doc_id, concat_ws(';', CASE WHEN n_chars <> length(text) THEN 'size differs' END, CASE WHEN trim(source) = '' OR source IS NULL THEN 'no source' END, CASE WHEN lang NOT IN ('en', 'de') THEN 'unknown language' END,
  CASE WHEN length(text) < 100 THEN 'too short' END, CASE WHEN quality = 0 AND toxic = 1 THEN 'bad twice' END) AS errors FROM documents LEFT JOIN labels USING (doc_id)
""")
def validate_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    rules = {
        "size differs": F.col("n_chars") != F.length("text"), "no source": F.col("source").isNull() | (F.trim("source") == ""), "unknown language": ~F.col("lang").isin("en", "de"),
        "too short": F.length("text") < 100, "bad twice": (F.col("quality") == 0) & (F.col("toxic") == 1),
    }
    return both.select("doc_id", F.array_join(tables.correction_errors(rules), ";").alias("errors"))


@query("""
SELECT l_orderkey AS law, (l_partkey % 50)::VARCHAR AS prov, l_linenumber::VARCHAR AS sub, count(*)::INT AS sequences FROM lineitem GROUP BY ALL
UNION ALL SELECT DISTINCT l_orderkey, (l_partkey % 50)::VARCHAR, NULL, 0 FROM lineitem
""")
def anchor_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("law"), (F.col("l_partkey") % 50).cast("string").alias("prov"), F.col("l_linenumber").cast("string").alias("sub"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    rows = segment.occurrence(line, ["law", "prov", "sub"], ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    return segment.anchor_map(rows, "law", "prov", "sub", "seq")


@query("""
SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1 THEN '#fn-' || l_linenumber::VARCHAR ELSE '#footnote-line' END AS target FROM lineitem
""")
def footnote_unique_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return segment.unique_target(line, ["l_orderkey"], "l_linenumber", F.concat(F.lit("#fn-"), F.col("l_linenumber").cast("string")), F.lit("#footnote-line"))


@query("""
WITH s AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) SELECT l_orderkey, n FROM s ORDER BY n DESC, l_orderkey LIMIT 5
""")
def top_laws_by_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sizes(spark, sf_dir).orderBy(F.desc("n"), "l_orderkey").limit(5)
