"""Queries that a published collection answers: look-ups, ranks, sitemap, feed, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codexlake.catalog import query, table
from codexlake.functions import scalar
from codexlake.operators import text
from codexlake.sources import sinks


@query("""
SELECT p_partkey, p_name, p_brand, CASE WHEN lower(p_brand) = 'brand#1' THEN 0 WHEN starts_with(lower(p_brand), 'brand#1') THEN 1 ELSE 2 END::INT AS match_rank FROM part
WHERE contains(lower(p_name), 'brand#1') OR contains(lower(p_brand), 'brand#1') OR contains(lower(p_type), 'brand#1') ORDER BY match_rank, p_brand, p_partkey LIMIT 15
""")
def autocomplete_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return text.autocomplete(part, "Brand#1", ["p_name", "p_brand", "p_type"], "p_brand", ["p_brand", "p_partkey"]).drop("p_type")


@query("""
WITH w AS (SELECT DISTINCT p_type, lower(p_type) AS exact, lower(substr(p_type, 1, 3)) AS start FROM part),
m AS (SELECT w.p_type, p_partkey, CASE WHEN lower(p_name) = exact THEN 0 WHEN starts_with(lower(p_name), start) THEN 1 WHEN contains(lower(p_name), substr(start, 1, 2)) THEN 2 END::INT AS match_rank FROM w, part)
SELECT p_type, p_partkey, match_rank FROM m WHERE match_rank IS NOT NULL QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY match_rank, p_partkey) = 1
""")
def exact_then_partial_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best part for each searched word: equal, then begins with, then contains.

    Equal names collapse first. A name meets a word by equality with one of the
    name's own two-letter pieces, so nothing is compared all with all.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    words = part.select("p_type").distinct().withColumns({"exact": F.lower("p_type"), "start": F.lower(F.substring("p_type", 1, 3))})
    names = part.groupBy(F.lower("p_name").alias("name")).agg(F.min("p_partkey").alias("p_partkey"))
    pieces = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("name") - 1), lambda i: F.substring(F.col("name"), i, F.lit(2))))
    both = names.where(F.length("name") > 1).withColumn("piece", F.explode(pieces)).join(words, F.col("piece") == F.substring("start", 1, 2))
    rank = F.when(F.col("name") == F.col("exact"), 0).when(F.startswith("name", "start"), 1).otherwise(2)
    return both.withColumn("match_rank", rank).groupBy("p_type").agg(F.min(F.struct("match_rank", "p_partkey")).alias("b")).select("p_type", "b.p_partkey", "b.match_rank")


_PRIORITY = "CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 4 ELSE 5 END::INT"


def _affairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as affairs of the day's dispatch."""
    kind = F.create_map(
        F.lit("1-URGENT"), F.lit("Vorlage des Rates"), F.lit("2-HIGH"), F.lit("EINZELINITIATIVE"), F.lit("3-MEDIUM"), F.lit("Behördeninitiative"), F.lit("4-NOT SPECIFIED"), F.lit("Parlamentarische Initiative")
    )
    return table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyyMMdd").alias("dispatch_date"), F.col("o_orderkey").alias("pos"), F.concat(F.lit("Order & "), F.col("o_orderkey").cast("string")).alias("title"),
        F.coalesce(F.try_element_at(kind, F.col("o_orderpriority")), F.lit("Motion")).alias("affair_type"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey").cast("string")).alias("guid"), F.concat(F.lit("https://e.org/?a=1&b="), F.col("o_orderkey").cast("string")).alias("link"),
    )


@query(f"""
SELECT 'Order &amp; ' || o_orderkey::VARCHAR AS title, 'https://e.org/?a=1&amp;b=' || o_orderkey::VARCHAR AS link, strftime(o_orderdate, '%a, %d %b %Y 00:00:00 -0000') AS pub_date,
  strftime(o_orderdate, '%Y%m%d') || '-' || CASE WHEN o_orderkey % 2 = 0 THEN o_custkey::VARCHAR ELSE substr(md5('Order & ' || o_orderkey::VARCHAR), 1, 12) END AS guid, {_PRIORITY} AS priority
FROM orders ORDER BY strftime(o_orderdate, '%Y%m%d') DESC, priority, o_orderkey LIMIT 100
""")
def affair_priority_top100(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.feed_items(_affairs(spark, sf_dir))


@query(f"SELECT o_orderkey, {_PRIORITY} AS priority, row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y%m%d') ORDER BY {_PRIORITY}, o_orderkey)::INT AS place FROM orders")
def sort_affairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Affairs of a dispatch by kind, then as they came."""
    out = _affairs(spark, sf_dir).withColumn("priority", scalar.affair_priority("affair_type"))
    return out.withColumn("place", F.row_number().over(Window.partitionBy("dispatch_date").orderBy("priority", "pos"))).select(F.col("pos").alias("o_orderkey"), "priority", "place")


@query("""
WITH p AS (SELECT page_id, url, regexp_extract(url, '://([^/?#]*)', 1) AS host, coalesce(try_cast(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT), 0) AS n FROM pages),
m AS (SELECT host, arg_max(url, (n, page_id)) AS canonical FROM p GROUP BY host)
SELECT page_id, CASE WHEN contains(url, '#') THEN 0.1 WHEN contains(url, '/en/') THEN 1.0 WHEN contains(url, '?') THEN 0.2 ELSE 0.8 END::DOUBLE AS priority, CASE WHEN canonical <> url THEN canonical END AS canonical FROM p JOIN m USING (host)
""")
def sitemap_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priority and canonical URL: the page of the greatest number on a host."""
    url = F.col("url")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.regexp_extract("url", "://([^/?#]*)", 1).alias("host"), F.coalesce(F.regexp_extract("url", r"/(\d+)", 1).try_cast("long"), F.lit(0)).alias("n"))
    best = pages.groupBy("host").agg(F.max_by("url", F.struct("n", "page_id")).alias("best"))
    priority = F.when(url.contains("#"), 0.1).when(url.contains("/en/"), 1.0).when(url.contains("?"), 0.2).otherwise(0.8)
    return pages.join(best, "host").select("page_id", priority.alias("priority"), F.when(F.col("best") != url, F.col("best")).alias("canonical"))


@query("""
SELECT '<url><loc>' || replace(replace(url, '&', '&amp;'), '''', '&apos;') || '</loc><lastmod>2024-02-29</lastmod><priority>' || CASE WHEN contains(url, '?') THEN '0.2' ELSE '1.0' END || '</priority></url>' AS value FROM pages
""")
def sitemap_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("url").alias("loc"), F.lit("2024-02-29").alias("lastmod"), F.when(F.col("url").contains("?"), 0.2).otherwise(1.0).alias("priority"), F.lit(None).cast("string").alias("canonical"))
    return sinks.sitemap_lines(pages)


@query("""
WITH latest AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1)
SELECT c_custkey::VARCHAR AS "Nummer", c_name AS "Titel", coalesce(n_name, '') AS "Kategorie", coalesce(strftime(o_orderdate, '%Y-%m-%d'), '') AS "Datum", CASE WHEN o_orderstatus = 'O' THEN 'Ja' ELSE 'Nein' END AS "In Kraft"
FROM customer LEFT JOIN latest ON c_custkey = o_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a law, as the CSV sink writes it."""
    from codexlake.operators import versions

    latest = versions.latest(table(spark, sf_dir, "orders"), "o_custkey", [F.col("o_orderdate"), -F.col("o_orderkey")], ["o_orderdate", "o_orderstatus"])
    rows = table(spark, sf_dir, "customer").join(latest, F.col("c_custkey") == F.col("o_custkey"), "left").join(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.select(
        F.col("c_custkey").cast("string").alias("Nummer"), F.col("c_name").alias("Titel"), F.coalesce("n_name", F.lit("")).alias("Kategorie"),
        F.coalesce(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("")).alias("Datum"), F.when(F.col("o_orderstatus") == "O", "Ja").otherwise("Nein").alias("In Kraft"),
    )


@query("""
SELECT o_orderkey, '<h1>' || o_orderkey::VARCHAR || ' / ' || o_custkey::VARCHAR || '</h1>' AS page FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
""")
def placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return sinks.placeholders(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), published, ["o_orderkey"], "<h1>%d / %d</h1>", ["o_orderkey", "o_custkey"]).select("o_orderkey", "page")


@query("""
WITH o AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
SELECT o_orderkey, l_orderkey IS NOT NULL AS exists_in_latest, CASE WHEN l_orderkey IS NOT NULL THEN '/col/' || o_custkey || '/latest#p' || o_orderkey ELSE '/col/' || o_custkey || '/latest' END AS redirect FROM orders LEFT JOIN o ON l_orderkey = o_orderkey
""")
def anchor_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A redirect to the latest version keeps its anchor only where that exists."""
    have = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), F.lit(True).alias("_have")).distinct()
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(have, "o_orderkey", "left")
    page = F.concat(F.lit("/col/"), F.col("o_custkey").cast("string"), F.lit("/latest"))
    return rows.select("o_orderkey", F.coalesce("_have", F.lit(False)).alias("exists_in_latest"), F.concat(page, F.when(F.col("_have"), F.concat(F.lit("#p"), F.col("o_orderkey").cast("string"))).otherwise("")).alias("redirect"))


@query("""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \\t\\n\\r]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, w, coalesce(list_position(list_transform(w, lambda x: contains(lower(x), 'tion')), true), 1) - 1 AS hit FROM w)
SELECT doc_id, array_to_string(list_slice(w, greatest(hit - 10, 0) + 1, greatest(hit - 10, 0) + 20), ' ') AS excerpt FROM p
""")
def search_excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.excerpt("text", "tion").alias("excerpt"))
