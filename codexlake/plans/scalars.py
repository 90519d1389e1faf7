"""Scalar rules over whole tables, with bad input mixed in by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexlake.catalog import query, table
from codexlake.functions import scalar
from codexlake.operators import workflow


@query("""
WITH d AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y%m%d') WHEN 1 THEN strftime(o_orderdate, ' %Y-%m-%d ') WHEN 2 THEN strftime(o_orderdate, '%Y') || '0230'
    WHEN 3 THEN '' WHEN 4 THEN strftime(o_orderdate, '%d.%m.%Y') END AS raw FROM orders),
p AS (SELECT o_orderkey, raw, CASE WHEN regexp_full_match(trim(raw), '[0-9]{8}') THEN try_strptime(trim(raw), '%Y%m%d')::DATE
  WHEN regexp_full_match(trim(raw), '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}') THEN try_cast(trim(raw) AS DATE) END AS d FROM d)
SELECT o_orderkey, raw, d IS NOT NULL OR trim(coalesce(raw, '')) = '' AS valid, coalesce(strftime(d, '%Y-%m-%d'), '') AS iso, coalesce(strftime(d, '%Y%m%d'), '') AS compact, coalesce(strftime(d, '%d.%m.%Y'), 'N/A') AS shown,
  strftime(d, '%a, %d %b %Y 00:00:00 -0000') AS feed, CASE WHEN regexp_full_match(trim(raw), '[0-9]{2}\\.[0-9]{2}\\.[0-9]{4}') THEN strftime(strptime(trim(raw), '%d.%m.%Y'), '%Y%m%d') ELSE '' END AS from_shown FROM p
""")
def date_safe_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, kind = F.col("o_orderdate"), F.col("o_orderkey") % 6
    raw = (
        F.when(kind == 0, F.date_format(day, "yyyyMMdd")).when(kind == 1, F.concat(F.lit(" "), F.date_format(day, "yyyy-MM-dd"), F.lit(" ")))
        .when(kind == 2, F.concat(F.date_format(day, "yyyy"), F.lit("0230"))).when(kind == 3, "").when(kind == 4, F.date_format(day, "dd.MM.yyyy"))
    )
    out = table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    return out.select(
        "o_orderkey", "raw", scalar.date_is_valid("raw").alias("valid"), scalar.iso_date("raw").alias("iso"), scalar.compact_date("raw").alias("compact"),
        scalar.swiss_date("raw").alias("shown"), scalar.feed_date("raw").alias("feed"), scalar.from_swiss_date("raw").alias("from_shown"),
    )


@query("""
WITH r AS (SELECT event_id, CASE event_id % 9 WHEN 0 THEN 'true' WHEN 1 THEN ' Yes ' WHEN 2 THEN 'off' WHEN 3 THEN '' WHEN 4 THEN 'x' WHEN 5 THEN '12.7' WHEN 6 THEN '-3' WHEN 7 THEN '1' END AS raw FROM events)
SELECT event_id, CASE WHEN lower(trim(raw)) IN ('true', '1', 'yes', 'on') THEN true WHEN lower(trim(raw)) IN ('false', '0', 'no', 'off', '') THEN false END AS as_bool,
  try_cast(trim(raw) AS DOUBLE) AS as_float, trunc(try_cast(trim(raw) AS DOUBLE))::INT::VARCHAR AS as_int FROM r
""")
def bool_float_int_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr("CASE event_id % 9 WHEN 0 THEN 'true' WHEN 1 THEN ' Yes ' WHEN 2 THEN 'off' WHEN 3 THEN '' WHEN 4 THEN 'x' WHEN 5 THEN '12.7' WHEN 6 THEN '-3' WHEN 7 THEN '1' END")
    out = table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return out.select("event_id", scalar.bool_safe("raw").alias("as_bool"), scalar.float_safe("raw").alias("as_float"), scalar.int_safe("raw").cast("string").alias("as_int"))


@query("""
WITH v AS (SELECT p_partkey, lpad((p_partkey % 120)::VARCHAR, 3, '0') || CASE p_partkey % 4 WHEN 1 THEN 'a' WHEN 2 THEN 'k' WHEN 3 THEN 'aa' ELSE '' END AS version FROM part)
SELECT p_partkey, version, CASE p_partkey % 4 WHEN 0 THEN (p_partkey % 120)::DOUBLE WHEN 1 THEN ((p_partkey % 120)::VARCHAR || '.1')::DOUBLE ELSE ((p_partkey % 120)::VARCHAR || '.11')::DOUBLE END AS number FROM v
""")
def version_letters_to_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    version = F.concat(F.lpad((key % 120).cast("string"), 3, "0"), F.when(key % 4 == 1, "a").when(key % 4 == 2, "k").when(key % 4 == 3, "aa").otherwise(""))
    return table(spark, sf_dir, "part").select("p_partkey", version.alias("version")).select("p_partkey", "version", scalar.version_number("version").alias("number"))


@query("""
WITH k AS (SELECT p_partkey, p_brand, regexp_replace(lower(p_brand), '[0-9]+$', '') || lpad(regexp_extract(p_brand, '([0-9]+)$', 1), 20, '0') AS key FROM part)
SELECT p_partkey, p_brand, dense_rank() OVER (ORDER BY key)::INT AS natural_rank FROM k
""")
def natural_sort_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank of each label; ranks are made over the distinct keys alone, then joined back."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", scalar.natural_key("p_brand").alias("key"))
    ranks = workflow.positions(part.select("key").distinct(), "key", "natural_rank").select("key", "natural_rank")
    return part.join(ranks, "key").select("p_partkey", "p_brand", "natural_rank")


@query("""
WITH p AS (SELECT page_id, regexp_replace(url, '^https?://', '') AS r, url FROM pages)
SELECT page_id, regexp_extract(url, '^(https?)://', 1) AS scheme, regexp_extract(r, '^([^/?#]*)', 1) AS host, regexp_extract(r, '^[^/?#]*/([a-z]{2})/', 1) AS lang, regexp_extract(r, '/([0-9]+)', 1) AS number,
  regexp_extract(r, '#(.*)$', 1) AS anchor, 'https://e.org/col-ab/' || regexp_extract(r, '/([0-9]+)', 1) || '/latest' || CASE WHEN position('#' IN r) > 0 THEN '#' || regexp_extract(r, '#(.*)$', 1) ELSE '' END AS dynamic FROM p
""")
def url_parse_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    url, number = F.col("url"), F.regexp_extract(F.regexp_replace("url", "^https?://", ""), r"/(\d+)", 1)
    anchor = F.regexp_extract(url, r"#(.*)$", 1)
    static = F.concat(F.lit("https://e.org/col-ab/"), number, F.lit("-118.html"), F.when(url.contains("#"), F.concat(F.lit("#"), anchor)).otherwise(""))
    return table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract(url, r"^(https?)://", 1).alias("scheme"), F.regexp_extract(url, r"^https?://([^/?#]*)", 1).alias("host"), F.regexp_extract(url, r"^https?://[^/?#]*/([a-z]{2})/", 1).alias("lang"),
        number.alias("number"), anchor.alias("anchor"), scalar.dynamic_url(static).alias("dynamic"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, '§ ' || (l_orderkey % 400)::VARCHAR || ' Abs. ' || l_linenumber::VARCHAR AS label, (l_partkey % 7)::INT AS seq, (l_orderkey % 400)::VARCHAR AS prov, l_linenumber::VARCHAR AS sub FROM lineitem
""")
def anchor_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchor ids built from keys and taken apart again."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    anchor = F.concat(F.lit("seq-"), F.col("l_partkey") % 7, F.lit("-prov-"), F.col("l_orderkey") % 400, F.lit("-sub-"), F.col("l_linenumber"))
    out = line.withColumn("a", scalar.anchor_parts(anchor))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", scalar.reference_label("a.prov", "a.sub").alias("label"), "a.seq", "a.prov", "a.sub")


@query("""
SELECT event_id, user_id, json_extract_string(props, '$.k')::INT AS props_k, length(props)::INT AS props_size FROM events
""")
def flatten_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested JSON as columns named by their path."""
    from codexlake.sources.records import flatten_columns

    nested = table(spark, sf_dir, "events").select("event_id", "user_id", F.from_json("props", "k int").alias("props"), F.length("props").alias("props_size"))
    return flatten_columns(nested)
