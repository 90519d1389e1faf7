"""Writers: CSV with a byte order mark, XML sitemaps, feeds, JSON maps, tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codexlake.functions import scalar

TABLES = {
    "laws": "col_number STRING, number STRING, title STRING, short_title STRING, abbreviation STRING, collection STRING, source_url STRING",
    "versions": "col_number_version STRING, col_number STRING, version STRING, numeric_version DOUBLE, enacted DATE, in_force_on DATE, published DATE, repealed DATE, in_force BOOLEAN",
    "provisions": "col_number_version STRING, sequence INT, type STRING, number STRING, markdown STRING, static_url STRING, dynamic_url STRING, is_margin BOOLEAN",
}


def create_tables(spark: SparkSession, database: str = "default") -> None:
    for name, columns in TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")


def drop_tables(spark: SparkSession, database: str = "default") -> None:
    for name in reversed(TABLES):
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")


def table_counts(spark: SparkSession, database: str = "default") -> DataFrame:
    """(table, n) of the three tables."""
    out = None
    for name in TABLES:
        one = spark.table(f"{database}.{name}").agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def write_csv(df: DataFrame, path: str) -> None:
    """CSV whose header begins with a byte order mark in every part file."""
    first, *rest = df.columns
    df.select(F.col(first).alias("﻿" + first), *rest).write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def write_json_per_key(df: DataFrame, path: str, key: str) -> None:
    """One folder of JSON a key."""
    df.write.mode("overwrite").partitionBy(key).json(path)


def sitemap_lines(df: DataFrame, loc: str = "loc", lastmod: str = "lastmod", priority: str = "priority", canonical: str = "canonical") -> DataFrame:
    """One ``<url>`` fragment a row; the canonical link only where there is one."""
    link = F.when(F.col(canonical).isNotNull(), F.concat(F.lit('<xhtml:link rel="canonical" href="'), scalar.xml_escape(canonical), F.lit('"/>'))).otherwise("")
    body = F.concat(F.lit("<url><loc>"), scalar.xml_escape(loc), F.lit("</loc><lastmod>"), F.col(lastmod), F.lit("</lastmod><priority>"), F.format_number(F.col(priority), 1), F.lit("</priority>"), link, F.lit("</url>"))
    return df.select(body.alias("value"))


def feed_items(affairs: DataFrame, top: int = 100) -> DataFrame:
    """The ``top`` items of a feed: newest dispatch first, then priority, then place.

    ``affairs`` has dispatch_date, pos, title, affair_type, guid, link.
    """
    p = scalar.affair_priority("affair_type", blank=5)
    first = affairs.withColumn("priority", p).orderBy(F.desc("dispatch_date"), "priority", "pos", "title").limit(top)
    return first.select(
        scalar.xml_escape("title").alias("title"), scalar.xml_escape("link").alias("link"), scalar.feed_date("dispatch_date").alias("pub_date"),
        scalar.feed_guid("dispatch_date", "guid", "title").alias("guid"), "priority",
    )


def placeholders(versions: DataFrame, published: DataFrame, on: list[str], template: str, columns: list[str]) -> DataFrame:
    """A page for each version that has no published file."""
    return versions.join(published.select(*on).distinct(), on, "left_anti").withColumn("page", F.format_string(template, *(F.col(c) for c in columns)))


def anchor_json(anchors: DataFrame, key: str, prov: str, sub: str, sequences: str) -> DataFrame:
    """(key, json): the anchor map of each key as one JSON object."""
    subs = anchors.groupBy(key, prov).agg(
        F.max(F.when(F.col(sub).isNull(), F.col(sequences))).alias("n"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col(sub).isNotNull(), F.struct(F.col(sub).cast("string"), F.col(sequences)))))).alias("subs"),
    )
    entry = F.struct(F.col(prov).cast("string").alias("k"), F.struct(F.coalesce("n", F.lit(0)).alias("sequences"), F.col("subs").alias("subprovisions")).alias("v"))
    return subs.groupBy(key).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry), lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0)))).alias("json"))


def flat_report(df: DataFrame) -> DataFrame:
    """Structs as ``name_field`` columns, arrays joined by ', ', for a CSV report."""
    from codexlake.sources.records import flatten_columns

    flat = flatten_columns(df)
    return flat.select(*(F.array_join(F.transform(c, lambda x: x.cast("string")), ", ").alias(c) if t.startswith("array") else F.col(c) for c, t in flat.dtypes))


def numbered(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Adds ``position`` from 1 within a key."""
    return df.withColumn("position", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))


def dispatch_pages(affairs: DataFrame) -> DataFrame:
    """(dispatch_date, html): each dispatch as a block of its affairs' tables, the newest opened.

    ``affairs`` has dispatch_date (YYYYMMDD), priority, pos and html.
    """
    newest = affairs.agg(F.max("dispatch_date").alias("dispatch_date")).withColumn("_newest", F.lit(True))
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("priority", "pos", "html"))), lambda x: x["html"]), "")
    blocks = affairs.groupBy("dispatch_date").agg(parts.alias("body")).join(newest, "dispatch_date", "left")
    opened = F.when(F.col("_newest"), "<details open>").otherwise("<details>")
    return blocks.select("dispatch_date", F.concat(opened, F.lit("<summary>Versand vom "), scalar.swiss_date("dispatch_date"), F.lit("</summary>"), F.col("body"), F.lit("</details>")).alias("html"))


def url_order(urls: DataFrame, collections: dict[str, str], loc: str = "loc", in_force: str = "in_force") -> DataFrame:
    """Adds what a sitemap is sorted by: other pages first, then law by law, the version in force last."""
    kind = F.lit(None).cast("string")
    for part, name in collections.items():
        kind = F.when(F.col(loc).contains(part), name).otherwise(kind)
    name = F.replace(F.element_at(F.split(loc, "/"), -1), F.lit(".html"), F.lit(""))
    law, number = F.regexp_extract(name, r"^(.+)-(\d+)$", 1), F.regexp_extract(name, r"^(.+)-(\d+)$", 2)
    out = urls.withColumns({"is_law": kind.isNotNull(), "law_group": F.when(kind.isNotNull(), F.concat(kind, F.lit(":"), law)), "version_number": F.when(kind.isNotNull(), number.try_cast("int"))})
    return out.where("not is_law or version_number is not null").withColumn("current", F.coalesce(F.col("is_law") & F.col(in_force), F.lit(False)))
