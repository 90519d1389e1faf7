"""Hierarchies of categories: flattening, assignment level by level, roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Nested form of a hierarchy file.
SCHEMA = "map<string,struct<name:string,sections:map<string,struct<name:string,subsections:map<string,struct<name:string>>>>>>"


def flatten(df: DataFrame, column: str = "folders") -> DataFrame:
    """(level, code, parent, name) rows of nested maps; blank names are no entries."""
    folders = df.select(F.explode(column).alias("folder", "f"))
    sections = folders.select("folder", F.explode("f.sections").alias("section", "s"))
    parts = sections.select("section", F.explode("s.subsections").alias("part", "p"))
    out = folders.select(F.lit(1).alias("level"), F.col("folder").alias("code"), F.lit(None).cast("string").alias("parent"), F.col("f.name").alias("name"))
    out = out.union(sections.select(F.lit(2), "section", "folder", "s.name")).union(parts.select(F.lit(3), "part", "section", "p.name"))
    return out.where(F.trim("name") != "")


def assign(df: DataFrame, codes: DataFrame, levels: list[Column]) -> DataFrame:
    """Names of up to three levels; the first level that is missing ends the search.

    ``codes`` has (level, code, name); whether to broadcast it is left to its size.
    """
    out = df
    for n, code in enumerate(levels, 1):
        names = codes.where(F.col("level") == n).select(F.col("code").alias(f"_code{n}"), F.col("name").alias(f"name{n}"))
        gate = code if n == 1 else F.when(F.col(f"name{n - 1}").isNotNull(), code)
        out = out.withColumn(f"_want{n}", gate).join(names, F.col(f"_want{n}") == F.col(f"_code{n}"), "left").drop(f"_want{n}", f"_code{n}")
    return out


def rollup_counts(df: DataFrame, levels: list[str], measures: list[Column]) -> DataFrame:
    """Measures of every level and of all, with ``depth`` as the number of levels kept."""
    return df.rollup(*levels).agg(F.grouping_id().alias("_g"), *measures).withColumn("depth", F.lit(len(levels)) - F.bit_count("_g")).drop("_g")


def tree(laws: DataFrame, unknown: str = "Unbekannte Kategorie") -> DataFrame:
    """(position, folder, html) of the category tree, a row for each folder.

    ``laws`` has folder, section and subsection as struct<id, name>, number and title.
    Laws hang from the lowest level they have; ids order as numbers, and laws without a
    folder come last.
    """
    from codexlake.functions.pages import html_escape
    from codexlake.functions.scalar import natural_key

    key = lambda c: F.coalesce(F.col(f"{c}.id").try_cast("double"), F.lit(1e18))
    item = F.concat(F.lit("<li>"), html_escape("number"), F.lit(" "), html_escape("title"), F.lit("</li>"))
    rows = laws.select("folder", "section", "subsection", F.struct(natural_key("number").alias("k"), item.alias("h")).alias("law"))
    inner = lambda c: F.concat(F.lit("<ul>"), F.array_join(F.transform(F.array_sort(c), lambda x: x["h"]), ""), F.lit("</ul>"))
    shown = lambda c, body: F.when(F.col(f"{c}.id").isNull(), body).otherwise(F.concat(F.lit("<details><summary>"), html_escape(F.concat_ws(" ", f"{c}.id", f"{c}.name")), F.lit("</summary>"), body, F.lit("</details>")))
    join = lambda c: F.array_join(F.transform(F.array_sort(c), lambda x: x["h"]), "")
    # Laws without a level stand before the level's parts.
    subs = rows.groupBy("folder", "section", "subsection").agg(inner(F.collect_list("law")).alias("h"))
    subs = subs.select("folder", "section", F.struct(F.when(F.col("subsection.id").isNull(), -1.0).otherwise(key("subsection")).alias("k"), shown("subsection", F.col("h")).alias("h")).alias("x"))
    sections = subs.groupBy("folder", "section").agg(join(F.collect_list("x")).alias("h"))
    sections = sections.select("folder", F.struct(F.when(F.col("section.id").isNull(), -1.0).otherwise(key("section")).alias("k"), shown("section", F.col("h")).alias("h")).alias("x"))
    folders = sections.groupBy("folder").agg(join(F.collect_list("x")).alias("body"))
    name = F.coalesce(F.concat_ws(" ", "folder.id", "folder.name"), F.lit(unknown))
    named = folders.select(key("folder").alias("position"), F.when(F.col("folder.id").isNull(), unknown).otherwise(name).alias("folder"), "body")
    return named.select("position", "folder", F.concat(F.lit("<details><summary>"), html_escape("folder"), F.lit("</summary>"), F.col("body"), F.lit("</details>")).alias("html"))
