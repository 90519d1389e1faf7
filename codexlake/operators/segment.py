"""Ordered text: sequences, carried values, provisions, references, anchors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed patterns of provision links and cross-references.
SECTION_LINK = r"\[⟨§\s*(\d+(?:\s*[a-z])*)\s*\.?⟩\]"
ARTICLE_LINK = r"\[⟨Art\.\s*(\d+[a-z]*)⟩\]"
REFERENCES = {
    "article": r"(?U)\b(?:Art\.|Artikel)\s*(\d+(?:[a-zA-Z]+)?)\b",
    "paragraph": r"(?U)\b(?:Abs\.|Absatz)\s*(\d+)\b",
    "letter": r"(?U)\b(?:lit\.|Buchst\.|Bst\.)\s*([a-zA-Z])\b",
    "number": r"(?U)\b(?:Ziff\.|Ziffer)\s*(\d+)\b",
}


def occurrence(df: DataFrame, key: list[str], order: list, name: str = "seq") -> DataFrame:
    """How often the same label came before, from 0."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1)


def carry_forward(df: DataFrame, key: list[str], order: list, value: Column, opens: Column, name: str) -> DataFrame:
    """The value at the last row that opens; null there resets it."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    held = F.last(F.when(opens, F.struct(value.alias("v"))), ignorenulls=True).over(w)
    return df.withColumn(name, held["v"])


def provisions(df: DataFrame, key: list[str], body: str) -> DataFrame:
    """(key, sequence, type, number, text) of the provisions in Markdown bodies.

    A line with a provision link opens a provision, section before article.  A
    heading closes the one before and is dropped; a level-six heading directly
    before a provision (blank lines aside) begins its text instead.  Other lines
    belong to the open provision, or to nothing.
    """
    lines = df.select(*key, F.posexplode(F.split(body, "\n")).alias("pos", "line")).withColumn("_t", F.trim(F.regexp_replace("line", r"\r$", "")))
    section, article = F.regexp_extract("_t", SECTION_LINK, 1), F.regexp_extract("_t", ARTICLE_LINK, 1)
    lines = lines.withColumns({"_n": F.coalesce(F.nullif(section, F.lit("")), F.nullif(article, F.lit(""))), "_kind": F.when(section != "", "section").when(article != "", "article")})
    lines = lines.withColumn("_h", F.when(F.col("_n").isNull(), F.length(F.regexp_extract("_t", r"^(#{1,6})\s", 1))).otherwise(0))
    after = Window.partitionBy(*key).orderBy("pos").rowsBetween(1, Window.unboundedFollowing)
    following = F.first(F.when(F.col("_t") != "", F.struct(F.col("_n").isNotNull().alias("p"))), ignorenulls=True).over(after)
    margin = (F.col("_h") == 6) & F.coalesce(following["p"], F.lit(False))
    lines = lines.withColumn("_margin", margin)
    upto = Window.partitionBy(*key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    # A margin heading opens the segment that its provision then belongs to.
    before = F.last(F.when(F.col("_t") != "", F.struct(F.col("_margin").alias("m"))), ignorenulls=True).over(Window.partitionBy(*key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    opens = F.col("_margin") | ((F.col("_h") > 0) & ~F.col("_margin")) | (F.col("_n").isNotNull() & ~F.coalesce(before["m"], F.lit(False)))
    lines = lines.withColumn("_opens", opens.cast("int")).withColumn("_seg", F.sum("_opens").over(upto))
    parts = lines.where("_seg > 0 and not (_h > 0 and not _margin)").groupBy(*key, "_seg").agg(
        F.array_sort(F.collect_list(F.struct("pos", "line", "_n", "_kind"))).alias("_rows")
    )
    first = F.filter("_rows", lambda r: r["_n"].isNotNull())
    parts = parts.withColumn("_first", F.try_element_at(first, F.lit(1))).where("_first is not null")
    text = F.trim(F.array_join(F.transform("_rows", lambda r: r["line"]), "\n"), F.lit(" \n\t\r"))
    number = F.regexp_replace(F.col("_first._n"), r"\s+", "")
    return parts.select(*key, F.row_number().over(Window.partitionBy(*key).orderBy("_seg")).alias("sequence"), F.col("_first._kind").alias("type"), number.alias("number"), text.alias("text"))


def references(df: DataFrame, key: list[str], text: str, patterns: dict[str, str] | None = None) -> DataFrame:
    """(key, kind, value) of every reference in a text, one row an occurrence."""

    def of(kind: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    found = [of(kind, pattern) for kind, pattern in (patterns or REFERENCES).items()]
    return df.select(*key, F.explode(F.concat(*found)).alias("_r")).select(*key, "_r.kind", "_r.value")


def anchor_map(df: DataFrame, key: str, prov: str, sub: str, sequence: str) -> DataFrame:
    """(key, prov, sub, sequences): occurrences of every provision and part.

    A row with a null ``sub`` stands for the provision itself.  Parts whose
    provision never occurs alone give it 0 sequences.
    """
    n = df.groupBy(key, prov, sub).agg((F.max(sequence) + 1).alias("sequences"))
    orphans = n.select(key, prov).distinct().join(n.where(F.col(sub).isNull()).select(key, prov), [key, prov], "left_anti")
    return n.unionByName(orphans.select(key, prov, F.lit(None).cast(df.schema[sub].dataType).alias(sub), F.lit(0).alias("sequences")))


def unique_target(df: DataFrame, key: list[str], label: str, direct: Column, shared: Column, name: str = "target") -> DataFrame:
    """``direct`` where the label occurs once under the key, else ``shared``."""
    n = F.count("*").over(Window.partitionBy(*key, label))
    return df.withColumn(name, F.when(n == 1, direct).otherwise(shared))


def subprovisions(markers: Column) -> Column:
    """Which markers of an array count: 1, then n+1, or n with the next Latin suffix.

    A fold, since each decision rests on the last accepted marker.
    """
    suffixes = F.array(*(F.lit(s) for s in ("", "bis", "ter", "quater", "quinquies", "sexies", "septies", "octies")))
    start = F.struct(F.lit(0).alias("n"), F.lit(1).cast("int").alias("s"), F.array().cast("array<boolean>").alias("ok"))

    def step(acc: Column, marker: Column) -> Column:
        n = F.regexp_extract(F.lower(marker), r"^(\d+)(?:bis|ter|quater|quinquies|sexies|septies|octies)?$", 1).try_cast("int")
        s = F.array_position(suffixes, F.regexp_extract(F.lower(marker), r"^\d+([a-z]*)$", 1)).cast("int")
        good = F.coalesce((s > 0) & (((n == acc["n"] + 1) & (s == 1)) | ((n == acc["n"]) & (s == acc["s"] + 1))), F.lit(False))
        return F.struct(F.when(good, n).otherwise(acc["n"]).alias("n"), F.when(good, s).otherwise(acc["s"]).alias("s"), F.concat(acc["ok"], F.array(good)).alias("ok"))

    return F.aggregate(markers, start, step, lambda acc: acc["ok"])


def merge_continuations(df: DataFrame, key: list[str], order: str, number: Column, text: str) -> DataFrame:
    """(key, position, number, n_lines, text): rows without a number join the numbered row before them."""
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    grouped = df.withColumn("_n", number).withColumn("_g", F.count("_n").over(w)).where("_g > 0")
    out = grouped.groupBy(*key, "_g").agg(F.max("_n").alias("number"), F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))).alias("_rows"))
    return out.select(*key, F.col("_g").cast("int").alias("position"), "number", F.size("_rows").cast("long").alias("n_lines"), F.array_join(F.transform("_rows", lambda r: r["t"]), " ").alias("text"))
