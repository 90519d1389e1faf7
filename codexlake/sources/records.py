"""Readers of landed files: collections, dispatches, bindings, elements, Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = (
    "struct<law_page_url:string,law_text_url:string,law_text_redirect:string,nachtragsnummer:string,numeric_nachtragsnummer:double,erlassdatum:string,"
    "inkraftsetzungsdatum:string,publikationsdatum:string,aufhebungsdatum:string,in_force:boolean,bandnummer:string,hinweise:string>"
)
_LEVEL = "struct<id:string,name:string>"
COLLECTION = (
    "ordnungsnummer string, erlasstitel string, kurztitel string, abkuerzung string, dynamic_source string, "
    f"category struct<folder:{_LEVEL},section:{_LEVEL},subsection:{_LEVEL}>, versions array<{VERSION}>"
)
ELEMENT = (
    "struct<Path:string,Text:string,Page:int,Bounds:array<double>,CharBounds:array<array<double>>,TextSize:double,"
    "Font:struct<weight:double,family_name:string>,attributes:map<string,string>>"
)


def flatten_columns(df: DataFrame, separator: str = "_", drop_nested: tuple[str, ...] = ("versions",)) -> DataFrame:
    """Struct fields as columns named by their path; nested ``versions`` are dropped.

    A top-level column of that name is kept.
    """

    def fields(schema: T.StructType, path: tuple[str, ...]) -> list[Column]:
        out: list[Column] = []
        for f in schema.fields:
            here = (*path, f.name)
            if path and f.name in drop_nested:
                continue
            if isinstance(f.dataType, T.StructType):
                out += fields(f.dataType, here)
            else:
                out.append(F.col(".".join(f"`{p}`" for p in here)).alias(separator.join(here)))
        return out

    return df.select(*fields(df.schema, ()))


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """A collection file: one JSON array of laws, each with its versions."""
    return spark.read.schema(COLLECTION + ", _corrupt_record string").json(path, multiLine=True, mode="PERMISSIVE").where("_corrupt_record is null").drop("_corrupt_record")


def exploded_versions(laws: DataFrame) -> DataFrame:
    """(law, version) rows with the record's position, which breaks ties."""
    return laws.select(F.col("ordnungsnummer").alias("law"), F.posexplode("versions").alias("pos", "v")).select("law", "pos", "v.*")


def download_rows(versions: DataFrame) -> DataFrame:
    """(law, version, url, kind): the redirect before the text URL; pdf by its name."""
    clean = lambda c: F.nullif(F.trim(c), F.lit(""))
    url = F.coalesce(clean("law_text_redirect"), clean("law_text_url"))
    out = versions.select("law", F.col("nachtragsnummer").alias("version"), url.alias("url")).where("url is not null")
    return out.withColumn("kind", F.when(F.lower("url").contains("pdf"), "pdf").otherwise("html"))


def read_api_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages of a JSON list API, with the engine's names."""
    raw = spark.read.schema("referenceNumber string, enactmentTitle string, link string, enactmentDate string, withdrawalDate string").json(path, multiLine=True)
    return raw.select(F.col("referenceNumber").alias("ordnungsnummer"), F.trim("enactmentTitle").alias("erlasstitel"), "link", "enactmentDate", "withdrawalDate")


def read_bindings(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """A SPARQL JSON result as trimmed text columns; unbound is ''."""
    raw = spark.read.schema("results struct<bindings:array<map<string,struct<value:string>>>>").json(path, multiLine=True)
    rows = raw.select(F.explode("results.bindings").alias("b"))
    return rows.select(*(F.coalesce(F.trim(F.try_element_at("b", F.lit(n))["value"]), F.lit("")).alias(n) for n in names))


def current_laws(triples: DataFrame, number: str, start: str, end: str, url: str, today: Column) -> DataFrame:
    """Laws in force on a day, from (s, p, o) triples: three equi-joins, one optional."""
    of = lambda p, name: triples.where(F.col("p") == p).select("s", F.col("o").alias(name))
    rows = of(number, "number").join(of(start, "start"), "s").join(of(url, "url"), "s").join(of(end, "end"), "s", "left")
    return rows.where((F.col("start") <= today) & (F.col("end").isNull() | (F.col("end") >= today))).select("number", "start", "url").distinct()


def read_dispatches(spark: SparkSession, path: str) -> DataFrame:
    """A parliament's XML dispatches: (date, affairs) with one row a dispatch."""
    affair = "struct<Titel:string,Typ:string,KRNummer:string,VorlagenNummer:string,Guid:string,Schritte:struct<Schritt:array<struct<Art:string,Datum:string>>>>"
    raw = spark.read.format("xml").option("rowTag", "KRVersand").schema(f"Datum string, Geschaeft array<{affair}>").load(path)
    return raw.where("Geschaeft is not null")


def affair_rows(dispatches: DataFrame) -> DataFrame:
    """One row an affair; its steps newest first, those without a day dropped."""
    from codexlake.functions.scalar import from_swiss_date

    one = dispatches.select(F.col("Datum").alias("dispatch_date"), F.posexplode("Geschaeft").alias("pos", "g"))
    steps = F.filter(F.transform(F.coalesce(F.col("g.Schritte.Schritt"), F.array()), lambda s: F.struct(from_swiss_date(s["Datum"]).alias("date"), s["Art"].alias("type"))), lambda s: s["date"] != "")
    number = F.replace(F.coalesce(F.nullif(F.trim("g.KRNummer"), F.lit("")), F.col("g.VorlagenNummer")), F.lit("/"), F.lit("."))
    out = one.select("dispatch_date", "pos", F.col("g.Titel").alias("title"), F.col("g.Typ").alias("affair_type"), F.col("g.Guid").alias("guid"), number.alias("affair_nr"), F.sort_array(steps, asc=False).alias("steps"))
    return out.withColumn("latest_step", F.try_element_at("steps", F.lit(1)))


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """Layout elements of landed files, numbered in file order."""
    raw = spark.read.schema(f"elements array<{ELEMENT}>").json(path, multiLine=True)
    named = raw.withColumn("file", F.input_file_name())
    return named.select("file", F.posexplode("elements").alias("pos", "e")).select("file", "pos", "e.*")


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """(name, size, metadata, body) of Markdown files with a front matter block.

    Bytes that are no UTF-8 are read as Latin-1.  Front matter is read as flat
    ``key: value`` lines; a file without it has empty metadata.
    """
    raw = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("size"), "content")
    text = F.coalesce(F.try_validate_utf8(F.col("content").cast("string")), F.decode("content", "ISO-8859-1"))
    return front_matter(raw.withColumn("_text", text), "_text").drop("content", "_text")


def front_matter(df: DataFrame, text: str) -> DataFrame:
    """Adds ``metadata`` (map) and ``body``."""
    parts = F.split(F.col(text), r"---\r?\n", 3)
    has = F.col(text).startswith("---") & (F.size(parts) == 3)
    lines = F.filter(F.split(parts[1], r"\r?\n"), lambda x: x.rlike(r"^[^\s#:][^:]*:"))
    pair = lambda x: F.struct(F.trim(F.regexp_extract(x, r"^([^:]+):", 1)).alias("k"), F.regexp_replace(F.trim(F.regexp_extract(x, r"^[^:]+:(.*)$", 1)), r"^[\"'](.*)[\"']$", "$1").alias("v"))
    entries = F.transform(lines, pair)
    # Of a key that repeats, the last value holds.
    kept = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda o: o["k"] == e["k"]))
    return df.withColumn("metadata", F.when(has, F.map_from_entries(kept)).otherwise(F.map_from_entries(F.array().cast("array<struct<k:string,v:string>>")))).withColumn("body", F.when(has, parts[2]).otherwise(F.col(text)))


def law_folders(files: DataFrame, column: str = "path") -> DataFrame:
    """(law, version, path) of files laid out as law/YYYYMMDD/name."""
    pattern = r"/([0-9.]+)/(\d{8})/[^/]+$"
    return files.select(F.regexp_extract(column, pattern, 1).alias("law"), F.regexp_extract(column, pattern, 2).alias("version"), F.col(column).alias("path")).where("law <> ''")
