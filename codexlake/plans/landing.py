"""Readers and writers on landed files: what a query reads, it has written first, below the warehouse."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexlake.catalog import fixture, query, table, values
from codexlake.operators import versions
from codexlake.session import ship
from codexlake.sources import records, sinks


def landed(spark: SparkSession, *contents: str) -> str:
    """A folder of files with the given contents, in whatever store the warehouse lies."""
    ship(spark)
    path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_codexlake_landed/{uuid.uuid4().hex}"
    spark.createDataFrame([(c.replace("\n", " "),) for c in contents], "value string").repartition(max(1, len(contents))).write.text(path)
    return path


def _version(number: str, **more: object) -> dict:
    names = ("law_page_url", "law_text_url", "law_text_redirect", "erlassdatum", "inkraftsetzungsdatum", "publikationsdatum", "aufhebungsdatum", "bandnummer", "hinweise")
    return dict.fromkeys(names, "") | {"nachtragsnummer": number, "numeric_nachtragsnummer": float(number), "in_force": True} | more


_COLLECTION = [
    {"ordnungsnummer": "131.1", "erlasstitel": "Gemeindegesetz", "kurztitel": "GG", "abkuerzung": "", "dynamic_source": "", "category": {"folder": {"id": "1", "name": "Staat"}, "section": {"id": "13", "name": "Gemeinden"}, "subsection": None}, "versions": [
        _version("66", law_text_url="https://e.org/a.pdf", publikationsdatum="2020-01-31", aufhebungsdatum="20211231", in_force=False), _version("100", law_text_redirect="https://e.org/b.html", law_text_url="https://e.org/c")]},
    {"ordnungsnummer": "0.5", "erlasstitel": "Vertrag", "kurztitel": "", "abkuerzung": "V", "dynamic_source": "", "category": None, "versions": [_version("1")]},
]


def _collection(spark: SparkSession) -> DataFrame:
    return records.read_collection(spark, landed(spark, json.dumps(_COLLECTION), "no json at all"))


@query(values("law::VARCHAR, nachtragsnummer::VARCHAR, number::DOUBLE, repealed::VARCHAR, in_force::BOOLEAN", [("131.1", "66", 66.0, "20211231", False), ("131.1", "100", 100.0, "", True), ("0.5", "1", 1.0, "", True)]))
def collection_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of the laws of collection files; a file that is no JSON is left out."""
    return records.exploded_versions(_collection(spark)).select("law", "nachtragsnummer", F.col("numeric_nachtragsnummer").alias("number"), F.col("aufhebungsdatum").alias("repealed"), "in_force")


@query(values("law::VARCHAR, version::VARCHAR, url::VARCHAR, kind::VARCHAR", [("131.1", "66", "https://e.org/a.pdf", "pdf"), ("131.1", "100", "https://e.org/b.html", "html")]))
def versions_to_download(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The redirect before the text's address; versions without one are not fetched."""
    return records.download_rows(records.exploded_versions(_collection(spark)))


@query(values("ordnungsnummer::VARCHAR, version::VARCHAR", [("131.1", "100"), ("0.5", "1")]))
def versions_not_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of a snapshot without a file in the folders."""
    wanted = records.exploded_versions(_collection(spark)).select(F.col("law").alias("ordnungsnummer"), F.col("nachtragsnummer").alias("version"))
    files = records.law_folders(fixture(spark, [("/data/131.1/20200131/131.1-20200131-metadata.json",), ("/data/x/20200131/y.json",), ("/data/5/2020/z.json",)], "path string"))
    there = files.select(F.col("law").alias("ordnungsnummer"), F.lit("66").alias("version"))
    return versions.missing(wanted, there, ["ordnungsnummer", "version"], ["version"]).select("ordnungsnummer", "version")


@query(values("law::VARCHAR, version::VARCHAR", [("131.1", "20200131"), ("0.5", "20210101")]))
def landed_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = ["/data/131.1/20200131/a.json", "/data/131.1/2020/a.json", "/data/abc/20200131/a.json", "s3://b/c/0.5/20210101/m.json"]
    return records.law_folders(fixture(spark, [(p,) for p in paths], "path string")).select("law", "version")


@query(values("ordnungsnummer::VARCHAR, erlasstitel::VARCHAR, repealed::BOOLEAN", [("101", "Verfassung", False), ("102", "Gesetz", True)]))
def api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a list API; an empty last page adds nothing."""
    page = lambda *rows: json.dumps([dict(zip(("referenceNumber", "enactmentTitle", "link", "enactmentDate", "withdrawalDate"), r, strict=True)) for r in rows])
    out = records.read_api_pages(spark, landed(spark, page(("101", " Verfassung ", "l", "01.01.2000", "-")), page(("102", "Gesetz", "m", "01.01.2001", "31.12.2010")), "[]"))
    return out.select("ordnungsnummer", "erlasstitel", (F.col("withdrawalDate") != "-").alias("repealed"))


@query(values("sr::VARCHAR, title::VARCHAR, ended::VARCHAR", [("101", "Verfassung", ""), ("102", "", "20200101")]))
def sparql_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [{"sr": {"value": " 101 "}, "title": {"value": "Verfassung"}}, {"sr": {"value": "102"}, "ended": {"value": "20200101"}}]
    return records.read_bindings(spark, landed(spark, json.dumps({"results": {"bindings": rows}})), ["sr", "title", "ended"])


_XML = """<Liste><KRVersand><Datum>20240105</Datum><Geschaeft><Titel>Steuern</Titel><Typ>Vorlage</Typ><KRNummer>12/2024</KRNummer><VorlagenNummer>5888</VorlagenNummer><Guid>g1</Guid>
<Schritte><Schritt><Art>Antrag</Art><Datum>02.01.2024</Datum></Schritt><Schritt><Art>Eingang</Art><Datum>15.12.2023</Datum></Schritt><Schritt><Art>offen</Art><Datum></Datum></Schritt></Schritte></Geschaeft>
<Geschaeft><Titel>Wald</Titel><Typ></Typ><KRNummer></KRNummer><VorlagenNummer>77</VorlagenNummer><Guid>g2</Guid></Geschaeft></KRVersand><KRVersand><Datum>20240112</Datum></KRVersand></Liste>"""


@query(values("dispatch_date::VARCHAR, title::VARCHAR, affair_nr::VARCHAR, n_steps::INT, latest::VARCHAR", [("20240105", "Steuern", "12.2024", 2, "20240102 Antrag"), ("20240105", "Wald", "77", 0, "")]))
def dispatch_affairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Affairs of XML dispatches; steps without a day are dropped, the newest comes first."""
    out = records.affair_rows(records.read_dispatches(spark, landed(spark, _XML)))
    return out.select("dispatch_date", "title", "affair_nr", F.size("steps").alias("n_steps"), F.concat_ws(" ", "latest_step.date", "latest_step.type").alias("latest"))


@query(values("pos::INT, text::VARCHAR, page::VARCHAR, table_id::VARCHAR, weight::VARCHAR", [(0, "§ 1.", "0", None, "700.0"), (1, "a", "1", "T1", None), (2, None, None, "T1", None)]))
def layout_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [{"Path": "/D/P", "Text": "§ 1.", "Page": 0, "Font": {"weight": 700}}, {"Path": "/D/T/TR/TD", "Text": "a", "Page": 1, "attributes": {"TableID": "T1"}}, {"attributes": {"TableID": "T1"}}]
    out = records.read_elements(spark, landed(spark, json.dumps({"elements": rows})))
    return out.select("pos", F.col("Text").alias("text"), F.col("Page").cast("string").alias("page"), F.try_element_at("attributes", F.lit("TableID")).alias("table_id"), F.col("Font.weight").cast("string").alias("weight"))


@query(values("id::INT, title::VARCHAR, n_keys::INT, body::VARCHAR", [(1, "Gesetz: neu", 2, "Text"), (2, None, 0, "ohne Kopf"), (3, "zwei", 1, "x---\ny")]))
def front_matter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat front matter; of a key that repeats the last holds, and a file without it is all body."""
    rows = [(1, '---\ntitle: "Gesetz: neu"\nlaw: 131.1\n# note\n---\nText'), (2, "ohne Kopf"), (3, "---\ntitle: eins\ntitle: zwei\n---\nx---\ny")]
    out = records.front_matter(fixture(spark, rows, "id int, t string"), "t")
    return out.select("id", F.try_element_at("metadata", F.lit("title")).alias("title"), F.size("metadata").alias("n_keys"), "body")


@query("""
SELECT 'laws' AS "table", count(*) AS n FROM region UNION ALL SELECT 'versions', count(*) FROM nation UNION ALL SELECT 'provisions', 0
""")
def database_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three tables made, filled, counted and dropped again."""
    name = f"codexlake_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name}")
    try:
        sinks.create_tables(spark, name)
        region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
        region.select(F.col("r_regionkey").cast("string").alias("col_number"), *(F.col("r_name").alias(c) for c in ("number", "title", "short_title", "abbreviation", "collection", "source_url"))).write.insertInto(f"{name}.laws")
        empty = F.lit(None).cast("date")
        nation.select(F.col("n_nationkey").cast("string").alias("a"), F.col("n_regionkey").cast("string").alias("b"), F.col("n_name").alias("c"), F.col("n_nationkey").cast("double").alias("d"), *(empty.alias(c) for c in "efgh"), F.lit(True).alias("i")).write.insertInto(f"{name}.versions")
        rows = [(r["table"], r["n"]) for r in sinks.table_counts(spark, name).collect()]  # three rows
        sinks.drop_tables(spark, name)
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")
    return fixture(spark, rows, "`table` string, n long")


@query("SELECT n_regionkey, count(*) AS n, sum(n_nationkey)::BIGINT AS keys FROM nation GROUP BY n_regionkey")
def json_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations written as JSON by region and read back."""
    path = landed(spark) + "-json"
    sinks.write_json_per_key(table(spark, sf_dir, "nation"), path, "n_regionkey")
    back = spark.read.schema("n_nationkey int, n_name string, n_regionkey int").json(path)
    return back.groupBy("n_regionkey").agg(F.count("*").alias("n"), F.sum("n_nationkey").alias("keys"))


@query("SELECT r_regionkey::VARCHAR AS id, r_name AS name, r_regionkey::VARCHAR || ', 7' AS parts FROM region")
def flat_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested rows flattened for a report, written as CSV with a byte order mark and read back."""
    r = table(spark, sf_dir, "region").select(F.struct(F.col("r_regionkey").alias("id")).alias("law"), F.col("r_name").alias("name"), F.array(F.col("r_regionkey"), F.lit(7)).alias("parts"))
    path = landed(spark) + "-csv"
    sinks.write_csv(sinks.flat_report(r), path)
    back = spark.read.option("header", True).csv(path)
    return back.toDF(*(c.lstrip("﻿") for c in back.columns)).select(F.col("law_id").alias("id"), "name", "parts")
