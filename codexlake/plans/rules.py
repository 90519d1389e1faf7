"""Rules of names, texts, references and reviews on rows written out, and over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexlake.catalog import fixture, query, table, values
from codexlake.functions import pages, scalar
from codexlake.operators import crossref, hierarchy, layout, segment, versions
from codexlake.sources import sinks

# --- references and changes -----------------------------------------------------------
_REFERENCE_TEXTS = [(1, "Abs. 2bis lit. abc fooAbs. 7"), (2, "Art. 5 Abs. 2 lit. a und Artikel 12bis, Ziff. 3"), (3, "nach Absatz 4, Bst. c, Buchst. D; Ziffer 9"), (4, "Art.7x Kart. 8 Art. 9ter."), (5, "")]


@query(r"""
WITH t(id, body) AS (VALUES (1, 'Abs. 2bis lit. abc fooAbs. 7'), (2, 'Art. 5 Abs. 2 lit. a und Artikel 12bis, Ziff. 3'), (3, 'nach Absatz 4, Bst. c, Buchst. D; Ziffer 9'), (4, 'Art.7x Kart. 8 Art. 9ter.'), (5, '')),
k(kind, p) AS (VALUES ('article', '\b(?:Art\.|Artikel)\s*(\d+(?:[a-zA-Z]+)?)\b'), ('paragraph', '\b(?:Abs\.|Absatz)\s*(\d+)\b'), ('letter', '\b(?:lit\.|Buchst\.|Bst\.)\s*([a-zA-Z])\b'), ('number', '\b(?:Ziff\.|Ziffer)\s*(\d+)\b'))
SELECT id::INT AS id, kind, unnest(regexp_extract_all(body, p, 1)) AS value FROM t, k
""")
def reference_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.references(fixture(spark, _REFERENCE_TEXTS, "id int, body string"), ["id"], "body")


_ANCHORS = [(1, 1, "seq-0-prov-5"), (1, 2, "seq-0-prov-5-sub-1"), (1, 3, "seq-0-prov-5-sub-2a"), (1, 4, "seq-0-prov-6"), (1, 5, "seq-0-prov-6-sub-2"), (1, 6, "seq-1-prov-6-sub-12"), (1, 7, "seq-0-prov-6-sub-b"), (2, 1, "seq-0-prov-5a")]
_ASKED = [(1, 1, "article", "5", None), (2, 1, "article", "9", None), (3, 1, "paragraph", "2", "seq-0-prov-6"), (4, 1, "paragraph", "2", None), (5, 1, "letter", "A", "seq-0-prov-5"), (6, 1, "letter", "b", "seq-0-prov-5"), (7, 1, "number", "1", "seq-0-prov-6"), (8, 2, "article", "5", None), (9, 2, "article", "5a", None), (10, 1, "letter", "z", "x")]


@query(f"""
WITH a(doc, pos, id) AS (VALUES {", ".join(f"({d}, {p}, '{i}')" for d, p, i in _ANCHORS)}),
r(ref, doc, kind, value, context) AS (VALUES {", ".join(f"({n}, {d}, '{k}', '{v}', {'NULL' if c is None else repr(c)})" for n, d, k, v, c in _ASKED)}),
p AS (SELECT *, regexp_extract(context, 'prov-([0-9]+\\w*)', 1) AS prov FROM r),
near AS (SELECT ref, arg_min(id, pos) AS id FROM p JOIN a USING (doc) WHERE kind <> 'article' AND prov <> '' AND regexp_matches(id, '^seq-[0-9]+-prov-' || prov || '-sub-' || CASE kind WHEN 'letter' THEN '[0-9]*' || lower(value) ELSE value END) GROUP BY ref),
far AS (SELECT ref, arg_min(id, pos) AS id FROM p JOIN a USING (doc) WHERE CASE kind WHEN 'article' THEN regexp_full_match(id, 'seq-[0-9]+-prov-' || value) WHEN 'letter' THEN regexp_matches(id, 'sub-[0-9]*' || lower(value) || '$') ELSE regexp_matches(id, 'sub-' || value || '\\w*$') END GROUP BY ref)
SELECT ref::INT AS ref, coalesce(near.id, far.id) AS target, CASE WHEN coalesce(near.id, far.id) IS NULL THEN value ELSE '<a href="#' || coalesce(near.id, far.id) || '" class="cross-reference">' || value || '</a>' END AS html
FROM r LEFT JOIN near USING (ref) LEFT JOIN far USING (ref)
""")
def reference_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    anchors = fixture(spark, _ANCHORS, "doc int, pos int, id string")
    refs = fixture(spark, _ASKED, "ref int, doc int, kind string, value string, context string")
    out = crossref.reference_targets(refs, anchors, "doc")
    return out.select("ref", "target", crossref.anchor_link(F.col("value"), F.col("target")).alias("html"))


_DISPATCH = [
    "Antrag", "§ 1. vor jedem Gesetz", "Das  Steuergesetz vom 8. Juni 1997 wird wie folgt geändert:", "§ 5. Abs. 1 neu", "Titel", "§ 7 a. x", "§ 5.  Abs. 2", "ersatz von Bezeichnungen in § 9", "§ 6 lit. a. gilt. so",
    "Das Gemeindegesetz vom 20. April 2015:", "§ 2. y", "Die Gesetzesänderung vom 1. Mai 2020:", "§ 3. weg", " Bericht ", "§ 9. danach",
]


@query(values("doc::INT, law::VARCHAR, norms::VARCHAR", [(1, "Steuergesetz vom 8. Juni 1997", "§ 5.|§ 7 a.|ersatz von Bezeichnungen|§ 6 lit. a."), (1, "Gemeindegesetz vom 20. April 2015", "§ 2."), (2, "Steuergesetz vom 8. Juni 1997", "§ 5.")]))
def dispatch_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A law that is named again starts anew; nothing counts from the report on."""
    again = ["Steuergesetz vom 8. Juni 1997:", "§ 4. x", "Steuergesetz vom 8. Juni 1997:", "§ 5. y"]
    rows = [(1, n, t) for n, t in enumerate(_DISPATCH)] + [(2, n, t) for n, t in enumerate(again)]
    out = crossref.law_changes(fixture(spark, rows, "doc int, pos int, text string"), ["doc"], "pos", "text")
    return out.select("doc", "law", F.array_join("norms", "|").alias("norms"))


# --- layout ------------------------------------------------------------------------------
@query(values("text::VARCHAR, line::INT", [("a", 1), ("b", 1), ("c", 2), ("d", 3), ("e", 4)]))
def lines_of_a_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Middles 0, 4 and 8 are two lines: a line's middle counts, not its range."""
    rows = [(1, 0, n, 0.0, y - 5, 10.0, y + 5, t, 840.0) for n, (t, y) in enumerate([("a", 0.0), ("b", 4.0), ("c", 8.0), ("d", 100.0), ("e", 110.0)])]
    return layout.sort_lines(fixture(spark, rows, "doc int, page int, pos int, x0 double, y0 double, x1 double, y1 double, text string, height double"), "doc", "height").select("text", "line")


_INLINE = [
    (1, "Es gilt: a. eins, b. zwei; 3) drei"), (2, "nach Abs. 2 (vgl. a. oben) gilt"), (3, "gemäss § 54 b. und mehr"), (4, "Herr A. Meier"), (5, "Teil II) dann mehr"), (6, "ca a. zehn"), (7, "ohne"), (8, "wenn i. er kommt"),
]


@query(values("id::INT, parts::VARCHAR", [(1, "Es gilt:|a.|eins, b. zwei; 3) drei"), (2, "nach Abs. 2 (vgl. a. oben) gilt"), (3, "gemäss § 54 b. und mehr"), (4, "Herr A. Meier"), (5, "Teil|II)|dann mehr"), (6, "ca a. zehn"), (7, "ohne"), (8, "wenn|i.|er kommt")]))
def inline_enumerators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, _INLINE, "id int, text string").select("id", F.array_join(layout.split_enumerators("text"), "|").alias("parts"))


@query(r"""
WITH t(id, body) AS (VALUES (1, '§ 12a. Wer darf'), (2, '§ 3.'), (3, 'kein'), (4, ' § 5. x '))
SELECT id::INT AS id, CASE WHEN NOT regexp_matches(trim(body), '^§ \d+[a-zA-Z]?\.') THEN body ELSE rtrim(regexp_extract(trim(body), '^(§ \d+[a-zA-Z]?\.)', 1) || '|' || trim(regexp_replace(trim(body), '^§ \d+[a-zA-Z]?\.', '')), '|') END AS parts FROM t
""")
def provision_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(1, "§ 12a. Wer darf"), (2, "§ 3."), (3, "kein"), (4, " § 5. x ")]
    return fixture(spark, rows, "id int, text string").select("id", F.array_join(layout.split_provision("text"), "|").alias("parts"))


@query(values("id::INT, parts::VARCHAR", [(1, "Ort|a. eins|2) zwei"), (2, "a. eins|b. zwei"), (3, "ohne")]))
def note_enumerators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, [(1, "Ort a. eins 2) zwei"), (2, "a. eins b. zwei"), (3, "ohne")], "id int, text string").select("id", F.array_join(layout.split_notes("text"), "|").alias("parts"))


@query("""
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 3, event_id * 37 % 842, event_id)::INT AS place, min(event_id) OVER (PARTITION BY user_id, event_type) AS first_of_table,
  800 + event_id % 3 AS height FROM events
""")
def paragraph_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements by page and top, with the page's height and the first element of their table."""
    heights = fixture(spark, [(0, 800), (1, 801), (2, 802)], "page int, height int")
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", (F.col("event_id") % 3).cast("int").alias("page"), F.pmod(F.col("event_id") * 37, F.lit(842)).alias("top"))
    placed = sinks.numbered(e.join(heights, "page"), ["user_id"], [F.col("page"), F.col("top"), F.col("event_id")])
    firsts = e.groupBy("user_id", "event_type").agg(F.min("event_id").alias("first_of_table"))
    return placed.join(firsts, ["user_id", "event_type"]).select("user_id", "event_id", F.col("position").alias("place"), "first_of_table", F.col("height").cast("long").alias("height"))


@query("""
SELECT event_type, list_sort(list(DISTINCT (event_id % 3)::INT))::VARCHAR AS pages, count(*) AS n FROM events GROUP BY event_type
""")
def pages_of_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy("event_type").agg(F.array_sort(F.collect_set((F.col("event_id") % 3).cast("int"))).alias("p"), F.count("*").alias("n"))
    return e.select("event_type", F.col("p").cast("string").alias("pages"), "n")


_BOXES = [(1, [[1.0, 2.0, 3.0, 4.0], [5.0, 6.0, 7.0, 8.0]], [9.0, 9.0, 9.0, 9.0], " 3.5 "), (2, [], [1.0, 2.0, 3.0, 4.0], ""), (3, None, None, "x")]


@query(values("id::INT, edges::VARCHAR, number::VARCHAR, n_digits::INT", [(1, "1.0 2.0 7.0 8.0", "3.5", 20), (2, "1.0 2.0 3.0 4.0", "0.0", 20), (3, "0.0 0.0 0.0 0.0", None, 20)]))
def element_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges from characters or boxes, position attributes, and ids of twenty digits."""
    rows = fixture(spark, _BOXES, "id int, chars array<array<double>>, box array<double>, raw string").withColumn("e", pages.box_edges("chars", "box"))
    edges = F.concat_ws(" ", *(F.col(f"e.{n}").cast("string") for n in ("left", "top", "right", "bottom")))
    return rows.select("id", edges.alias("edges"), pages.number_or_zero("raw").cast("string").alias("number"), F.length(F.regexp_extract(pages.element_id("id", "raw"), r"^(\d{20})$", 1)).alias("n_digits"))


# --- names and pages ---------------------------------------------------------------------
@query("""
WITH f AS (SELECT o_orderkey, (o_custkey % 97)::VARCHAR || '.' || (o_custkey % 7)::VARCHAR || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '-' || lpad((o_orderkey % 120)::VARCHAR, 3, '0') END || '.html' AS name FROM orders)
SELECT o_orderkey, nullif(regexp_extract(replace(name, '.html', ''), '^(.+)-([0-9]+)', 1), '') AS stem, try_cast(nullif(regexp_extract(replace(name, '.html', ''), '^(.+)-([0-9]+)', 2), '') AS INT)::VARCHAR AS number FROM f
""")
def numbered_page_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    tail = F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.concat(F.lit("-"), F.lpad((F.col("o_orderkey") % 120).cast("string"), 3, "0")))
    name = F.concat((F.col("o_custkey") % 97).cast("string"), F.lit("."), (F.col("o_custkey") % 7).cast("string"), tail, F.lit(".html"))
    return o.select("o_orderkey", pages.numbered_name(name).alias("p")).select("o_orderkey", "p.stem", F.col("p.number").cast("string").alias("number"))


@query("""
SELECT doc_id, substr(md5(text), 1, 8) AS hash, 'css/' || source || '.min.v' || substr(md5(text), 1, 8) || '.css' AS name, n_chars - length(trim(text)) AS saved,
  coalesce(round((n_chars - length(trim(text))) * 100.0 / nullif(n_chars, 0), 2), 0.0)::DOUBLE AS percent FROM documents
""")
def versioned_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash, versioned name and what trimming saves, each document as a style sheet."""
    d = table(spark, sf_dir, "documents")
    digest = pages.content_hash("text")
    saving = pages.size_saving("n_chars", F.length(F.trim("text")).cast("long"))
    return d.select("doc_id", digest.alias("hash"), pages.versioned_name(F.concat(F.lit("css/"), F.col("source"), F.lit(".min.css")), digest).alias("name"), saving["saved"].alias("saved"), saving["percent"].alias("percent"))


_SHEETS = [(1, "@import url('./a.css');\n@import \"b/c.css\";\nbody{}"), (2, "@import 'x.css';"), (3, "p{}")]


@query(values("id::INT, content::VARCHAR, missing::VARCHAR", [(1, "@import url('a.v1.css');\n@import 'b/c.v2.css';\nbody{}", ""), (2, "@import 'x.css';", "x.css"), (3, "p{}", "")]))
def style_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.create_map(F.lit("a.css"), F.lit("a.v1.css"), F.lit("b/c.css"), F.lit("b/c.v2.css"))
    out = fixture(spark, _SHEETS, "id int, sheet string").select("id", pages.rewrite_imports("sheet", names).alias("r"))
    return out.select("id", "r.content", F.array_join("r.missing", ",").alias("missing"))


_AFFAIRS = [
    (1, "20240105", 2, 'Gesetz & "Co"', "Vorlage", "5888", None, [("20240102", "Antrag")], {"Steuergesetz": ["§ 5.", "§ 7 a."]}, "https://e.org/a.pdf", None),
    (2, "20240105", 1, "Kurz", " ", "", "12/2024", [], None, None, "https://e.org/?a=1&b=2"), (3, "20231201", 3, "Alt", None, None, None, None, None, None, None),
]
_TABLE = "<table border='1' cellpadding='5' style='border-collapse: collapse;'>"
_HTML = {
    1: f"<h3>Gesetz &amp; &quot;Co&quot;</h3>{_TABLE}<tr><td>Geschäftsart:</td><td>Vorlage</td></tr><tr><td>Vorlagen-Nr:</td><td>5888</td></tr><tr><td>Ablaufschritte:</td><td>02.01.2024: Antrag</td></tr><tr><td>Änderungen (KI):</td><td>Steuergesetz: 5, 7 a</td></tr><tr><td>Hyperlinks:</td><td><a href='https://e.org/a.pdf'>PDF</a></td></tr></table>",
    2: f"<h3>Kurz</h3>{_TABLE}<tr><td>KR-Nr:</td><td>12/2024</td></tr><tr><td>Hyperlinks:</td><td><a href='https://e.org/?a=1&amp;b=2'>Geschäft</a></td></tr></table>",
    3: f"<h3>Alt</h3>{_TABLE}</table>",
}


def _affairs(spark: SparkSession) -> DataFrame:
    rows = fixture(spark, _AFFAIRS, "id int, dispatch_date string, pos int, title string, kind string, number string, affair string, steps array<struct<date:string,type:string>>, changes map<string,array<string>>, pdf string, page string")
    return rows.withColumn("html", pages.affair_table("title", "kind", "number", "affair", "steps", "changes", "pdf", "page"))


@query(values("id::INT, html::VARCHAR", list(_HTML.items())))
def affair_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _affairs(spark).select("id", "html")


@query(values("dispatch_date::VARCHAR, html::VARCHAR", [("20240105", f"<details open><summary>Versand vom 05.01.2024</summary>{_HTML[1]}{_HTML[2]}</details>"), ("20231201", f"<details><summary>Versand vom 01.12.2023</summary>{_HTML[3]}</details>")]))
def dispatch_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Affairs by priority under their dispatch; the newest dispatch is open."""
    return sinks.dispatch_pages(_affairs(spark).withColumn("priority", scalar.affair_priority("kind")))


_LINKS = '<div class="link-group"><div class="link-title">{}</div><div class="link-url-container"><div class="link-url">{}</div></div></div>'
_HEAD, _FOOT = '<div class="links-container"><div class="links-inner">', "</div></div>"


@query(values("id::INT, html::VARCHAR", [
    (1, _HEAD + '<div class="link-group"><div class="link-title">Gesetz &lt;x&gt;</div></div><hr class="links-separator">' + _LINKS.format("Zu dieser Version:", "https://e.org/1-2.html") + _LINKS.format("Zur jeweils neusten Version:", "https://e.org/1/latest") + _LINKS.format("Quelle:", "https://s.org/1") + _FOOT),
    (2, _HEAD + _LINKS.format("Zu dieser Version:", "https://e.org/3-4.html") + _LINKS.format("Zur jeweils neusten Version:", "https://e.org/3/latest") + _FOOT)]))
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(1, "Gesetz <x>", "/1-2.html", "/1/latest", "https://s.org/1"), (2, "", "/3-4.html", "/3/latest", None)]
    return fixture(spark, rows, "id int, title string, fixed string, moving string, source string").select("id", pages.links_block("https://e.org", "title", "fixed", "moving", "source").alias("html"))


@query(values("id::INT, is_abbreviation::BOOLEAN, language::VARCHAR, description::VARCHAR, folder::VARCHAR, link::VARCHAR", [
    (1, True, "de-CH", "Start", "federal", "SR 101"), (2, False, "de-CH", "Titel", "cantonal", None), (3, False, "de-CH", "", "cantonal", "OS 54, 752")]))
def page_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Abbreviation stated, description, folder of a path, and a link's text."""
    div = '<div>Abkürzung:</div><div class="x" data-pagefind-weight="10"> StG </div>'
    rows = [(1, div, "stg", "index.html", "Egal", "/data/federal/101/x.html", "(SR 101);\nmehr"), (2, div, "st", "law.html", "Titel", "/data/other/x.html", "keine Zahl"), (3, "nichts", "stg", "a.html", None, "", "OS 54, 752.")]
    f = fixture(spark, rows, "id int, content string, term string, file string, title string, path string, link string")
    meta = pages.page_meta("file", "title", {"index.html": "Start"})
    return f.select("id", pages.is_abbreviation("content", "term").alias("is_abbreviation"), meta["language"].alias("language"), meta["description"].alias("description"), pages.first_containing("path", [("/federal/", "federal")], "cantonal").alias("folder"), pages.link_text("link").alias("link"))


@query(values("id::INT, is_number::BOOLEAN, is_folder::BOOLEAN, is_repealed::BOOLEAN, is_international::BOOLEAN, url::VARCHAR, pdf::VARCHAR, meta::VARCHAR, raw::VARCHAR", [
    (1, True, True, True, False, "https://a", "/d/1-2-original.pdf", "/d/1-2-metadata.json", "/base/101.1/20240101/101.1-20240101-raw.html"),
    (2, False, False, False, False, "https://b", "/d/x-original.pdf", "/d/x-metadata.json", "/base/13x/2024/13x-2024-raw.html"),
    (3, True, False, False, True, "", None, None, None)]))
def path_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, folders, repeals, source links and the paths of a version's files."""
    rows = [(1, "101.1", "20240101", "20250101", " https://a ", "https://b", "/d/1-2-modified.json"), (2, "13x", "2024", " ", "", "https://b", "/d/x-modified.json"), (3, "0.101", None, None, None, None, None)]
    f = fixture(spark, rows, "id int, law string, date string, repealed string, page string, text string, path string")
    paths = pages.sibling_paths("path", "-modified.json", {"pdf": "-original.pdf", "meta": "-metadata.json"})
    return f.select("id", pages.is_number("law").alias("is_number"), pages.is_date_folder("date").alias("is_folder"), pages.is_repealed("repealed").alias("is_repealed"), pages.is_international("law").alias("is_international"), pages.source_url("page", "text").alias("url"), paths["pdf"].alias("pdf"), paths["meta"].alias("meta"), pages.law_path("/base/", "law", "date", "raw").alias("raw"))


_TITLES = [(1, "Steuergesetz (StG)"), (2, "Verordnung (Steuerverordnung, StV)"), (3, "Vertrag (Spitalkonzession)"), (4, "Beschluss (Statut)"), (5, "x (weisung)"), (6, "ohne"), (7, "Abkommen (Doppelbesteuerungsabkommen)")]


@query(r"""
WITH t(id, title) AS (VALUES (1, 'Steuergesetz (StG)'), (2, 'Verordnung (Steuerverordnung, StV)'), (3, 'Vertrag (Spitalkonzession)'), (4, 'Beschluss (Statut)'), (5, 'x (weisung)'), (6, 'ohne'), (7, 'Abkommen (Doppelbesteuerungsabkommen)')),
b AS (SELECT id, regexp_extract(title, '\(([^)]*)\)', 1) AS inner_ FROM t),
s AS (SELECT id, inner_, contains(inner_, ',') AS two, regexp_matches(lower(inner_), 'verordnung|gesetz|reglement|konkordat|abkommen|vereinbarung|vertrag|weisung|konzession|ordnung') AS act FROM b),
r AS (SELECT id, CASE WHEN two THEN trim(split_part(inner_, ',', 1)) WHEN act THEN inner_ ELSE '' END AS short, CASE WHEN two THEN trim(split_part(inner_, ',', 2)) WHEN NOT act THEN inner_ ELSE '' END AS abbreviation FROM s)
SELECT id::INT AS id, CASE WHEN short <> lower(short) THEN short ELSE '' END AS short, abbreviation FROM r
""")
def short_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, _TITLES, "id int, title string").select("id", scalar.short_title("title").alias("t")).select("id", "t.short", "t.abbreviation")


_NUMBERS = [(1, "101"), (2, "13x"), (3, "1"), (4, "131.1"), (5, "0.101.2"), (6, "0.1"), (7, " 13 "), (8, ""), (9, "0.x"), (10, ".5")]


@query(r"""
WITH t(id, n) AS (VALUES (1, '101'), (2, '13x'), (3, '1'), (4, '131.1'), (5, '0.101.2'), (6, '0.1'), (7, ' 13 '), (8, ''), (9, '0.x'), (10, '.5')),
g AS (SELECT id, CASE WHEN regexp_full_match(trim(n), '[0-9.]+') THEN CASE WHEN starts_with(trim(n), '0.') THEN '0.' ELSE '' END END AS branch, regexp_extract(regexp_replace(trim(n), '^0\.', ''), '^([0-9]+)', 1) AS d FROM t)
SELECT id::INT AS id, CASE WHEN length(d) >= 1 THEN branch || substr(d, 1, 1) END AS folder, CASE WHEN length(d) >= 2 THEN branch || substr(d, 1, 2) END AS section, CASE WHEN length(d) >= 3 THEN branch || substr(d, 1, 3) END AS subsection FROM g
""")
def number_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, _NUMBERS, "id int, n string").select("id", scalar.category_codes("n").alias("c")).select("id", "c.folder", "c.section", "c.subsection")


@query(values("id::INT, a::VARCHAR, b::VARCHAR, c::VARCHAR", [(1, "", "x", "|y"), (2, None, "", "-a|")]))
def dashes_to_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of one dash, at any depth."""
    rows = fixture(spark, [(1, "-", ("x", [("-",), ("y",)])), (2, None, ("-", [("-a",), ("-",)]))], "id int, a string, s struct<b:string,c:array<struct<d:string>>>")
    out = rows.select("id", *(pages.without_dashes(rows.schema[c].dataType, F.col(c)).alias(c) for c in ("a", "s")))
    return out.select("id", "a", "s.b", F.array_join(F.transform("s.c", lambda x: x["d"]), "|").alias("c"))


@query(values("loc::VARCHAR, is_law::BOOLEAN, law_group::VARCHAR, version_number::VARCHAR, current::BOOLEAN", [
    ("https://e.org/about.html", False, None, None, False), ("https://e.org/col-a/131.1-066.html", True, "a:131.1", "66", True), ("https://e.org/col-b/0.1-2.html", True, "b:0.1", "2", False)]))
def sitemap_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a sitemap is sorted by; pages of laws without a number are no entries."""
    rows = [("https://e.org/about.html", None), ("https://e.org/col-a/131.1-066.html", True), ("https://e.org/col-b/0.1-2.html", False), ("https://e.org/col-b/index.html", True)]
    return sinks.url_order(fixture(spark, rows, "loc string, in_force boolean"), {"/col-a/": "a", "/col-b/": "b"}).drop("in_force").withColumn("version_number", F.col("version_number").cast("string"))


_LAWS = [("1", "Staat", "10", "Verfassung", None, None, "101", "A"), ("1", "Staat", "10", "Verfassung", "101", "Rechte", "101.2", "B"), ("1", "Staat", None, None, None, None, "100", "C"), (None, None, None, None, None, None, "999", "D"), ("2", "Zivil", "21", "Person", None, None, "210", "E & F")]


@query(values("position::DOUBLE, folder::VARCHAR, html::VARCHAR", [
    (1.0, "1 Staat", "<details><summary>1 Staat</summary><ul><li>100 C</li></ul><details><summary>10 Verfassung</summary><ul><li>101 A</li></ul><details><summary>101 Rechte</summary><ul><li>101.2 B</li></ul></details></details></details>"),
    (2.0, "2 Zivil", "<details><summary>2 Zivil</summary><details><summary>21 Person</summary><ul><li>210 E &amp; F</li></ul></details></details>"),
    (1e18, "Unbekannte Kategorie", "<details><summary>Unbekannte Kategorie</summary><ul><li>999 D</li></ul></details>")]))
def category_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture(spark, _LAWS, "fi string, fn string, si string, sn string, ui string, un string, number string, title string")
    level = lambda i, n: F.struct(F.col(i).alias("id"), F.col(n).alias("name"))
    return hierarchy.tree(rows.select(level("fi", "fn").alias("folder"), level("si", "sn").alias("section"), level("ui", "un").alias("subsection"), "number", "title"))


@query(values("id::INT, is_metadata::BOOLEAN", [(1, True), (2, False), (3, False), (4, False)]))
def metadata_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(1, '{"doc_info":{"a":1},"process_steps":{}}'), (2, '{"doc_info":[1],"process_steps":{}}'), (3, '{"doc_info":{}}'), (4, "no json")]
    return fixture(spark, rows, "id int, body string").select("id", pages.is_metadata("body").alias("is_metadata"))


def _row(label: str, value: str, more: str = "", kind: str = "row") -> str:
    return f'<div class="metadata-item metadata-item-{kind}"><div class="metadata-label">{label}:</div><div class="metadata-value"{more}>{value}</div></div>'


_PANEL = (
    '<details id="doc-info"><summary>Basisinformationen</summary><div class="metadata-content">' + _row("Erlasstitel", "Gesetz &amp; Co", ' data-pagefind-weight="10"', "full") + _row("Kurztitel", "N/A") + _row("Abkürzung", "G", ' data-pagefind-weight="10"')
    + _row("Ordnungsnummer", "131.1", ' data-pagefind-meta="Ordnungsnummer"') + _row("Nachtragsnummer", "066", ' data-pagefind-meta="Nachtragsnummer"') + _row("Erlassdatum", "01.02.2020") + _row("Inkraftsetzungsdatum", "N/A")
    + _row("Publikationsdatum", "N/A") + _row("Aufhebungsdatum", "N/A") + _row("Gesetzessammlung", "Kanton", ' data-pagefind-meta="Gesetzessammlung" data-pagefind-filter="Gesetzessammlung"') + "</div></details>"
)


@query(values("status::VARCHAR, facet::VARCHAR, html::VARCHAR", [("Text in Kraft (131.1-066)", "Text in Kraft:Ja", _PANEL)]))
def metadata_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {"erlasstitel": "Gesetz & Co", "kurztitel": "", "abkuerzung": "G", "ordnungsnummer": "131.1", "nachtragsnummer": "066", "erlassdatum": "20200201", "inkraftsetzungsdatum": "", "publikationsdatum": None, "aufhebungsdatum": "x"}
    rows = fixture(spark, [(tuple(fields.values()), True, "Kanton")], f"info struct<{','.join(f'{k}:string' for k in fields)}>, in_force boolean, collection string")
    return rows.select(pages.panel("info", "in_force", "collection").alias("p")).select("p.*")


@query("""
WITH v AS (SELECT o_custkey, o_orderkey, o_orderpriority, max_by(o_orderkey, (o_orderdate, o_orderkey)) OVER (PARTITION BY o_custkey) AS newest FROM orders)
SELECT o_orderkey, 'https://e.org/col-a/' || o_custkey || '-' || newest || '.html' AS canonical,
  '<html><head><link rel="canonical" href="https://e.org/col-a/' || o_custkey || '-' || newest || '.html"></head><body><div id="law" data-ordnungsnummer="' || o_custkey || '" data-nachtragsnummer="' || o_orderkey || '" data-title="' || o_orderpriority || '"'
  || CASE WHEN newest = o_orderkey THEN ' data-pagefind-body' ELSE '' END || '><p>x</p></div></body></html>' AS html FROM v
""")
def law_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each version's page: the newest is canonical, and it alone is indexed."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    newest = versions.latest(o, "o_custkey", [F.col("o_orderdate"), F.col("o_orderkey")], ["o_orderkey"]).select("o_custkey", F.col("o_orderkey").cast("string").alias("newest"))
    page = pages.law_container("https://e.org", F.lit("a"), F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string"), "newest", "o_orderpriority", F.lit("<p>x</p>"))
    return o.join(newest, "o_custkey").select("o_orderkey", page.alias("p")).select("o_orderkey", "p.canonical", "p.html")


@query(values("id::INT, html::VARCHAR", [
    (1, '<html><head></head><body><div id="law"><div id="source-text" class="html-source"><h1>Gesetz</h1><p>a b c</p></div></div></body></html>'), (2, "<p>ohne Rumpf</p>"), (3, "")]))
def old_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = '<!DOCTYPE html>\n<html><head><script>x("</p>")</script></head><body bgcolor="#fff" text="x"> <font size="5"><b>Gesetz</b></font><p><font size="2">a</font> <i>b</i> <b>c</b></p>\n</body></html>'
    return fixture(spark, [(1, old), (2, "<p>ohne <b>Rumpf</b></p>"), (3, None)], "id int, html string").select("id", pages.modern_page("html").alias("html"))
