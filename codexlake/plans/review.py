"""Reviews of tables over documents: a document is a table, its source the law, its language the version, labels the decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexlake.catalog import fixture, query, table, values
from codexlake.operators import html, layout, review, segment, tables

_STATUS = ["undefined", "confirmed_without_changes", "confirmed_with_changes", "rejected", "merged_with_x", "odd"]
_OLDER = ["confirmed", "rejected", "edited", "merged", "undefined", "confirmed"]
_T = "t AS (SELECT coalesce(source, '') AS law, coalesce(lang, '') AS version, doc_id::VARCHAR AS hash, string_split(substr(coalesce(text, ''), 1, 40), ' ') AS words FROM documents)"


def _c(names: list[str]) -> str:
    return f"c AS (SELECT t.law, t.version, t.hash, (ARRAY{names!r})[l.doc_id % 6 + 1] AS status, CASE WHEN l.quality = 1 THEN [list_slice(words, 1, 1)] END AS corrected FROM labels l JOIN t ON t.hash = l.doc_id::VARCHAR)"


def _tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split(F.substring(F.coalesce("text", F.lit("")), 1, 40), " ")
    return table(spark, sf_dir, "documents").select(F.coalesce("source", F.lit("")).alias("law"), F.coalesce("lang", F.lit("")).alias("version"), F.col("doc_id").cast("string").alias("hash"), F.array(words).alias("grid"), (F.col("n_chars") % 9).alias("page"), F.concat(F.col("doc_id").cast("string"), F.lit(".pdf")).alias("pdf"), F.col("lang").alias("source"))


def _corrections(spark: SparkSession, sf_dir: str, names: list[str] = _STATUS) -> DataFrame:
    marks = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("hash"), F.element_at(F.array(*map(F.lit, names)), (F.col("doc_id") % 6 + 1).cast("int")).alias("status"), "quality")
    t = _tables(spark, sf_dir).select("law", "version", "hash", "grid")
    return t.join(marks, "hash").select("law", "version", "hash", "status", F.when(F.col("quality") == 1, F.array(F.slice(F.col("grid")[0], 1, 1))).alias("corrected"))


@query(f"""
WITH {_T}, {_c(_STATUS)}
SELECT t.law, t.hash, CASE WHEN coalesce(c.status, 'undefined') = 'undefined' THEN 'pending' ELSE c.status END AS status,
  CASE WHEN c.status LIKE 'merged%' THEN 'merge' WHEN c.status = 'confirmed_with_changes' THEN 'edit' WHEN c.status = 'rejected' THEN 'reject' ELSE 'confirm' END AS operation,
  NOT coalesce(c.status IN ('confirmed_without_changes', 'confirmed_with_changes', 'rejected') OR c.status LIKE 'merged%', false) AS shown
FROM t LEFT JOIN c USING (law, hash)
""")
def editor_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.editor_tables(_tables(spark, sf_dir), _corrections(spark, sf_dir), False).select("law", "hash", "status", "operation", "shown")


@query(f"""
WITH {_T}, {_c(_STATUS)}
SELECT t.law, count(*) AS total, count(*) FILTER (NOT coalesce(c.status NOT IN ('undefined', 'odd'), false)) AS to_review, count(*) FILTER (coalesce(c.status NOT IN ('undefined', 'odd'), false)) AS reviewed FROM t LEFT JOIN c USING (law, hash) GROUP BY t.law
""")
def editor_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.editor_counts(review.editor_tables(_tables(spark, sf_dir), _corrections(spark, sf_dir), False))


@query(f"""
WITH {_T}, {_c(_STATUS)}
SELECT t.law, t.hash, t.version AS in_version, t.hash || '.pdf' AS pdf FROM t LEFT JOIN c USING (law, hash) WHERE coalesce(c.status, 'undefined') = 'undefined'
""")
def undecided_in_older_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = review.versioned_tables(_tables(spark, sf_dir), _corrections(spark, sf_dir), False)
    return out.select("law", "hash", F.col("found_in_versions")[0].alias("in_version"), F.element_at("pdf_paths", F.col("found_in_versions")[0]).alias("pdf"))


@query(f"""
WITH {_T}, {_c(_OLDER)}
SELECT law, count(*) AS tables, count(*) FILTER (status = 'confirmed') AS confirmed, count(*) FILTER (status = 'rejected') AS rejected, count(*) FILTER (status = 'edited') AS edited, count(*) FILTER (status = 'merged') AS merged,
  count(*) FILTER (status NOT IN ('confirmed', 'rejected', 'edited', 'merged')) AS errors, count(*) * 30 AS seconds FROM c GROUP BY law
""")
def law_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.law_metrics(_corrections(spark, sf_dir, _OLDER)).drop("hashes")


@query(f"""
WITH {_T}, {_c(_OLDER)}
SELECT t.law, t.hash, CASE WHEN c.status = 'edited' AND c.corrected IS NOT NULL THEN array_to_string(c.corrected[1], ' ') ELSE array_to_string(t.words, ' ') END AS first_row FROM t LEFT JOIN c USING (law, hash) WHERE c.status IS NULL OR c.status <> 'rejected'
""")
def older_corrections_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = review.older_applied(_tables(spark, sf_dir), _corrections(spark, sf_dir, _OLDER))
    return out.select("law", "hash", F.array_join(F.col("grid")[0], " ").alias("first_row"))


@query(f"WITH {_T} SELECT law, hash, CASE WHEN len(words) > 0 THEN 'confirmed' ELSE 'rejected' END AS status, NULL::VARCHAR AS reason FROM t")
def simulated_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.simulated_answers(_tables(spark, sf_dir)).drop("corrected")


@query(f"""
WITH {_T}, f AS (SELECT DISTINCT t.law, t.version FROM labels l JOIN t ON t.hash = l.doc_id::VARCHAR WHERE l.doc_id % 40 = 0)
SELECT law, version, count(DISTINCT hash) AS tables FROM t WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.law = t.law AND f.version = t.version) GROUP BY law, version
""")
def seeded_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions without a correction file; those with one are some labelled versions."""
    files = _corrections(spark, sf_dir).where("CAST(hash AS BIGINT) % 40 = 0")
    return review.seeded(_tables(spark, sf_dir), files)


@query(f"""
WITH {_T}, {_c(_STATUS)}, w AS (SELECT min(law) AS law FROM t)
SELECT c.law, c.hash, c.status FROM c WHERE c.law NOT IN (SELECT law FROM w) UNION ALL SELECT law, hash, 'undefined' FROM t WHERE law IN (SELECT law FROM w)
""")
def regenerated_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return review.regenerated(_corrections(spark, sf_dir), t, t.agg(F.min("law").alias("law"))).select("law", "hash", "status")


@query(f"""
WITH {_T}, {_c(_STATUS)} SELECT t.hash, CASE WHEN c.hash IS NULL THEN 'not_started' WHEN c.status = 'odd' THEN 'error' ELSE c.status END AS state, coalesce(c.status = 'rejected', false) AS completed FROM t LEFT JOIN c USING (law, hash)
""")
def correction_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _corrections(spark, sf_dir).select("law", "hash", "status")
    out = _tables(spark, sf_dir).join(c, ["law", "hash"], "left")
    readable = ~F.coalesce(F.col("status") == "odd", F.lit(False))
    return out.select("hash", review.file_status(F.col("status"), readable).alias("state"), review.is_completed(F.when(F.col("status") == "rejected", "completed").otherwise(F.col("status"))).alias("completed"))


_REPEAL = "v AS (SELECT o_custkey AS law, o_orderkey AS version, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y%m%d') END AS repealed FROM orders), r AS (SELECT c_custkey AS law, '2020' || lpad((c_custkey % 12 + 1)::VARCHAR, 2, '0') || '01' AS repealed FROM customer WHERE c_custkey % 4 = 0)"


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    v = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("law"), F.col("o_orderkey").alias("version"), F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyyMMdd")).alias("repealed"))
    key = F.col("c_custkey")
    r = table(spark, sf_dir, "customer").where("c_custkey % 4 = 0").select(key.alias("law"), F.concat(F.lit("2020"), F.lpad((key % 12 + 1).cast("string"), 2, "0"), F.lit("01")).alias("repealed"))
    return v, r


@query(f"""
WITH {_REPEAL} SELECT law, version, coalesce(r.repealed, v.repealed) AS repealed, coalesce(r.repealed, v.repealed) IS DISTINCT FROM v.repealed AS changed FROM v LEFT JOIN r USING (law)
""")
def repeals_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.repeal(*_versions(spark, sf_dir))


@query(f"""
WITH {_REPEAL}, m AS (SELECT law, max(version) AS last FROM v GROUP BY law)
SELECT DISTINCT law FROM v JOIN m USING (law) JOIN r USING (law) WHERE version = last AND r.repealed IS DISTINCT FROM v.repealed
""")
def laws_updated_by_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the latest version of each law is refreshed."""
    return review.updated_laws(review.repeal(*_versions(spark, sf_dir), latest_only=True))


@query("""
WITH a AS (SELECT r_regionkey % 2 AS k, r_name FROM region UNION ALL SELECT 7, 'twice' UNION ALL SELECT 7, 'twice'), b AS (SELECT r_regionkey % 2 AS k, r_name FROM region WHERE r_regionkey < 4 UNION ALL SELECT 7, 'twice' UNION ALL SELECT 8, 'new')
SELECT (SELECT count(*) FROM a) AS rows, (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS missing, (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS added
""")
def verified_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region").select((F.col("r_regionkey") % 2).alias("k"), "r_name")
    extra = lambda rows: fixture(spark, rows, "k int, r_name string")
    copy = table(spark, sf_dir, "region").where("r_regionkey < 4").select((F.col("r_regionkey") % 2).alias("k"), "r_name")
    return review.verified_copy(r.unionByName(extra([(7, "twice"), (7, "twice")])), copy.unionByName(extra([(7, "twice"), (8, "new")])))


@query("""
SELECT event_id, ((row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 10)::INT AS batch, (try_cast(json_extract_string(props, '$.k') AS INT) * 2)::VARCHAR AS result, CASE WHEN try_cast(json_extract_string(props, '$.k') AS INT) IS NULL THEN 'no k' END AS error FROM events
""")
def batches_with_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "props")
    return review.in_batches(e, ["user_id"], "event_id", 10, F.get_json_object("props", "$.k").try_cast("int") * 2, F.lit("no k")).select("event_id", "batch", F.col("result").cast("string").alias("result"), "error")


@query(values("hash::VARCHAR, status::VARCHAR", [("a", "confirmed"), ("c", "rejected")]))
def editor_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of an editor's file that are objects with a status."""
    text = '{"a":{"status":"confirmed","hash":"a"},"b":{"hash":"b"},"c":{"status":"rejected"},"note":"x"}'
    return review.editor_answers(fixture(spark, [(text,), ("no json",)], "body string"), "body").select("hash", "status")


# --- tables and elements ----------------------------------------------------------------
@query(values("t::VARCHAR, pos::INT, single::VARCHAR, cut::VARCHAR, headed::VARCHAR, r::VARCHAR", [
    ("A", 0, "A", None, None, None), ("A", 1, "A", None, "A", "1"), ("A", 2, "A", None, "A", "2"), ("B", 3, None, "B", "B", "1"), ("C", 4, "C", "C", "C", "1"), ("C", 5, "C", None, "C", "2")]))
def rows_that_leave_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of one row, rows from a section sign on, and header rows with one."""
    rows = [("A", 1, 0, "§ 1"), ("A", 2, 1, "Head"), ("A", 3, 2, "x"), ("B", 1, 3, "y"), ("C", 1, 4, "h"), ("C", 2, 5, "§ 2")]
    f = fixture(spark, rows, "t string, r int, pos int, text string")
    single = tables.drop_single_rows(f, "t", F.col("r")).select("pos", F.col("t").alias("single"))
    cut = tables.clear_from_section(f, "t", "pos", "text").select("pos", F.col("t").alias("cut"))
    headed = layout.headers_with_section(f, "t", "r").select("pos", F.col("t").alias("headed"), F.col("r").cast("string").alias("r"))
    return f.select("t", "pos").join(single, "pos").join(cut, "pos").join(headed, "pos")


@query(values("pos::INT, table_id::VARCHAR", [(0, "x"), (1, None), (2, "x"), (3, "y")]))
def tables_of_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = fixture(spark, [(1, 0, "/D/T/TR/TD"), (1, 1, "/D/T2/TR"), (1, 2, "/D/T"), (1, 3, "/D/U/TR")], "d int, pos int, path string")
    maps = fixture(spark, [(1, 0, "/D/T", "x"), (1, 1, "/D/U", "y"), (1, 2, "/D/T/TR", "z")], "d int, pos int, path string, table_id string")
    return layout.table_of_path(paths, maps, "d").select("pos", "table_id")


@query(values("pos::INT, head::VARCHAR, body::VARCHAR", [(0, "h", "a,b"), (2, "k", "c"), (3, "h", "d")]))
def tables_of_equal_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    like = fixture(spark, [(1, 0, "h", [["a"]]), (1, 1, "h", [["b"]]), (1, 2, "k", [["c"]]), (1, 3, "h", [["d"]])], "d int, pos int, head string, body array<array<string>>")
    return layout.merge_like_tables(like, "d", "head", "body").select("pos", "head", F.array_join(F.flatten("body"), ",").alias("body"))


@query(values("path::VARCHAR, text::VARCHAR, r::VARCHAR, c::VARCHAR, new::VARCHAR", [("/Table/TR[1]/TH[1]", "a", None, None, None), ("/Table/TR[1]/TH[2]", "b", "1", "2", "B"), ("/Table/TR[2]/TD[1]", "c", None, None, None)]))
def grid_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid's cells as elements, and the cells that a correction changes."""
    f = fixture(spark, [("k", [["a", "b"], ["c"]], [["a", "B"], ["c"]])], "k string, g array<array<string>>, n array<array<string>>")
    cells = layout.grid_elements(f, ["k"], "g")
    changes = f.select(F.inline(tables.cell_changes("g", "n"))).withColumn("path", F.concat(F.lit("/Table/TR["), F.col("r"), F.lit("]/"), F.when(F.col("r") == 1, "TH").otherwise("TD"), F.lit("["), F.col("c"), F.lit("]")))
    return cells.join(changes.select("path", F.col("r").cast("string").alias("r"), F.col("c").cast("string").alias("c"), "new"), "path", "left").drop("k")


@query(values("cell_id::INT, column_id::INT", [(7, 1), (8, 2), (9, 2), (10, 1)]))
def columns_of_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = fixture(spark, [("T", 1, 0.0, 10.0), ("T", 2, 10.0, 20.0)], "t string, id int, x0 double, x1 double")
    cells = fixture(spark, [("T", 7, 1.0, 4.0), ("T", 8, 8.0, 20.0), ("T", 9, 50.0, 60.0), ("T", 10, 5.0, 15.0)], "t string, id int, x0 double, x1 double")
    return layout.cell_columns(cells, headers, "t").select("cell_id", "column_id")


_CELLS = [("T", 1, 0.0, 0.0, 10.0, "Jahr"), ("T", 2, 10.0, 0.0, 20.0, "Betrag"), ("T", 3, 1.0, 20.0, 9.0, "2020"), ("T", 4, 12.0, 21.0, 19.0, "5 & 6"), ("T", 5, 1.0, 40.0, 9.0, "2021"), ("T", 6, 2.0, 43.0, 9.0, "neu"), ("U", 7, 0.0, 0.0, 5.0, "allein")]


@query(values("t::VARCHAR, html::VARCHAR", [
    ("T", "<table><thead><tr><th>Jahr</th><th>Betrag</th></tr></thead><tbody><tr><td>2020</td><td>5 &amp; 6</td></tr><tr><td>2021 neu</td><td></td></tr></tbody></table>"), ("U", "<table><thead><tr><th>allein</th></tr></thead></table>")]))
def tables_by_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells to rows by height, to columns by their header, and to markup."""
    return layout.geometry_tables(fixture(spark, _CELLS, "t string, id int, x0 double, y0 double, x1 double, text string"), "t")


@query(values("pos::INT, final::BOOLEAN, late::BOOLEAN, tag::VARCHAR, kind::VARCHAR, unit::BOOLEAN, raised::BOOLEAN", [
    (0, False, False, "provision", None, False, True), (1, False, False, "p", "letter", False, True), (2, False, False, "h2", None, False, False), (3, True, True, "p", None, False, False), (4, True, True, "p", None, False, True), (5, True, True, "p", None, True, True)]))
def roles_of_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisions, headings, enumerators, what follows the closing provisions, and square metres."""
    rows = [(1, 0, "§ 1."), (1, 1, "a. x"), (1, 2, "Schlussbestimmungen"), (1, 3, "Gesetz vom 1. Mai"), (1, 4, "m"), (1, 5, "2")]
    f = layout.demote_after_final(fixture(spark, rows, "doc int, pos int, text string"), "doc").withColumns({"level": F.when(F.col("pos").isin(2, 3), 2), "position": F.lit("Sup")})
    f = layout.square_metres(f, ["doc"])
    return f.select("pos", F.col("after_final").alias("final"), F.col("after_last_final").alias("late"), layout.tag_of("text", "level", "after_last_final").alias("tag"), layout.enumerator("text").alias("kind"), F.col("is_unit").alias("unit"), layout.keeps_superscript("position").alias("raised"))


@query(values("id::INT, accepted::VARCHAR", [(1, "true,true,true,false,true"), (2, "false,true,false"), (3, "")]))
def subprovision_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture(spark, [(1, ["1", "1bis", "2", "7", "2bis"]), (2, ["2", "1", "1ter"]), (3, [])], "id int, marks array<string>")
    return rows.select("id", F.array_join(F.transform(segment.subprovisions(F.col("marks")), lambda x: x.cast("string")), ",").alias("accepted"))


@query(values("id::INT, mark::VARCHAR, content::VARCHAR, label::VARCHAR, rest::VARCHAR", [(1, "a.", "eins", None, "a. eins"), (2, "2bis)", "x", None, "2bis) x"), (3, None, "Art. 5a Zweck", "Art. 5a", "Zweck"), (4, "–", "y", None, "– y")]))
def marks_and_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fixture(spark, [(1, "a. eins"), (2, "2bis) x"), (3, "Art. 5a Zweck"), (4, "– y")], "id int, text string").withColumns({"e": layout.enumerator_parts("text"), "a": layout.article_label("text")})
    return f.select("id", "e.mark", "e.content", "a.label", "a.rest")


@query(values("pos::INT, in_annex::BOOLEAN, level::VARCHAR", [(0, False, None), (1, True, None), (2, True, "1"), (3, True, "2"), (4, False, None), (5, False, None)]))
def annex_and_enumerations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(1, 0, "1 early note"), (1, 1, "Anhang 1"), (1, 2, "a. x"), (1, 3, "1. y"), (1, 4, "1 note"), (1, 5, "z")]
    f = layout.annex(fixture(spark, rows, "doc int, pos int, text string"), "doc", F.col("text").endswith("note")).withColumn("kind", layout.enumerator("text"))
    return layout.enumeration_levels(f, ["doc"], ["pos"], "kind").select("pos", "in_annex", F.col("enum_level").cast("string").alias("level"))


@query(values("pos::INT, path::VARCHAR, text::VARCHAR", [(0, "/a", "A"), (1, "/a/b", "<B>"), (2, "/c", None)]))
def kids_of_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = '[{"Path":"/a","Text":"A","Kids":[{"Path":"/a/b","Text":"<B>"}]},{"Path":"/c"}]'
    return layout.flatten_kids(fixture(spark, [(1, tree), (2, None)], "d int, j string"), ["d"], "j").select("pos", "path", "text")


# --- HTML -------------------------------------------------------------------------------
_PAGE = '<div id="law"><h1>T</h1><table id="h1"><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr></table><table id="h2"><tr><td>x</td></tr></table><dl><dt>a.</dt><dd>eins<dl><dt>1.</dt><dd>zwei</dd></dl></dd></dl><script>window.location.href="/neu.html"</script></div>'


@query("""
SELECT * FROM (VALUES (1, 0, 'A,B;1,2', 1, substr(sha256('A|B|1|2'), 1, 16)), (1, 1, 'x', 0, substr(sha256('x'), 1, 16))) AS t(page, n, grid, header_rows, hash)
""")
def tables_in_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html.tables(fixture(spark, [(1, _PAGE), (2, None)], "page int, html string"), "page", "html")
    return out.select("page", F.col("position").alias("n"), F.array_join(F.transform("grid", lambda r: F.array_join(r, ",")), ";").alias("grid"), "header_rows", "hash")


@query(values("page::INT, prov::VARCHAR, sub::VARCHAR, seq::INT", [(1, "5", None, 0), (1, "5", "2", 1)]))
def anchors_in_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = '<p id="seq-0-prov-5">§ 5.</p><p id="seq-1-prov-5-sub-2">2</p><p id="other">x</p>'
    return html.anchors(fixture(spark, [(1, page)], "page int, html string"), "page", "html")


@query(values("level::INT, term::VARCHAR, text::VARCHAR, target::VARCHAR", [(1, "a.", "eins", "https://e.org/neu.html"), (2, "1.", "zwei", "https://e.org/neu.html")]))
def definitions_in_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definition lists with their levels, and where a page redirects to."""
    to = html.redirect_of(_PAGE, "https://e.org")
    return fixture(spark, [(d["level"], d["term"], d["text"], to) for d in html.definitions_of(_PAGE)], "level int, term string, text string, target string")


_FEDERAL = """<?xml version="1.0"?><html><head><title>x</title></head><!-- c --><body><h1 style="a">Gesetz</h1><p> </p><h6 class="heading odd"><a href="#a1"><b>Art. 1</b> Zweck</a></h6><p class="footnote">1 siehe Art. 2</p><p class="absatz">Text</p><h2>Teil</h2><p class="provision" id="seq-0-prov-2">Art. 2</p><p>1</p><p>Absatz</p></body></html>"""


@query(values("id::INT, page::VARCHAR", [(1, '<h2>Gesetz</h2><div class="provision-container"><div class="marginalia-container"><h6 class="heading">Zweck</h6></div><p class="provision">Art. 1</p><p>Text</p></div><h3>Teil</h3><div class="provision-container"><p class="provision" id="seq-0-prov-2"><a href="#seq-0-prov-2">Art. 2</a></p><p class="subprovision" id="seq-0-prov-2-sub-1"><a href="#seq-0-prov-2-sub-1">1</a></p><p>Absatz</p><hr id="footnote-line"><p class="footnote">1 siehe <a class="cross-reference" href="#seq-0-prov-2">Art. 2</a></p></div>'), (2, "")]))
def federal_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A federal text from its raw page to containers, anchors, footnotes and linked references."""
    return html.federal_pages(fixture(spark, [(1, _FEDERAL), (2, None)], "id int, html string"), "html").select("id", "page")


_RAW = [
    (1, 0, 0, "/D/P", None, "Kopf", 0.0, 800.0, 50.0, 830.0, 9.0, 400.0, None), (1, 1, 0, "/D/P2", None, "§ 1. Wer", 60.0, 500.0, 90.0, 510.0, 9.0, 700.0, None), (1, 2, 0, "/D/P3", None, "links", 10.0, 501.0, 50.0, 511.0, 9.0, 400.0, None),
    (1, 3, 0, "/D/T/TR/TH", 1, "§ 2", 10.0, 400.0, 50.0, 410.0, 9.0, 400.0, None), (1, 4, 0, "/D/T/TR[2]/TD", 2, "Zelle m", 10.0, 380.0, 50.0, 390.0, 9.0, 400.0, None), (1, 5, 0, "/D/P4", None, "2", 60.0, 380.0, 70.0, 390.0, 4.0, 400.0, "Sup"),
    (1, 6, 0, "/D/P5", None, "", 0.0, 300.0, 1.0, 310.0, 9.0, 400.0, None), (1, 7, 0, "/D/P6", None, "Schlussbestimmungen", 10.0, 200.0, 50.0, 210.0, 9.0, 700.0, None), (1, 8, 0, "/D/P7", None, "fett", 10.0, 150.0, 50.0, 160.0, 9.0, 700.0, None),
]


@query(values("text::VARCHAR, line::INT, table_id::VARCHAR, unit::BOOLEAN, raised::BOOLEAN, small::BOOLEAN, weight::DOUBLE", [
    ("links", 2, None, False, False, False, 400.0), ("§ 1. Wer", 2, None, False, False, False, 700.0), ("§ 2", 3, None, False, False, False, 400.0), ("Zelle m", 4, "t", False, False, False, 400.0), ("2", 4, None, True, True, True, 400.0),
    ("Schlussbestimmungen", 5, None, False, False, False, 700.0), ("fett", 6, None, False, False, False, 400.0)]))
def prepared_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All the rules of layout in order, from raw elements."""
    e = fixture(spark, _RAW, "doc int, pos int, page int, path string, row int, text string, x0 double, y0 double, x1 double, y1 double, size double, weight double, position string")
    maps = fixture(spark, [(1, 0, "/D/T", "t")], "doc int, pos int, path string, table_id string")
    out = layout.prepared(e, maps, fixture(spark, [(1, 0, 842.0)], "doc int, page int, height double"), "doc")
    return out.select("text", "line", "table_id", F.col("is_unit").alias("unit"), F.coalesce("is_raised", F.lit(False)).alias("raised"), F.col("is_small").alias("small"), "weight")


@query(values("doc::INT, html::VARCHAR", [(1, "links|§ 1.|Wer|§ 2|Zelle m|2|Schlussbestimmungen|fett")]))
def prepared_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prepared elements, merged and split."""
    from codexlake.operators import passes

    e = fixture(spark, _RAW, "doc int, pos int, page int, path string, row int, text string, x0 double, y0 double, x1 double, y1 double, size double, weight double, position string")
    maps = fixture(spark, [(1, 0, "/D/T", "t")], "doc int, pos int, path string, table_id string")
    out = layout.as_paragraphs(layout.prepared(e, maps, fixture(spark, [(1, 0, 842.0)], "doc int, page int, height double"), "doc"), "doc")
    return passes.rewrite(out, "items", *passes.LAYOUT).select("doc", F.array_join(F.transform("items", lambda p: p["html"]), "|").alias("html"))
