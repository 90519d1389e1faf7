"""Operators on miniature fixtures."""

import datetime as dt
import difflib
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from codexlake.operators import hierarchy, html, overlap, segment, tables, text, versions
from codexlake.sources import records, sinks
from codexlake.streaming import ingest


@pytest.fixture(scope="module")
def laws(spark):
    rows = [("1", "001", 1.0), ("1", "010", 10.0), ("1", "066", 66.0), ("1", "066a", 66.1), ("1", "100", 100.0), ("2", "005", 5.0), ("3", "007", 7.0), ("3", "007b", 7.0), ("4", "x", None), ("4", "002", 2.0)]
    return spark.createDataFrame(rows, "law string, version string, number double")


def test_links_exclude_equals_and_nulls(laws):
    out = {(r["law"], r["version"]): (r["older"], r["newer"]) for r in versions.links(laws, "law", "number", F.col("version"), "version").collect()}
    assert out["1", "066a"] == (["001", "010", "066"], ["100"]) and out["2", "005"] == ([], [])
    assert out["3", "007"] == out["3", "007b"] == ([], []) and out["4", "x"] == ([], []) and out["4", "002"] == ([], [])
    ranks = {(r["law"], r["version"]): (r["n_older"], r["n_newer"], r["oldest"], r["newest"]) for r in versions.ranks(laws, "law", "number", "version").collect()}
    assert ranks["1", "066a"] == (3, 1, "001", "100") and ranks["3", "007"] == (0, 0, None, None) and ranks["4", "x"] == (0, 0, None, None)
    for key, (older, newer) in out.items():
        assert (len(older), len(newer)) == ranks[key][:2]


def test_latest_terminal_and_pairs(laws):
    last = {r["law"]: r["version"] for r in versions.latest(laws, "law", [F.coalesce("number", F.lit(-1.0)), F.col("version")], ["version"]).collect()}
    assert last == {"1": "100", "2": "005", "3": "007b", "4": "002"}
    kept = versions.drop_terminal(laws, "law", [F.desc("number"), F.desc("version")], F.col("version") == "100")
    assert kept.where("law = '1'").count() == 4 and kept.count() == 9
    pairs = [(r["newer"], r["older"]) for r in versions.consecutive_pairs(laws.where("law = '1'"), "law", [F.desc("number")], "version").collect()]
    assert sorted(pairs) == [("066a", "066"), ("100", "066a")]


def test_upsert_and_missing(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None)], "k string, o int, v string")
    assert {tuple(r) for r in versions.upsert(rows, ["k"], [F.col("o")]).collect()} == {("a", 3, "z"), ("b", 1, None)}
    have = spark.createDataFrame([("b",)], "k string")
    assert [tuple(r) for r in versions.missing(rows, have, ["k"], ["o"]).select("k", "o", "v").collect()] == [("a", 1, "x")]


def test_word_diffs_restore_both_texts():
    rng = random.Random(5)
    for n in (0, 3, 40, 400):
        for _ in range(20):
            a = [rng.choice("abcdefgh") + str(rng.randrange(max(1, n // 3))) for _ in range(n)]
            b = [w for w in a if rng.random() > 0.1]
            for _ in range(n // 8):
                b.insert(rng.randrange(len(b) + 1), "new" + str(rng.randrange(5)))
            runs = html.common_runs(a, b)
            assert all(a[x : x + k] == b[y : y + k] for x, y, k in runs)
            assert all(u[0] + u[2] <= v[0] and u[1] + u[2] <= v[1] for u, v in zip(runs, runs[1:], strict=False))
            best = sum(m.size for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())
            assert sum(k for *_, k in runs) >= 0.8 * best
    long = [f"w{k}" for k in range(60_000)]
    assert html.common_runs(long, long[:30_000] + ["x"] + long[30_001:]) == [(0, 0, 30_000), (30_001, 30_001, 29_999)]


def test_hierarchy(spark):
    tree = '{"1":{"name":"State","sections":{"13":{"name":"Order","subsections":{"131":{"name":"Towns"}}},"14":{"name":" ","subsections":{}}}}}'
    codes = hierarchy.flatten(spark.createDataFrame([(tree,)], "t string").select(F.from_json("t", hierarchy.SCHEMA).alias("folders")))
    assert {tuple(r) for r in codes.collect()} == {(1, "1", None, "State"), (2, "13", "1", "Order"), (3, "131", "13", "Towns")}
    df = spark.createDataFrame([("131", "1", "13", "131"), ("14", "1", "14", "131"), ("9", "9", "13", "131")], "n string, a string, b string, c string")
    got = {r["n"]: (r["name1"], r["name2"], r["name3"]) for r in hierarchy.assign(df, codes, [F.col("a"), F.col("b"), F.col("c")]).collect()}
    assert got == {"131": ("State", "Order", "Towns"), "14": ("State", None, None), "9": (None, None, None)}


def test_provisions(spark):
    body = "intro\n###### Note\n\n[⟨§ 1.⟩](u) first\n\nmore\n## Part\ndropped\n[⟨Art. 2a⟩](v) second\n[⟨§ 3 bis⟩] [⟨Art. 9⟩] odd\n###### lost\ntext"
    rows = [tuple(r) for r in segment.provisions(spark.createDataFrame([(1, body), (2, None), (3, "")], "d int, b string"), ["d"], "b").orderBy("sequence").collect()]
    assert rows == [
        (1, 1, "section", "1", "###### Note\n\n[⟨§ 1.⟩](u) first\n\nmore"),
        (1, 2, "article", "2a", "[⟨Art. 2a⟩](v) second"),
        (1, 3, "section", "3bis", "[⟨§ 3 bis⟩] [⟨Art. 9⟩] odd"),
    ]


def test_references_and_subprovisions(spark):
    df = spark.createDataFrame([(1, "Art. 12a Abs. 2 lit. c und Ziff. 4, Artikel 5"), (2, None)], "d int, t string")
    assert {(r["kind"], r["value"]) for r in segment.references(df, ["d"], "t").collect()} == {("article", "12a"), ("article", "5"), ("paragraph", "2"), ("letter", "c"), ("number", "4")}
    marks = spark.createDataFrame([(["1", "3", "2", "2bis", "2quater", "2ter", "x", "3"],)], "m array<string>")
    assert marks.select(segment.subprovisions(F.col("m")).alias("ok")).first()["ok"] == [True, False, True, True, False, True, False, True]


def test_carry_and_continuations(spark):
    df = spark.createDataFrame([(1, 1, "a", None), (1, 2, "H1", "h"), (1, 3, "b", None), (1, 4, None, "h"), (1, 5, "c", None)], "d int, p int, t string, k string")
    out = segment.carry_forward(df, ["d"], ["p"], F.col("t"), F.col("k") == "h", "head")
    assert [r["head"] for r in out.orderBy("p").collect()] == [None, "H1", "H1", None, None]
    notes = spark.createDataFrame([(1, 1, "lost"), (1, 2, "1 one"), (1, 3, "more"), (1, 4, "2 two")], "d int, p int, t string")
    merged = segment.merge_continuations(notes, ["d"], "p", F.nullif(F.regexp_extract("t", r"^(\d+) ", 1), F.lit("")), "t")
    assert [tuple(r) for r in merged.orderBy("position").collect()] == [(1, 1, "1", 2, "1 one more"), (1, 2, "2", 1, "2 two")]


def test_grid_hash_and_changes(spark):
    rows = [("T", "/Table/TR/TH", 1, "a"), ("T", "/Table/TR/TH[2]", 2, "b"), ("T", "/Table/TR[3]/TD", 4, " c "), ("T", "/Table/TR[3]/TD", 3, "d"), ("T", "/P", 9, "no")]
    df = spark.createDataFrame(rows, "t string, path string, pos int, text string")
    grid = tables.grid(df, ["t"], tables.path_index("path", tables.ROW), tables.path_index("path", tables.CELL), "pos", "text").first()["grid"]
    assert grid == [["a", "b"], ["", ""], ["d c", ""]]
    again = tables.content_hash(df.orderBy(F.desc("pos")), ["t"], "path", "pos", "text").first()["hash"]
    assert again == tables.content_hash(df, ["t"], "path", "pos", "text").first()["hash"] and len(again) == 16
    pair = spark.createDataFrame([([["a", "b"]], [["a", "c"], ["d"]])], "o array<array<string>>, n array<array<string>>")
    assert {tuple(x) for x in pair.select(tables.cell_changes("o", "n").alias("c")).first()["c"]} == {(1, 2, "b", "c"), (2, 1, None, "d")}
    shapes = spark.createDataFrame([(1, [["a"], ["b"]]), (2, [["a"], ["b", "c"]]), (3, [])], "i int, g array<array<string>>")
    assert [r["ok"] for r in shapes.select(tables.rectangular("g").alias("ok"), "i").orderBy("i").collect()] == [True, False, False]


def test_table_membership(spark):
    df = spark.createDataFrame([("A", 1, "x"), ("A", 2, "§ 1"), ("A", 3, "y"), ("B", 4, "z")], "t string, pos int, text string")
    assert [r["t"] for r in tables.clear_from_section(df, "t", "pos", "text").orderBy("pos").collect()] == ["A", None, None, "B"]
    assert [r["t"] for r in tables.drop_single_rows(df, "t", F.col("pos")).orderBy("pos").collect()] == ["A", "A", "A", None]
    errors = df.select("pos", tables.correction_errors({"late": F.col("pos") > 2, "none": F.col("text").isNull()}).alias("e")).orderBy("pos").collect()
    assert [r["e"] for r in errors] == [[], [], ["late"], ["late"]]


def test_overlap_and_next(spark):
    notes = spark.createDataFrame([(1, 1, 0.0, 10.0), (1, 2, 50.0, 60.0), (1, 3, 500.0, 510.0)], "page int, id int, lo double, hi double")
    provisions = spark.createDataFrame([(1, 10, 0.0, 4.0), (1, 11, 4.0, 30.0), (1, 12, 61.0, 70.0)], "page int, id int, lo double, hi double")
    assert [tuple(r) for r in overlap.best_overlap(notes, provisions, ["page"], 7.0).collect()] == [(1, 1, 11, 6.0)]
    after = {r["left_id"]: r["right_id"] for r in overlap.next_after(notes, provisions, ["page"], "lo").collect()}
    assert after == {1: 10, 2: 12, 3: None}
    gaps = spark.createDataFrame([(1, v) for v in (0.0, 3.0, 9.0, 13.0)], "k int, y double")
    grouped = overlap.proximity_groups(gaps, ["k"], ["y"], F.col("y") - F.lag("y").over(Window.partitionBy("k").orderBy("y")), 5.0)
    assert [r["group_id"] for r in grouped.orderBy("y").collect()] == [1, 1, 2, 2]


def test_search(spark):
    docs = spark.createDataFrame([(1, "Für die Fürsorge [1] alle"), (2, "alle alle"), (3, None)], "d int, t string")
    assert {(r["term"], r["tf"]) for r in text.terms(docs, "d", "t").where("d = 2").collect()} == {("alle", 2)}
    assert docs.where("d = 1").select(text.excerpt("t", "fürsorge", 1, 2).alias("e")).first()["e"] == "die Fürsorge"
    assert [r["d"] for r in text.tfidf(text.terms(docs, "d", "t"), 3, ["alle"], "d", 5).collect()] == [2, 1]


def test_html():
    page = '<nav><a href="/n">N</a></nav><h6>Deep</h6><p class="marginalia">M</p><p><a href="#p1">§ 1</a> Text<b>!</b></p><script>x("</p>")</script><ul><li>one<li>two</ul><p class="footnote">f</p>'
    assert html.text_of(page) == "N Deep M § 1 Text! one two f"
    assert html.links_of(page) == [("/n", "N"), ("#p1", "§ 1")]
    assert html.markdown_of(page, "https://e.org/x") == "##### Deep\n\n###### M\n\n[⟨§ 1⟩](https://e.org/x#p1) Text!\n\n- one\n\n- two"
    assert html.clean_html('<p style="a" id="b">x</p><p> </p><style>y</style><br>') == '<p id="b">x</p><br>'
    assert html.diff_words("<p>a b c</p>", "<p>a x c d</p>") == (1, 2, "a <del>b</del> <ins>x</ins> c <ins>d</ins>")
    assert html.text_of(None) == "" and html.markdown_of("") == ""


def test_html_structure(spark):
    page = '<div class="a law"><p id="seq-0-prov-5">x</p><p id="seq-1-prov-5-sub-2">y <b>z</b></p><p id="other">q</p></div><table id="t"><tr><th>A<th>B</tr><tr><td>1<td>2<td>3</table><table><tr><td>Kurz<td>Name</tr><tr><td>Ein Satz.<td></table>'
    assert [e["text"] for e in html.elements_of(page, "p", "id", "other")] == ["q"] and html.elements_of(page, attribute="class", value="law")[0]["tag"] == "div"
    first, second = html.tables_of(page)
    assert first == {"id": "t", "grid": [["A", "B", ""], ["1", "2", "3"]], "header_rows": 1} and second["header_rows"] == 1
    assert html.table_html([["a", "<"], ["1", "2"]]) == "<table><thead><tr><th>a</th><th>&lt;</th></tr></thead><tbody><tr><td>1</td><td>2</td></tr></tbody></table>"
    assert html.table_paragraphs([["a", "", "b"], ["", ""]]) == "<p>a b</p>"
    changed = html.apply_table_decisions(page, {html.grid_hash(first["grid"]): ("untabled", None), html.grid_hash(second["grid"]): ("rebuilt", [["N"], ["w"]])})
    assert "<p>A B</p><p>1 2 3</p>" in changed and "<th>N</th>" in changed and html.apply_table_decisions(page, {}) == page
    lists = "<dl><dt>a.</dt><dd>one<dl><dt>1.</dt><dd>deep</dd></dl></dd><dt>Datum:</dt><dd>5</dd></dl>"
    assert [(d["level"], d["term"], d["text"]) for d in html.definitions_of(lists)] == [(1, "a.", "one"), (2, "1.", "deep"), (1, "Datum:", "5")]
    assert html.definition(lists, "Datum") == "5" and html.definition(lists, "x") is None
    assert html.redirect_of("<script>window.location = '/p/1.html'</script>", "http://e.org/") == "http://e.org/p/1.html" and html.redirect_of(None) is None
    df = spark.createDataFrame([("1", page), ("2", None)], "law string, html string")
    rows = html.anchors(df, "law", "html")
    assert {tuple(r) for r in rows.collect()} == {("1", "5", None, 0), ("1", "5", "2", 1)}
    assert {tuple(r) for r in segment.anchor_map(rows, "law", "prov", "sub", "seq").collect()} == {("1", "5", None, 1), ("1", "5", "2", 2)}
    assert html.tables(df, "law", "html").count() == 2


def test_sources(spark, tmp_path):
    (tmp_path / "c.json").write_text('[{"ordnungsnummer":"1","category":{"folder":{"id":"1","name":"S"}},"versions":[{"nachtragsnummer":"001","law_text_url":"a.pdf","in_force":true},{"nachtragsnummer":"002"}]}]')
    laws = records.read_collection(spark, str(tmp_path / "c.json"))
    versions_ = records.exploded_versions(laws)
    assert [tuple(r) for r in records.download_rows(versions_).collect()] == [("1", "001", "a.pdf", "pdf")]
    flat = records.flatten_columns(laws)
    assert "category_folder_name" in flat.columns and "versions" in flat.columns
    (tmp_path / "s.json").write_text('{"results":{"bindings":[{"n":{"value":" 101 "}},{"m":{"value":"x"}}]}}')
    assert [tuple(r) for r in records.read_bindings(spark, str(tmp_path / "s.json"), ["n", "m"]).collect()] == [("101", ""), ("", "x")]
    (tmp_path / "d.xml").write_text("<r><KRVersand><Datum>20240101</Datum><Geschaeft><Titel>T</Titel><KRNummer>1/2</KRNummer><Schritte><Schritt><Art>a</Art><Datum>01.02.2003</Datum></Schritt><Schritt><Art>b</Art><Datum>05.02.2003</Datum></Schritt><Schritt><Art>c</Art><Datum>-</Datum></Schritt></Schritte></Geschaeft></KRVersand><KRVersand><Datum>20240102</Datum></KRVersand></r>")
    (row,) = records.affair_rows(records.read_dispatches(spark, str(tmp_path / "d.xml"))).collect()
    assert (row["affair_nr"], row["latest_step"]["type"], len(row["steps"])) == ("1.2", "b", 2)
    (tmp_path / "1-002.md").write_bytes("---\ntitle: 'Ä'\nn: 5\n---\nbody --- x".encode())
    (tmp_path / "2-001.md").write_bytes("kein Kopf Ä".encode("latin-1"))
    got = {r["name"]: (r["metadata"], r["body"]) for r in records.read_markdown(spark, str(tmp_path / "*.md")).collect()}
    assert got == {"1-002.md": ({"title": "Ä", "n": "5"}, "body --- x"), "2-001.md": ({}, "kein Kopf Ä")}
    (tmp_path / "e.json").write_text('{"elements":[{"Path":"/P","Text":"a","Page":0,"Bounds":[0,1,2,3],"attributes":{"TableID":"T"}},{"Path":"/P[2]"}]}')
    elements = records.read_elements(spark, str(tmp_path / "e.json")).orderBy("pos").collect()
    assert [(e["pos"], e["Path"]) for e in elements] == [(0, "/P"), (1, "/P[2]")] and elements[0]["attributes"] == {"TableID": "T"}
    triples = spark.createDataFrame([("s", "nr", "101"), ("s", "from", "2020-01-01"), ("s", "url", "u"), ("t", "nr", "102"), ("t", "from", "2020-01-01"), ("t", "to", "2021-01-01"), ("t", "url", "v")], "s string, p string, o string")
    assert [tuple(r) for r in records.current_laws(triples, "nr", "from", "to", "url", F.lit("2024-01-01")).collect()] == [("101", "2020-01-01", "u")]
    files = spark.createDataFrame([("/x/131.1/20240101/a.json",), ("/x/abc/1/a.json",)], "path string")
    assert [tuple(r)[:2] for r in records.law_folders(files).collect()] == [("131.1", "20240101")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", "ä")], "a string, b string")
    sinks.write_csv(df, str(tmp_path / "csv"))
    parts = [p.read_bytes() for p in (tmp_path / "csv").glob("*.csv")]
    assert all(p.startswith(b"\xef\xbb\xbfa,b\n") for p in parts) and any("1,ä".encode() in p for p in parts)
    sinks.create_tables(spark)
    assert {tuple(r) for r in sinks.table_counts(spark).collect()} == {("laws", 0), ("versions", 0), ("provisions", 0)}
    sinks.drop_tables(spark)
    anchors = spark.createDataFrame([("1", "5", None, 2), ("1", "5", "1", 1)], "law string, prov string, sub string, sequences int")
    assert sinks.anchor_json(anchors, "law", "prov", "sub", "sequences").first()["json"] == '{"5":{"sequences":2,"subprovisions":{"1":1}}}'
    report = spark.createDataFrame([((1, 2), [3, 4])], "m struct<a:int,b:int>, l array<int>")
    assert sinks.flat_report(report).first().asDict() == {"m_a": 1, "m_b": 2, "l": "3, 4"}


def test_streams(spark, tmp_path):
    day = dt.datetime(2024, 1, 1)
    rows = [("a", day, 1), ("a", day + dt.timedelta(minutes=1), 2), ("b", day + dt.timedelta(minutes=2), 3)]
    spark.createDataFrame(rows, "k string, at timestamp, o int").write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema("k string, at timestamp, o int").parquet(str(tmp_path / "in"))
    for name, frame, mode in (("seen", ingest.first_seen(stream(), ["k"], "at", "1 hour"), "append"), ("counts", ingest.activity(stream(), "at", "k", "1 hour", None, "1 hour"), "complete"), ("new", ingest.unseen(stream(), spark.createDataFrame([("a",)], "k string"), ["k"]), "append")):
        q = frame.writeStream.format("memory").queryName(name).outputMode(mode).start()
        q.processAllAvailable()
        q.stop()
    assert {r["k"] for r in spark.table("seen").collect()} == {"a", "b"} and spark.table("seen").count() == 2
    assert {(r["k"], r["n"]) for r in spark.table("counts").collect()} == {("a", 2), ("b", 1)}
    assert [r["k"] for r in spark.table("new").collect()] == ["b"]
    q = stream().writeStream.foreachBatch(ingest.upsert_batches(spark, str(tmp_path / "out"), ["k"], [F.col("o")])).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert {(r["k"], r["o"]) for r in spark.read.parquet(str(tmp_path / "out" / "batch=0")).collect()} == {("a", 2), ("b", 3)}
