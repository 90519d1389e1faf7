"""Layout rules and processing state on miniature fixtures."""

from pyspark.sql import functions as F

from codexlake.operators import layout, workflow


def elements(spark, rows):
    """(pos, y0, x0, text) as elements of one page."""
    data = [(1, p, 0, float(x), float(y), float(x) + 10, float(y) + 10, t, 10.0, 400.0, 800.0) for p, y, x, t in rows]
    return spark.createDataFrame(data, "doc int, pos int, page int, x0 double, y0 double, x1 double, y1 double, text string, size double, weight double, height double")


def test_reading_order(spark):
    df = elements(spark, [(0, 100, 50, "b"), (1, 102, 10, "a"), (2, 130, 0, "c"), (3, 105, 90, "d")])
    assert {r["text"]: r["line"] for r in layout.sort_lines(df, "doc", "height").collect()} == {"a": 1, "b": 1, "d": 1, "c": 2}


def test_margins_and_boxes(spark):
    df = elements(spark, [(0, 5, 0, "top"), (1, 55, 0, "in"), (2, 745, 0, "bottom"), (3, 735, 0, "cut")])
    assert {r["text"] for r in layout.body_only(df, "height").collect()} == {"in", "cut"}
    one = spark.createDataFrame([([0.0, 1.0, 2.0, 3.0], [[0.0, 5.0, 1.0, 6.0], [0.0, 4.0, 1.0, 9.0]]), ([0.0, 1.0, 2.0, 3.0], None)], "b array<double>, c array<array<double>>")
    assert [tuple(r["s"]) for r in one.select(layout.vertical_span("c", "b").alias("s")).collect()] == [(4.0, 9.0), (1.0, 3.0)]
    assert tuple(one.select(layout.flip(F.lit(10.0), F.lit(20.0)).alias("s")).first()["s"]) == (575.0, 585.0)
    assert one.select(layout.grow(F.col("b"), 1.0).alias("g")).first()["g"] == [-1.0, 0.0, 3.0, 4.0]


def test_roles(spark):
    df = elements(spark, [(0, 0, 0, "§ 1."), (1, 10, 0, "Text"), (2, 20, 0, "Schlussbestimmungen"), (3, 30, 0, "Gesetz vom 1. Mai"), (4, 40, 0, "m"), (5, 50, 0, "2")])
    placed = layout.demote_after_final(df, "doc").withColumn("level", F.when(F.col("pos").isin(2, 3), 2))
    tags = [r["t"] for r in placed.orderBy("pos").select(layout.tag_of("text", "level", "after_last_final").alias("t")).collect()]
    assert tags == ["provision", "p", "h2", "p", "p", "p"]
    assert [r["is_unit"] for r in layout.square_metres(df, ["doc"]).orderBy("pos").collect()] == [False] * 5 + [True]
    kinds = spark.createDataFrame([("a. x",), ("12) y",), ("iv. z",), ("– q",), ("no",)], "t string").select(layout.enumerator("t").alias("k"))
    assert [r["k"] for r in kinds.collect()] == ["letter", "number", "roman", "dash", None]
    small = elements(spark, [(0, 0, 0, "a"), (1, 0, 0, "b")]).withColumn("size", F.when(F.col("pos") == 0, 2.0).otherwise(10.0))
    assert [r["is_small"] for r in layout.fractions(small, "doc").orderBy("pos").collect()] == [True, False]
    none = small.withColumn("size", F.lit(None).cast("double"))
    assert {r["is_small"] for r in layout.fractions(none, "doc").collect()} == {False}


def test_merges_and_splits(spark):
    df = elements(spark, [(0, 0, 0, "Für"), (1, 0, 0, "-"), (2, 0, 0, "sorge"), (3, 0, 0, "x")])
    merged = layout.merge_rows(df, ["doc"], F.col("text").isin("-", "sorge"))
    assert [(r["pos"], r["text"]) for r in merged.orderBy("pos").collect()] == [(0, "Für-sorge"), (3, "x")]
    parts = spark.createDataFrame([("§ 12a. rest",), ("§ 3.",), ("none",)], "t string").select(layout.split_provision("t").alias("p"))
    assert [r["p"] for r in parts.collect()] == [["§ 12a.", "rest"], ["§ 3."], ["none"]]


def test_tables_by_geometry(spark):
    headers = spark.createDataFrame([("T", 1, 0.0, 10.0), ("T", 2, 10.0, 20.0)], "t string, id int, x0 double, x1 double")
    cells = spark.createDataFrame([("T", 7, 1.0, 4.0), ("T", 8, 8.0, 20.0), ("T", 9, 50.0, 60.0), ("T", 10, 5.0, 15.0)], "t string, id int, x0 double, x1 double")
    assert {r["cell_id"]: r["column_id"] for r in layout.cell_columns(cells, headers, "t").collect()} == {7: 1, 8: 2, 9: 2, 10: 1}
    like = spark.createDataFrame([(1, 0, "h", [["a"]]), (1, 1, "h", [["b"]]), (1, 2, "k", [["c"]]), (1, 3, "h", [["d"]])], "d int, pos int, head string, body array<array<string>>")
    assert [(r["head"], r["body"]) for r in layout.merge_like_tables(like, "d", "head", "body").orderBy("pos").collect()] == [("h", [["a"], ["b"]]), ("k", [["c"]]), ("h", [["d"]])]
    paths = spark.createDataFrame([(1, 0, "/D/T/TR/TD"), (1, 1, "/D/T2/TR"), (1, 2, "/D/T")], "d int, pos int, path string")
    maps = spark.createDataFrame([(1, 0, "/D/T", "x")], "d int, pos int, path string, table_id string")
    assert [r["table_id"] for r in layout.table_of_path(paths, maps, "d").orderBy("pos").collect()] == ["x", None, "x"]


def test_kids_and_html(spark):
    tree = '[{"Path":"/a","Text":"A","Kids":[{"Path":"/a/b","Text":"<B>"}]},{"Path":"/c"}]'
    flat = layout.flatten_kids(spark.createDataFrame([(1, tree), (2, None)], "d int, j string"), ["d"], "j")
    assert [(r["pos"], r["path"], r["text"]) for r in flat.orderBy("pos").collect()] == [(0, "/a", "A"), (1, "/a/b", "<B>"), (2, "/c", None)]
    tagged = flat.where("text is not null").withColumn("tag", F.when(F.col("pos") == 0, "provision").otherwise("h2"))
    assert layout.to_html(tagged, "d").first()["html"] == '<p class="provision">A</p>\n<h2>&lt;B&gt;</h2>'


def test_lookups_and_steps(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    facts = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("c", "9", 1)], "k string, v string, o int")
    assert {tuple(r) for r in workflow.lookup(keys, facts, "k", "v", "o").collect()} == {("a", "2"), ("b", "")}
    assert {r["k"]: r["versions"] for r in workflow.versions_of(keys, facts, "k", F.col("v"), ["o"]).collect()} == {"a": ["1", "2"], "b": []}
    right = spark.createDataFrame([("d", "1/2", None, 5), ("d", "x", "1/2", 4)], "d string, p string, q string, o int")
    assert workflow.match_either(spark.createDataFrame([("d", "1/2")], "d string, n string"), right, "d", "n", ["p", "q"], "o").first()["matched"] == 4
    steps = spark.createDataFrame([({"a": "1"},), (None,)], "s map<string,string>")
    stamped = steps.select(workflow.stamp("s", "a", F.lit("2")).alias("s"))
    assert [r["s"] for r in stamped.collect()] == [{"a": "2"}, {"a": "2"}]
    assert [r["ok"] for r in steps.select(workflow.completed("s", ["a"]).alias("ok")).collect()] == [True, False]


def test_completion(spark):
    tables = spark.createDataFrame([("l", "h1"), ("l", "h2"), ("m", "h1")], "law string, hash string")
    decisions = spark.createDataFrame([("l", "h1", "rejected"), ("l", "h2", "undefined"), ("m", "h1", "merged")], "law string, hash string, status string")
    assert {(r["law"], r["n_undecided"], r["complete"]) for r in workflow.completion(tables, decisions, "law", "hash").collect()} == {("l", 1, False), ("m", 0, True)}
    assert [tuple(r) for r in workflow.undecided(tables, decisions, "law", "hash").collect()] == [("l", "h2")]


def test_more_table_rules(spark):
    rows = [("A", 1, 0, "§ 1"), ("A", 2, 1, "Head"), ("A", 3, 2, "x"), ("B", 1, 3, "y"), (None, None, 4, "§")]
    out = layout.headers_with_section(spark.createDataFrame(rows, "t string, r int, pos int, text string"), "t", "r").orderBy("pos").collect()
    assert [(x["t"], x["r"]) for x in out] == [(None, None), ("A", 1), ("A", 2), ("B", 1), (None, None)]
    cells = layout.grid_elements(spark.createDataFrame([("k", [["a", "b"], ["c"]])], "k string, g array<array<string>>"), ["k"], "g")
    assert {(r["path"], r["text"]) for r in cells.collect()} == {("/Table/TR[1]/TH[1]", "a"), ("/Table/TR[1]/TH[2]", "b"), ("/Table/TR[2]/TD[1]", "c")}
    sup = spark.createDataFrame([("Sup", "2bis"), ("Sup", "lettersonly"), ("Sub", "2")], "p string, text string")
    assert [r["k"] for r in sup.select(layout.keeps_superscript("p").alias("k")).collect()] == [True, False, False]


def test_enumerators_annex_and_articles(spark):
    df = spark.createDataFrame([("Es gilt: a. eins, b. zwei; 3) drei",), ("nach Abs. 2 (vgl. a. oben) gilt A. Meier",)], "text string")
    assert [r["p"] for r in df.select(layout.split_enumerators("text").alias("p")).collect()] == [["Es gilt:", "a.", "eins, b. zwei; 3) drei"], ["nach Abs. 2 (vgl. a. oben) gilt A. Meier"]]
    marks = spark.createDataFrame([("a. eins",), ("2bis) x",), ("– y",), ("kein",)], "text string").select(layout.enumerator_parts("text").alias("e"))
    assert [tuple(r["e"]) for r in marks.collect()] == [("a.", "eins"), ("2bis)", "x"), ("–", "y"), (None, "kein")]
    articles = spark.createDataFrame([("Art. 5a Zweck",), ("Text",)], "text string").select(layout.article_label("text").alias("a"))
    assert [tuple(r["a"]) for r in articles.collect()] == [("Art. 5a", "Zweck"), (None, "Text")]
    doc = elements(spark, [(0, 0, 0, "1 early note"), (1, 0, 0, "Anhang 1"), (2, 0, 0, "x"), (3, 0, 0, "1 note"), (4, 0, 0, "z")])
    placed = layout.annex(doc, "doc", F.col("text").endswith("note"))
    assert [r["in_annex"] for r in placed.orderBy("pos").collect()] == [False, True, True, False, False]
