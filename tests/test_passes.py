"""What passes and review operators do with nulls, empty and repeated rows."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from codexlake.functions import pages
from codexlake.operators import crossref, passes, review, workflow

EVERY = [f for f in (getattr(passes, n) for n in dir(passes)) if callable(f) and getattr(f, "__annotations__", {}).get("items") == "list[Paragraph]" and not f.__name__.startswith("_")]


def test_every_pass_is_found():
    assert len(EVERY) >= 35 and passes.join_dashes in EVERY


@pytest.mark.parametrize("rule", EVERY, ids=lambda f: f.__name__)
def test_passes_bear_nothing_and_odd_paragraphs(rule):
    assert rule([]) == []
    odd = [passes.Paragraph(html=x) for x in ("", "-", "(", "<b>", "&amp;", "a" * 5000, "<sup>1</sup>", "§", ",", "1")] + [passes.Paragraph("h1"), passes.Paragraph("div", ["marginalia-container"], "x"), passes.Paragraph("table")]
    assert isinstance(rule(odd), list)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["wort", "Ver-", "-", "a. eins", "§ 3. x", ",", "§", "(", ")", "<sup>2</sup>", "[1]", ""]), max_size=12))
def test_no_text_is_lost(parts):
    """Merges and splits move text; only dashes and white space may go."""
    letters = lambda items: sorted("".join(c for p in items for c in p.text if c.isalnum()))
    for rule in (passes.join_punctuation, passes.join_continued, passes.join_isolated, passes.join_bracketed, passes.merge_and_split, passes.join_dashes, passes.join_hyphenated, passes.join_brackets):
        assert letters(rule([passes.Paragraph(html=x) for x in parts])) == letters([passes.Paragraph(html=x) for x in parts])


def test_null_documents_stay(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, [], "y"), (3, [("p", None, None, None, None)], "z")], f"doc int, items {passes.PARAGRAPHS}, tag string")
    out = {r["doc"]: (r["items"], r["tag"]) for r in passes.rewrite(df, "items", *passes.PAGE).collect()}
    assert out == {1: (None, "x"), 2: ([], "y"), 3: ([], "z")}
    read = passes.read_paragraphs(spark.createDataFrame([(1, None), (2, "no tags"), (3, '<p class="a b" id="i" data-font-size="8.5">t</p>')], "doc int, html string"), "html")
    assert {r["doc"]: [tuple(p) for p in r["items"]] for r in read.collect()} == {1: [], 2: [], 3: [("p", ["a", "b"], "i", "t", 8.5)]}


def test_references_without_anchors(spark):
    refs = spark.createDataFrame([(1, "d", "article", "5", None), (2, None, "letter", None, "x")], "ref int, doc string, kind string, value string, context string")
    anchors = spark.createDataFrame([("d", 1, None), ("d", 2, "other"), (None, 3, "seq-0-prov-5")], "doc string, pos int, id string")
    assert {r["ref"]: r["target"] for r in crossref.reference_targets(refs, anchors, "doc").collect()} == {1: None, 2: None}
    none = spark.createDataFrame([], "doc int, pos int, text string")
    assert crossref.law_changes(none, ["doc"], "pos", "text").count() == 0


def test_review_of_nothing(spark):
    t = spark.createDataFrame([], "law string, version string, hash string, grid array<array<string>>, page int, pdf string, source string")
    c = spark.createDataFrame([], "law string, version string, hash string, status string, corrected array<array<string>>")
    assert review.editor_tables(t, c, True).count() == review.seeded(t, c).count() == review.regenerated(c, t).count() == review.law_metrics(c).count() == 0
    one = spark.createDataFrame([("l", "1", "h", [["a"]], 1, "p", "s")], t.schema)
    assert [r["status"] for r in review.editor_tables(one, c, False).collect()] == ["pending"]


def test_positions_are_those_of_the_order(spark):
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 AS k").repartition(7)
    rows = workflow.positions(df, "k").orderBy("k").collect()
    assert [r["position"] for r in rows] == list(range(1, 1001)) and [r["next"] for r in rows] == [*range(1, 1000), None]


def test_positions_of_more_rows_than_a_shuffle_samples(spark):
    df = spark.range(200_000).selectExpr("(id * 7919) % 200000 AS k", "nullif(id, -1) AS id").repartition(7)
    out = workflow.positions(df, "k").selectExpr("count_if(position = k + 1 AND next <=> if(k < 199999, k + 1, null)) AS right", "count(id) AS n").first()
    assert (out["right"], out["n"]) == (200_000, 200_000)
    assert workflow.positions(df.limit(0), "k").count() == 0
    few = spark.createDataFrame([("b",), (None,), ("a",), (None,), ("a",)], "k string")
    assert sorted((r["position"], r["k"], r["next"]) for r in workflow.positions(few, "k").collect()) == [(1, "a", "a"), (2, "a", "b"), (3, "b", None), (4, None, None), (5, None, None)]


def test_pages_of_nothing(spark):
    one = spark.createDataFrame([(None, None)], "x string, n double")
    out = one.select(pages.html_escape("x").alias("a"), pages.numbered_name("x").alias("b"), pages.modern_page("x").alias("c"), pages.is_metadata("x").alias("d"), pages.link_text("x").alias("e"), pages.size_saving("n", F.lit(1.0)).alias("f")).first()
    assert (out["a"], tuple(out["b"]), out["c"], out["d"], out["e"], out["f"]["percent"]) == (None, (None, None), "", False, None, 0.0)
