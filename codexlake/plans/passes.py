"""The passes over paragraphs, each on documents written out beside what they become."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexlake.catalog import QUERIES, SQL, fixture, values
from codexlake.operators import crossref, passes

_ELEMENT = re.compile(r'<(p|h[1-6]|div|table|td|th)((?:\s+[\w-]+="[^"]*")*)>(.*?)</\1>', re.DOTALL)


def parse(html: str) -> list[tuple]:
    """The elements of a fixture; ``size`` stands among the attributes."""
    out = []
    for tag, own, inner in _ELEMENT.findall(html):
        a = dict(re.findall(r'([\w-]+)="([^"]*)"', own))
        out.append((tag, a.get("class", "").split(), a.get("id"), inner, float(a["size"]) if "size" in a else None))
    return out


#: name -> passes, and documents before and after them.
CASES: dict[str, tuple[tuple[passes.Pass, ...], list[tuple[str, str]]]] = {
    "empty_paragraphs": ((passes.drop_empty,), [("<p>a  b\n c</p><p> </p><p><b></b></p><h2></h2>", "<p>a b c</p><h2></h2>")]),
    "dash_paragraphs": ((passes.join_dashes,), [
        ("<p>Justiz</p><p> - </p><p>direktion</p><p>x</p>", "<p>Justizdirektion</p><p>x</p>"),
        ("<p>-</p><p>a</p>", "<p>-</p><p>a</p>"), ("<p>a &amp; b</p><p>-</p><p>c</p>", "<p>a &amp; bc</p>")]),
    "hyphenated_paragraphs": ((passes.join_hyphenated,), [
        ("<p>Ver-</p><p>waltung</p>", "<p>Ver-waltung</p>"), ("<p>Ver-</p><p>Waltung</p>", "<p>Ver-</p><p>Waltung</p>"),
        ("<p>a-</p><p>b-</p><p>c</p>", "<p>a-b-</p><p>c</p>")]),
    "bracket_paragraphs": ((passes.join_brackets,), [("<p>(</p><p>siehe oben</p><p>)</p><p>y</p>", "<p>(siehe oben)</p><p>y</p>"), ("<p>(</p><p>x</p>", "<p>(</p><p>x</p>")]),
    "superscript_before_provision": ((passes.unmark_after_superscript,), [
        ('<p><sup>2</sup></p><p class="provision">§ 3.</p>', "<p><sup>2</sup></p><p>§ 3.</p>"), ('<p>2</p><p class="provision">§ 3.</p>', '<p>2</p><p class="provision">§ 3.</p>')]),
    "punctuation_paragraphs": ((passes.join_punctuation,), [("<p>a</p><p>,</p><p><b>;</b></p><p>...</p><p>b</p>", "<p>a,<b>;</b></p><p>...</p><p>b</p>"), ("<p>.</p><p>a</p>", "<p>.</p><p>a</p>")]),
    "enumerator_paragraphs": ((passes.join_enumerators,), [
        ('<p class="enum-lit">a.</p><p>erstens</p><p class="enum-dash">–</p><p>dann</p>', '<p class="enum-lit">a. erstens</p><p class="enum-dash">– dann</p>'), ('<p class="enum-ziff">1.</p>', '<p class="enum-ziff">1.</p>')]),
    "fraction_paragraphs": ((passes.join_fractions,), [
        ("<p><numerator>1</numerator></p><p>/</p><p><denominator>20</denominator></p><p>x</p>", "<p><numerator>1</numerator>&frasl;<denominator>20</denominator></p><p>x</p>"),
        ("<p><numerator>1</numerator></p><p>x</p><p><denominator>2</denominator></p>", "<p><numerator>1</numerator></p><p>x</p><p><denominator>2</denominator></p>")]),
    "continued_paragraphs": ((passes.join_continued,), [
        ("<p>der erste</p><p>teil</p><p>, dann</p><p>Neu</p>", "<p>der erste teil , dann</p><p>Neu</p>"), ("<p>a</p><h2>T</h2><p>b</p>", "<p>a</p><h2>T</h2><p>b</p>"),
        ('<p class="provision">§ 1.</p><p>: x</p>', '<p class="provision">§ 1.</p><p>: x</p>'), ("<p>M</p><p><sup>2</sup> groß</p>", "<p>M <sup>2</sup> groß</p>")]),
    "isolated_marks": ((passes.join_isolated,), [
        ("<p>vor</p><p><sup>2</sup></p><p>nach</p><p>x</p>", "<p>vor <sup>2</sup> nach</p><p>x</p>"), ("<p><sub>2</sub></p><p>nach</p>", "<p><sub>2</sub> nach</p>"), ("<p>vor</p><p><sup>2</sup></p>", "<p>vor <sup>2</sup></p>"),
        ("<p>vor</p><p><numerator>1</numerator>⁄<denominator>1020</denominator></p><p>nach</p>", "<p>vor <numerator>1</numerator>⁄<denominator>1020</denominator> nach</p>")]),
    "first_headings": ((passes.join_first_headings,), [("<h1>Gesetz</h1><h1>über <b>x</b></h1><h1>y</h1><p>a</p><h1>z</h1><h1>w</h1>", "<h1>Gesetz über <b>x</b> y</h1><p>a</p><h1>z</h1><h1>w</h1>"), ("<h1>a</h1><p>b</p>", "<h1>a</h1><p>b</p>")]),
    "spaces_at_marks": ((passes.space_marks,), [
        ("<p>m <sup>2</sup>und</p><td>CO <sub>2</sub> </td>", "<p>m<sup>2</sup> und</p><td>CO<sub>2</sub></td>"), ('<p class="x">m <sup>2</sup></p>', '<p class="x">m <sup>2</sup></p>'),
        ("<p>a <sup>1</sup> <sub>2</sub> b</p>", "<p>a<sup>1</sup><sub>2</sub> b</p>")]),
    "line_before_footnotes": ((passes.footnote_line,), [('<p>a</p><p class="footnote">1 x</p><p class="footnote">2 y</p>', '<p>a</p><hr id="footnote-line"><p class="footnote">1 x</p><p class="footnote">2 y</p>'), ("<p>a</p>", "<p>a</p>")]),
    "bracketed_to_previous": ((passes.join_bracketed,), [("<h2>T</h2><p>[1]</p><p>a</p><p>[<a>2</a>]</p><p>[b</p>", "<h2>T[1]</h2><p>a[<a>2</a>]</p><p>[b</p>")]),
    "provision_self_anchors": ((passes.self_anchors,), [
        ('<p class="provision" id="seq-0-prov-1">§ 1.<a href="#f">x</a> y</p>', '<p class="provision" id="seq-0-prov-1"><a href="#seq-0-prov-1">§ 1.</a><a href="#f">x</a><a href="#seq-0-prov-1"> y</a></p>'),
        ('<p class="subprovision" id="s">2<sup><a href="#f">3</a></sup></p>', '<p class="subprovision" id="s"><a href="#s">2</a><sup><a href="#f">3</a></sup></p>'), ('<p class="provision">§ 1.</p>', '<p class="provision">§ 1.</p>')]),
    "footnote_regions": ((passes.find_footnotes,), [
        ('<h1>T</h1><p size="8">vor</p><h2>A</h2><p size="10">Text</p><p size="8">1 Note</p><p size="6"><sup>1</sup></p><p size="4"><sup>1</sup></p>',
         '<h1>T</h1><p>vor</p><h2>A</h2><p>Text</p><p class="footnote">1 Note</p><p><sup>1</sup></p><p class="footnote"><sup>1</sup></p>'),
        ('<h1>T</h1><p size="8">OS 12, 34</p><h2>Anhang</h2><p size="8">hinten</p>', '<h1>T</h1><p class="footnote">OS 12, 34</p><h2>Anhang</h2><p>hinten</p>'),
        ('<h2>A</h2><p class="provision" size="8">§ 1.</p>', '<h2>A</h2><p class="provision">§ 1.</p>')]),
    "footnotes_before_the_first": ((passes.refine_footnotes,), [
        ('<p class="footnote">x</p><p class="footnote"><sup>1</sup> a</p><p class="footnote"><sup>2</sup> b</p>', '<p>x</p><p class="footnote"><sup>1</sup> a</p><p class="footnote"><sup>2</sup> b</p>'), ('<p class="footnote">x</p>', '<p class="footnote">x</p>')]),
    "raised_numbers": ((passes.raise_numbers,), [("<p> 12 </p><p>Ge-setz <b>a-b</b></p><p>A-b</p><h3>7</h3><p><sup>3</sup></p>", "<p><sup>12</sup></p><p>Gesetz<b>ab</b></p><p>A-b</p><h3><sup>7</sup></h3><p><sup>3</sup></p>")]),
    "raised_only_paragraphs": ((passes.drop_raised,), [("<p>a</p><p> </p><p><sup>1</sup></p><p><sup>1</sup> b</p><h2></h2>", "<p>a</p><p><sup>1</sup> b</p><h2></h2>")]),
    "references_hidden_from_search": ((passes.hide_references,), [('<p>a<sup class="footnote-ref"><a href="#x">[1]</a></sup></p>', '<p>a<sup class="footnote-ref" data-pagefind-ignore="all"><a href="#x">[1]</a></sup></p>')]),
    "notes_lifted_to_provisions": ((passes.lift_notes,), [
        ('<p class="provision">§ 1.</p><p>a</p><div class="marginalia-container">n</div><p>b</p>', '<div class="marginalia-container">n</div><p class="provision">§ 1.</p><p>a</p><p>b</p>'),
        ('<div class="marginalia-container">n</div><p class="provision">§ 1.</p>', '<div class="marginalia-container">n</div><p class="provision">§ 1.</p>')]),
    "consolidated_enumerations": ((passes.consolidate_enumerations,), [
        ('<p class="enum-lit">a. erstens</p><p>weiter</p><h3>T</h3><p>nicht</p>', '<p class="enum-lit"><span class="enum-enumerator">a.</span><span class="enum-content">erstens weiter</span></p><h3>T</h3><p>nicht</p>'),
        ('<p class="enum-ziff">1.</p><p>x</p><p class="q">y</p><p>z</p>', '<p class="enum-ziff"><span class="enum-enumerator">1.</span><span class="enum-content">x</span></p><p class="q">y</p><p>z</p>'),
        ('<p class="enum-dash">– so</p><p>x</p>', '<p class="enum-dash"><span class="enum-enumerator">– </span><span class="enum-content">so</span></p><p>x</p>')]),
    "subprovision_containers": ((passes.block_subprovisions,), [
        ('<p class="subprovision">1</p><p>a</p><p>b</p><p class="enum-lit">c</p><p class="subprovision">2</p><p>d</p><h2>T</h2><p>e</p>',
         '<div class="subprovision-container"><p class="subprovision">1</p><p class="subprovision-first-para">a b</p><p class="enum-lit">c</p></div><div class="subprovision-container"><p class="subprovision">2</p><p class="subprovision-first-para">d</p></div><h2>T</h2><p>e</p>')]),
    "margin_notes_tidied": ((passes.tidy_note,), [
        ("<p>Zu-</p><p>ständig-keit</p><p><sup>1</sup></p><p>a. Ort b. Zeit</p>", '<p class="marginalia">Zuständigkeit</p><p class="marginalia">a. Ort</p><p class="marginalia">b. Zeit</p>'),
        ("<p>Sach- </p><p> und Wert</p><p>Neu</p>", '<p class="marginalia">Sachund Wert Neu</p>'), ("<p> </p>", "")]),
    "elements_merged_and_split": ((passes.merge_and_split,), [
        ("<p>§ 5. Wer</p><p>a</p><p>,</p><p>b</p><p>§</p><p>6. x</p>", "<p>§ 5.</p><p>Wer</p><p>a, b</p><p>§ 6.</p><p>x</p>"),
        ("<p>gilt, wenn a. es regnet</p>", "<p>gilt, wenn</p><p>a.</p><p>es regnet</p>"), ("<p>x</p><p>,</p><p>a. b</p>", "<p>x</p><p>,</p><p>a. b</p>"),
        ("<p>(wie in a. gesagt wird</p><p>gemäss § 54 b. und so</p><p>Herr A. Meier</p><p>usw a. dann</p>", "<p>(wie in a. gesagt wird</p><p>gemäss § 54 b. und so</p><p>Herr A. Meier</p><p>usw a. dann</p>"),
        ("<p>Teil II) dann III. so</p>", "<p>Teil</p><p>II)</p><p>dann</p><p>III.</p><p>so</p>")]),
    "provision_containers": ((passes.block_provisions,), [
        ('<p>vor</p><div class="marginalia-container" id="seq-0-prov-1">n</div><p class="provision" id="seq-0-prov-1">§ 1.</p><p>a</p><h2>T</h2><p class="provision" id="seq-0-prov-2">§ 2.</p><p class="footnote">f</p>',
         '<p>vor</p><div class="provision-container"><div class="marginalia-container" data-related-provision="seq-0-prov-1">n</div><p class="provision" id="seq-0-prov-1">§ 1.</p><p>a</p></div><h2>T</h2><div class="provision-container"><p class="provision" id="seq-0-prov-2">§ 2.</p></div><p class="footnote">f</p>')]),
    "notes_related_to_provisions": ((passes.relate_notes,), [
        ('<p class="marginalia">a</p><p>x</p><p class="provision" id="seq-0-prov-1">§ 1.</p><p class="marginalia">b</p><h2>T</h2><p class="provision" id="seq-0-prov-2">§ 2.</p>',
         '<div class="marginalia-container" id="seq-0-prov-1"><p class="marginalia">a</p></div><p>x</p><p class="provision" id="seq-0-prov-1">§ 1.</p><p class="marginalia">b</p><h2>T</h2><p class="provision" id="seq-0-prov-2">§ 2.</p>')]),
    "federal_headings": ((passes.split_headings,), [
        ('<h6 class="heading"><a href="#a1"><b>Art. 1</b> Zweck</a></h6><h6>x</h6>', '<h6 class="heading">Zweck</h6><p class="provision">Art. 1</p><h6>x</h6>'),
        ('<h6 class="heading"><a href="#a2"><b>Art. 2</b></a> Geltung</h6>', '<h6 class="heading">Geltung</h6><p class="provision">Art. 2</p>'),
        ('<h6 class="heading"><a href="#a3">Art. 3</a></h6>', '<h6 class="heading">Art. 3</h6>'),
        ('<h6 class="heading"><a href="#a4">Art. 4</a><a href="#t">Begriffe und Ziele</a><sup>5</sup></h6>', '<h6 class="heading">Begriffe und Ziele</h6><p class="provision">Art. 4<sup>5</sup></p>')]),
    "federal_containers": ((passes.group_provisions,), [
        ('<h2>T</h2><h6>Zweck</h6><p class="provision">Art. 1</p><p>a</p><h6>Ziel</h6><p class="provision">Art. 2</p>',
         '<h2>T</h2><div class="provision-container"><div class="marginalia-container"><h6>Zweck</h6></div><p class="provision">Art. 1</p><p>a</p></div><div class="provision-container"><div class="marginalia-container"><h6>Ziel</h6></div><p class="provision">Art. 2</p></div>')]),
    "paragraphs_marked_as_notes": ((passes.mark_notes,), [('<p>a</p><p class="marginalia">b</p><p class="x">c</p>', '<p class="marginalia">a</p><p class="marginalia">b</p><p class="x marginalia">c</p>')]),
    "numbers_to_subprovisions": ((passes.mark_subprovisions,), [
        ('<p>1</p><p class="provision" id="seq-0-prov-1">§ 1.</p><p size="9">1</p><p>a</p><p size="9">1bis</p><p size="9">3</p><p size="4">2</p><p size="9">2</p>',
         '<p>1</p><p class="provision" id="seq-0-prov-1">§ 1.</p><p class="subprovision" id="seq-0-prov-1-sub-1">1</p><p>a</p><p class="subprovision" id="seq-0-prov-1-sub-1bis">1bis</p><p>3</p><p>2</p><p class="subprovision" id="seq-0-prov-1-sub-2">2</p>')]),
    "federal_text": (passes.FEDERAL, [
        ('<h6 class="heading"><a href="#a1"><b>Art. 1</b> Zweck</a></h6><p>x</p>', '<h6 class="heading">Zweck</h6><p class="provision">Art. 1</p><p>x</p>'),
        ('<p class="provision" id="seq-0-prov-1">Art. 1</p><p>1</p><p>x</p>', '<p class="provision" id="seq-0-prov-1"><a href="#seq-0-prov-1">Art. 1</a></p><p class="subprovision" id="seq-0-prov-1-sub-1"><a href="#seq-0-prov-1-sub-1">1</a></p><p>x</p>')]),
    "references_linked_in_notes": ((crossref.link_references(*crossref.SCOPES),), [
        ('<p class="provision" id="seq-0-prov-5">Art. 5</p><p class="subprovision" id="seq-0-prov-5-sub-2">2</p><p class="footnote">Vgl. Art. 5 Abs. 2 und Art. 9 (Art. 5bis)</p><p>Art. 5</p>',
         '<p class="provision" id="seq-0-prov-5">Art. 5</p><p class="subprovision" id="seq-0-prov-5-sub-2">2</p><p class="footnote">Vgl. <a class="cross-reference" href="#seq-0-prov-5">Art. 5</a> <a class="cross-reference" href="#seq-0-prov-5-sub-2">Abs. 2</a> und Art. 9 (Art. 5bis)</p><p>Art. 5</p>'),
        ('<p class="provision" id="seq-0-prov-5">x</p><p class="marginalia"><a href="y">Art. 5</a> fooArt. 5</p>', '<p class="provision" id="seq-0-prov-5">x</p><p class="marginalia"><a href="y">Art. 5</a> fooArt. 5</p>')]),
    "footnote_texts_linked": ((crossref.link_texts([("SR 101", "https://e.org/101"), ("OS 5", "https://e.org/5")]),), [
        ('<p class="footnote">Fassung SR 101; sr 101, SR 1012, OS 5.</p><p>SR 101</p>', '<p class="footnote">Fassung <a href="https://e.org/101">SR 101</a>; <a href="https://e.org/101">sr 101</a>, SR 1012, <a href="https://e.org/5">OS 5</a>.</p><p>SR 101</p>'),
        ('<p class="footnote"><a href="x">SR 101</a> sr 101</p>', '<p class="footnote"><a href="https://e.org/101">SR 101</a> sr 101</p>')]),
    "bold_dashes": ((passes.join_bold_dashes,), [
        ('<p size="700">Straf </p><p size="700"> - </p><p size="700"> prozess</p><p size="700">-</p><p size="500">recht</p><p>x</p>', "<p>Strafprozessrecht</p><p>x</p>"), ('<p size="700">a</p><p>-</p><p size="700">b</p>', "<p>a</p><p>-</p><p>b</p>")]),
    "page_of_paragraphs": (passes.PAGE, [
        ('<h1>Gesetz</h1><h1>über x</h1><p>Justiz</p><p>-</p><p>direktion</p><p> </p><p class="enum-lit">a.</p><p>erstens</p><p>,</p><p class="footnote">1 n</p>',
         '<h1>Gesetz über x</h1><p>Justizdirektion</p><p class="enum-lit">a. erstens,</p><hr id="footnote-line"><p class="footnote">1 n</p>')]),
}


def _register(name: str, chain: tuple[passes.Pass, ...], cases: list[tuple[str, str]]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = fixture(spark, [(n, parse(html)) for n, (html, _) in enumerate(cases)], f"doc int, items {passes.PARAGRAPHS}")
        return passes.rewrite(docs, "items", *chain).select("doc", passes.markup("items").alias("html"))

    run.__name__, run.__doc__ = name, " ".join((p.__doc__ or p.__name__).split("\n")[0] for p in chain)
    QUERIES[name], SQL[name] = run, values("doc::INT, html::VARCHAR", [(n, after) for n, (_, after) in enumerate(cases)])


for _name, (_chain, _cases) in CASES.items():
    _register(_name, _chain, _cases)


def paragraphs_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document as paragraphs, run through the dash, hyphen and punctuation passes."""
    from codexlake.catalog import table

    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.struct(F.lit("p").alias("tag"), F.array().cast("array<string>").alias("cls"), F.lit(None).cast("string").alias("id"), F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")).alias("html"), F.lit(None).cast("double").alias("size")))
    docs = table(spark, sf_dir, "documents").select("doc_id", lines.alias("items"))
    out = passes.rewrite(docs, "items", passes.drop_empty, passes.join_punctuation)
    return out.select("doc_id", F.size("items").alias("n_paragraphs"))


QUERIES["paragraphs_of_documents"] = paragraphs_of_documents
SQL["paragraphs_of_documents"] = r"""
WITH l AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
t AS (SELECT r, doc_id, list_filter(list_transform(lines, lambda x: trim(x, E' \t\r\f\x0b')), lambda x: x <> '') AS texts FROM l)
SELECT doc_id, (len(texts) - len(list_filter(list_slice(texts, 2, len(texts)), lambda x: regexp_full_match(x, '[!-/:-@\[-`{-~]+') AND NOT contains(x, '...'))))::INT AS n_paragraphs FROM t
"""
