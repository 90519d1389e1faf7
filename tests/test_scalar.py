"""Scalar rules on the literals whose treatment is easy to get wrong."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from codexlake.functions import scalar


def apply(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", f("x").alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("f", "values", "want"),
    [
        (scalar.iso_date, ["20240229", "20230229", "2024-2-3", "2024-02-03", "", "abc", None, " 20240101 "], ["2024-02-29", "", "2024-02-03", "2024-02-03", "", "", "", "2024-01-01"]),
        (scalar.swiss_date, ["20240229", "", None], ["29.02.2024", "N/A", "N/A"]),
        (scalar.from_swiss_date, ["01.02.2003", "1.2.2003", "-", "31.02.2003", None], ["20030201", "20030201", "", "", ""]),
        (scalar.feed_date, ["20240229", ""], ["Thu, 29 Feb 2024 00:00:00 -0000", None]),
        (scalar.date_is_valid, ["", None, "20240230", "20240228"], [True, True, False, True]),
        (scalar.bool_safe, ["true", "Yes", "off", "", "x", "2", "0", None], [True, True, False, False, None, None, False, None]),
        (scalar.int_safe, ["12.7", "-3.9", "x", "", None, "nan", "1e3", " 66 "], [12, -3, None, None, None, None, 1000, 66]),
        (scalar.float_safe, ["inf", "nan", "1.5", ""], [None, None, 1.5, None]),
        (scalar.version_number, ["066", "066a", "066k", "066aa", "a66", "1.5", None], [66.0, 66.1, 66.11, 66.11, None, 1.5, None]),
        (scalar.suffix_of_link, ["a-b-066a.html", "plain", "x-1"], ["066a", "000", "1"]),
        (scalar.without_zero_branch, ["0.101", "101", " 0.1 "], ["101", "101", "1"]),
        (scalar.squeeze, ["  a b \n c ", None], ["a b c", None]),
        (scalar.dehyphenate, ["Für-  sorge", "ein-  und aus", "A-  B"], ["Fürsorge", "ein-  und aus", "A-  B"]),
        (scalar.xml_escape, ["a & <b> \"'"], ["a &amp; &lt;b&gt; &quot;&apos;"]),
        (scalar.json_answer, ['x ```json\n{"a": 1}\n``` y', " {} "], ['{"a": 1}', "{}"]),
        (scalar.dynamic_url, ["https://e.org/col-ab/131.1-118.html#seq-0", "https://e.org/other/1.html"], ["https://e.org/col-ab/131.1/latest#seq-0", "https://e.org/other/1.html"]),
        (scalar.footnote_text, ["a , b ( c ) .d"], ["a, b (c). d"]),
    ],
)
def test_rules(spark, f, values, want):
    assert apply(spark, values, f) == want


def test_structs(spark):
    codes = apply(spark, ["1", "13", "131", "131.1", "0.1", "0.10", "0.101", "0.101.2", "x", None], scalar.category_codes)
    assert [tuple(c) for c in codes] == [
        ("1", None, None), ("1", "13", None), ("1", "13", "131"), ("1", "13", "131"), ("0.1", None, None), ("0.1", "0.10", None), ("0.1", "0.10", "0.101"), ("0.1", "0.10", "0.101"), (None,) * 3, (None,) * 3,
    ]
    assert [tuple(a) for a in apply(spark, ["seq-3-prov-12a-sub-2x", "seq-0-prov-1", "no"], scalar.anchor_parts)] == [(3, "12a", "2"), (0, "1", None), (None, None, None)]
    assert [tuple(a) for a in apply(spark, ["12A.3", "5", "a"], scalar.provision_input)] == [("12a", "3"), ("5", None), (None, None)]
    assert [tuple(a) for a in apply(spark, ["131.1-066a.md"], scalar.file_parts)] == [("131.1", "066a")]
    titles = ["Gesetz (Steuergesetz, StG)", "Erlass (StG)", "Erlass (das gesetz)", "ohne"]
    assert [tuple(a) for a in apply(spark, titles, scalar.short_title)] == [("Steuergesetz", "StG"), ("", "StG"), ("", ""), ("", "")]


def test_affairs_and_status(spark):
    kinds = ["Vorlage X", "EINZELINITIATIVE", "Behördeninitiative", "BEHÖRDENINITIATIVE", "Parlamentarische Initiative", "Motion", " ", None]
    assert apply(spark, kinds, scalar.affair_priority) == [1, 2, 3, 3, 4, 5, 6, 6]
    assert apply(spark, [" "], lambda x: scalar.affair_priority(x, blank=5)) == [5]
    grid = F.array(F.array(F.lit("a")))
    other = F.array(F.array(F.lit("b")))
    words = ["confirmed", "edited", "merged_with_x", "rejected", "odd", None, "confirmed_with_changes"]
    assert apply(spark, words, lambda x: scalar.review_status(x, grid, other)) == ["confirmed_with_changes", "confirmed_with_changes", "merged", "rejected", "undefined", "undefined", "confirmed_with_changes"]
    assert apply(spark, ["confirmed"], lambda x: scalar.review_status(x, grid, grid)) == ["confirmed_without_changes"]
    assert apply(spark, ["g", "", None], lambda x: scalar.feed_guid(F.lit("20240101"), x, F.lit("t"))) == ["20240101-g", "20240101-e358efa489f5", "20240101-e358efa489f5"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.from_regex(r"\A([a-c]{0,2}[0-9]{0,4}){1,2}\Z"), min_size=2, max_size=30))
def test_natural_key_orders_by_number(spark, values):
    import re

    parts = lambda s: [(1, "", int(p)) if p.isdigit() else (2, p, 0) for p in re.findall(r"\d+|\D+", s.lower())]
    keys = apply(spark, values, scalar.natural_key)
    for a, ka in zip(values, keys, strict=True):
        for b, kb in zip(values, keys, strict=True):
            if parts(a) != parts(b) and len(parts(a)) == len(parts(b)):
                assert (ka < kb) == (parts(a) < parts(b))
