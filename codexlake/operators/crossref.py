"""Changes of laws named in dispatches, and references with the anchors they mean."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexlake.functions.scalar import squeeze
from codexlake.operators.passes import Pass, Paragraph
from codexlake.operators.segment import REFERENCES

#: What names a changed law, a changed norm, and a change of terms.
LAW_HEADING = r"(?iU)(\b\w*gesetz\w*\b.*?\bvom\b.*?(?:\b\d{4}\b).*?)(?=:(?=wird wie folgt geändert:|$))"
NORM = r"(?U)^(§.*?(?<!lit|abs)\.)"
TERMS = r"(?i)(Ersatz von Bezeichnungen)"
CHANGED = "wird wie folgt geändert"


def law_changes(df: DataFrame, key: list[str], order: str, text: str) -> DataFrame:
    """(key, law, norms): the norms that a dispatch's paragraphs change, law by law.

    Paragraphs from the heading ``Bericht`` on do not count.  A law named again
    starts anew; norms are distinct, in order of their first mention.
    """
    lines = df.select(*key, F.col(order).alias("_pos"), squeeze(text).alias("_t"))
    whole = Window.partitionBy(*key)
    lines = lines.withColumn("_end", F.min(F.when(F.lower("_t") == "bericht", F.col("_pos"))).over(whole)).where("_end is null or _pos < _end")
    heading = F.regexp_extract("_t", LAW_HEADING, 1)
    law = F.when(heading != "", F.trim(F.replace(heading, F.lit(CHANGED), F.lit(""))))
    upto = whole.orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    held = lines.withColumn("_law", law).withColumn("_start", F.last(F.when(F.col("_law").isNotNull(), F.col("_pos")), ignorenulls=True).over(upto))
    held = held.withColumn("law", F.last("_law", ignorenulls=True).over(upto)).where("law is not null")
    last = held.withColumn("_last", F.max("_start").over(Window.partitionBy(*key, "law"))).where("_start = _last")
    found = F.filter(F.array(F.struct(F.lit(0).alias("n"), F.regexp_extract("_t", NORM, 1).alias("norm")), F.struct(F.lit(1).alias("n"), F.regexp_extract("_t", TERMS, 1).alias("norm"))), lambda x: x["norm"] != "")
    rows = last.groupBy(*key, "law").agg(F.array_sort(F.flatten(F.collect_list(F.transform(found, lambda x: F.struct(F.col("_pos").alias("p"), x["n"].alias("n"), squeeze(x["norm"]).alias("norm")))))).alias("_all"))
    return rows.where(~F.lower("law").contains("gesetzesänderung")).select(*key, "law", F.array_distinct(F.transform("_all", lambda x: x["norm"])).alias("norms"))


def anchor_keys(anchors: DataFrame, doc: str, id_col: str, order: str) -> DataFrame:
    """(doc, kind, prov, value, id): what each anchor may be meant by, first anchor first.

    ``prov`` is null for what is found without a provision.  Numbers mean an anchor
    by the beginning of its last part, letters by the letter after its digits.
    """
    part = lambda n: F.nullif(F.regexp_extract(id_col, r"^seq-\d+-prov-(\w+?)(?:-sub-(\w+))?$", n), F.lit(""))
    rows = anchors.select(doc, F.col(id_col).alias("id"), F.col(order).alias("_pos"), part(1).alias("prov"), part(2).alias("sub")).where("prov is not null")
    key = lambda kind, value, prov: F.struct(F.lit(kind).alias("kind"), value.alias("value"), prov.alias("prov"))
    none, prov, sub = F.lit(None).cast("string"), F.col("prov"), F.col("sub")
    begins = F.transform(F.sequence(F.lit(1), F.length("sub")), lambda n: F.substring(sub, F.lit(1), n))
    numbers = F.flatten(F.transform(begins, lambda b: F.array(*(key(k, b, p) for k in ("paragraph", "number") for p in (prov, none)))))
    letter, alone = F.regexp_extract(sub, r"^\d*([a-z])", 1), F.regexp_extract(sub, r"^\d*([a-z])$", 1)
    keys = F.when(sub.isNull(), F.array(key("article", prov, none))).otherwise(F.concat(numbers, F.array(key("letter", letter, prov), key("letter", alone, none))))
    flat = rows.select(doc, "id", "_pos", F.explode(keys).alias("k")).where("k.value <> ''")
    return flat.groupBy(doc, "k.kind", "k.value", "k.prov").agg(F.min_by("id", "_pos").alias("id"))


def reference_targets(refs: DataFrame, anchors: DataFrame, doc: str, id_col: str = "id", order: str = "pos", context: str = "context") -> DataFrame:
    """``refs`` (doc, kind, value, context) with ``target``: an anchor's id, or null.

    A part is looked for in the provision that ``context`` (an anchor) names first,
    then in the whole document; articles always in the whole document.
    """
    keys = anchor_keys(anchors, doc, id_col, order)
    value = F.when(F.col("kind") == "letter", F.lower("value")).otherwise(F.col("value"))
    asked = refs.withColumns({"_v": value, "_p": F.regexp_extract(F.col(context), r"prov-(\d+\w*)", 1)})
    near = keys.where("prov is not null").select(doc, "kind", F.col("value").alias("_v"), F.col("prov").alias("_p"), F.col("id").alias("_near"))
    far = keys.where("prov is null").select(doc, "kind", F.col("value").alias("_v"), F.col("id").alias("_far"))
    return asked.join(near, [doc, "kind", "_v", "_p"], "left").join(far, [doc, "kind", "_v"], "left").withColumn("target", F.coalesce("_near", "_far")).drop("_v", "_p", "_near", "_far")


def anchor_link(text: Column, target: Column) -> Column:
    """The markup of a cross-reference; the text alone where it means nothing."""
    return F.when(target.isNotNull(), F.concat(F.lit('<a href="#'), target, F.lit('" class="cross-reference">'), text, F.lit("</a>"))).otherwise(text)


_PATTERNS = {kind: re.compile(pattern.removeprefix("(?U)")) for kind, pattern in REFERENCES.items()}


def _target(kind: str, value: str, ids: list[str]) -> str | None:
    if kind == "article":
        return next((i for i in ids if re.fullmatch(rf"seq-\d+-prov-{re.escape(value)}", i)), None)
    end = rf"-sub-\d*{re.escape(value.lower())}$" if kind == "letter" else rf"-sub-{re.escape(value)}\w*$"
    return next((i for i in ids if re.search(end, i)), None)


def link_references(*scopes: str) -> Pass:
    """A pass that links references in paragraphs of the classes ``scopes`` to the document's anchors.

    Text inside links stays; references go by their place in the text, so that no text
    is moved or doubled.
    """

    def run(items: list[Paragraph]) -> list[Paragraph]:
        ids = [p.id for p in items if p.tag == "p" and p.id and any("provision" in c for c in p.cls)]
        for p in (x for x in items if x.has(*scopes)):
            parts = re.split(r"(<a\b.*?</a>|<[^>]*>)", p.html)
            p.html = "".join(x if n % 2 else linked(x, ids) for n, x in enumerate(parts))
        return items

    def linked(text: str, ids: list[str]) -> str:
        found = sorted((m.start(), m.end(), target) for kind, pattern in _PATTERNS.items() for m in pattern.finditer(text) if (target := _target(kind, m[1], ids)))
        out, at = [], 0
        for start, end, target in found:
            if start >= at:
                out += [text[at:start], f'<a class="cross-reference" href="#{target}">{text[start:end]}</a>']
                at = end
        return "".join(out) + text[at:]

    return run


#: Notes first, then margins, then other annotations.
SCOPES = ("footnote", "footnote-content", "marginalia", "annotation", "comment", "note", "reference")


def link_texts(links: list[tuple[str, str]]) -> Pass:
    """A pass that links given texts in footnotes to their addresses, whole words only.

    A footnote must hold a text as it is written; then every spelling of its case in
    that footnote is linked.  A text that is a link already gets the address.
    """

    def run(items: list[Paragraph]) -> list[Paragraph]:
        for p in (x for x in items if x.has("footnote", "footnote-content")):
            for text, address in links:
                word = rf"\b{re.escape(text)}\b"
                parts = re.split(r"(<a\b.*?</a>|<[^>]*>)", p.html)
                for n, part in enumerate(parts):
                    if not re.search(word, re.sub("<[^>]*>", "", part)):
                        continue
                    if n % 2:
                        parts[n] = re.sub(r'href="[^"]*"', lambda m: f'href="{address}"', part, count=1)  # noqa: B023
                    else:
                        parts[n] = re.sub(word, lambda m: f'<a href="{address}">{m[0]}</a>', part, flags=re.IGNORECASE)  # noqa: B023
                p.html = "".join(parts)
        return items

    return run
