"""Positioned layout elements: reading order, roles, merges, tables by geometry.

Elements are rows of a document with a position ``pos``, a ``page``, a box
(``x0``, ``y0``, ``x1``, ``y1``, y downwards), ``text``, ``size`` and ``weight``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexlake.session import ship

#: Points in a millimetre, and the margins in millimetres.
POINTS_PER_MM, MARGIN_MM = 2.83465, 21
PROVISION = r"(?i)^(§\s*\d+\s*[a-z]?\s*\.|art\.\s*\d+\s*[a-z]?)"
FINAL = r"^Schlussbestimmung"


def flip(y0: Column, y1: Column, height: Column | None = None) -> Column:
    """struct<y0, y1> measured from the top; 595 points where no height is known."""
    h = F.coalesce(height, F.lit(595.0)) if height is not None else F.lit(595.0)
    return F.struct((h - y1).alias("y0"), (h - y0).alias("y1"))


def grow(box: Column, margin: float) -> Column:
    """A box array enlarged on all sides."""
    return F.array(box[0] - margin, box[1] - margin, box[2] + margin, box[3] + margin)


def vertical_span(chars: str, box: str) -> Column:
    """struct<top, bottom> of the characters' boxes, else of the element's."""
    has = F.size(F.coalesce(F.col(chars), F.array())) > 0
    edge = lambda k, pick: F.when(has, pick(F.transform(chars, lambda b: b[k]))).otherwise(F.col(box)[k])
    return F.struct(edge(1, F.array_min).alias("top"), edge(3, F.array_max).alias("bottom"))


def body_only(df: DataFrame, height: str) -> DataFrame:
    """Elements that do not lie wholly in the top or bottom margin."""
    m = MARGIN_MM * POINTS_PER_MM
    return df.where(~((F.col("y1") <= m) | (F.col("y0") >= F.col(height) - m)))


def sort_lines(df: DataFrame, doc: str, height: str, tolerance: float = 0.005) -> DataFrame:
    """Adds ``line``: reading order by lines of near equal mid-height, then by x.

    Lines grow greedily, in the order of the elements: one joins the first line
    whose span's middle is within the tolerance of its own middle, and widens that
    span.  Each choice rests on those before it, so a page is decided in one place;
    pages come sorted, and one at a time is held in memory.
    """
    names = df.columns
    at = {n: names.index(n) for n in (doc, "page", "pos", "y0", "y1", height)}
    schema = df.select("*", F.lit(0).alias("line")).schema

    def lines_of(top: list[float], bottom: list[float], slack: float) -> list[int]:
        spans: list[list[float]] = []
        chosen = []
        for a, b in zip(top, bottom, strict=True):
            line = next((n for n, (u, v) in enumerate(spans) if abs((u + v) / 2 - (a + b) / 2) <= slack), len(spans))
            if line == len(spans):
                spans.append([a, b])
            else:
                spans[line] = [min(spans[line][0], a), max(spans[line][1], b)]
            chosen.append(line)
        rank = {n: k for k, n in enumerate(sorted(range(len(spans)), key=lambda n: sum(spans[n])), 1)}
        return [rank[n] for n in chosen]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            keys = list(zip(now.column(at[doc]).to_pylist(), now.column(at["page"]).to_pylist(), strict=True))
            cuts = [0, *(n for n in range(1, len(keys)) if keys[n] != keys[n - 1])]
            for low, high in zip(cuts, cuts[1:], strict=False):
                yield from page(now.slice(low, high - low))
            held = now.slice(cuts[-1]) if len(keys) else None
        if held is not None:
            yield from page(held)

    def page(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        top, bottom = rows.column(at["y0"]).to_pylist(), rows.column(at["y1"]).to_pylist()
        number = pa.array(lines_of(top, bottom, tolerance * float(rows.column(at[height])[0].as_py())), pa.int32())
        yield from rows.append_column("line", number).combine_chunks().to_batches()

    ship(df.sparkSession)
    return df.repartition(doc, "page").sortWithinPartitions(doc, "page", "pos").mapInArrow(run, schema)


def fractions(df: DataFrame, doc: str, share: float = 0.7, fallback: float = 5.0) -> DataFrame:
    """Adds ``is_small``: text under 0.7 of the document's mean size."""
    limit = F.coalesce(F.avg("size").over(Window.partitionBy(doc)) * share, F.lit(fallback))
    return df.withColumn("is_small", F.coalesce(F.col("size") < limit, F.lit(False)))


def font_variants(df: DataFrame, doc: str, bold: float = 400) -> DataFrame:
    """(doc, weight, size, level): bold variants, heaviest and largest first."""
    order = Window.partitionBy(doc).orderBy(F.desc("weight"), F.desc("size"))
    return df.where(F.col("weight") > bold).select(doc, "weight", "size").distinct().withColumn("level", F.row_number().over(order))


def heading_level(df: DataFrame, variants: DataFrame, doc: str) -> DataFrame:
    """Adds ``level``: the first variant of equal weight that is not smaller; null if none."""
    v = variants.groupBy(doc, "weight").agg(F.array_sort(F.collect_list(F.struct(F.col("level").alias("l"), F.col("size").alias("s")))).alias("_v"))
    out = df.join(v, [doc, "weight"], "left")
    return out.withColumn("level", F.try_element_at(F.filter("_v", lambda x: F.col("size") <= x["s"]), F.lit(1))["l"]).drop("_v")


def demote_after_final(df: DataFrame, doc: str, text: str = "text") -> DataFrame:
    """Adds ``after_final`` and ``after_last_final``: place after the closing provisions."""
    w = Window.partitionBy(doc)
    at = F.when(F.col(text).rlike(FINAL), F.col("pos"))
    return df.withColumns({"after_final": F.coalesce(F.col("pos") > F.min(at).over(w), F.lit(False)), "after_last_final": F.coalesce(F.col("pos") > F.max(at).over(w), F.lit(False))})


def tag_of(text: str, level: str, after_last_final: str) -> Column:
    """The HTML tag of an element; late law headings become paragraphs."""
    t = F.trim(F.col(text))
    late = F.col(after_last_final) & F.lower(t).rlike("gesetz|verordnung") & F.lower(t).rlike(r"(?U)\bvom\b")
    return F.when(t.rlike(PROVISION) & (F.length(t) <= 20), "provision").when(F.col(level).isNotNull() & ~late, F.concat(F.lit("h"), F.least(F.col(level), F.lit(6)).cast("string"))).otherwise("p")


def enumerator(text: str) -> Column:
    """letter, roman, number or dash, for what opens an enumeration; else null."""
    t = F.trim(F.col(text))
    return F.when(t.rlike(r"^\d+[.)]"), "number").when(t.rlike(r"^(?:[ivx]{2,})[.)]"), "roman").when(t.rlike(r"^[a-zA-Z][.)]"), "letter").when(t.rlike(r"^[–-]\s"), "dash")


def enumeration_levels(df: DataFrame, key: list[str], order: list, kind: str) -> DataFrame:
    """Adds ``enum_level``: in a run, the kind that opens it is 1, any other 2."""
    w = Window.partitionBy(*key).orderBy(*order)
    run = df.withColumn("_run", F.sum(F.when(F.col(kind).isNull() | F.lag(kind).over(w).isNull(), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    first = F.first(kind).over(Window.partitionBy(*key, "_run").orderBy(*order))
    return run.withColumn("enum_level", F.when(F.col(kind).isNotNull(), F.when(F.col(kind) == first, 1).otherwise(2))).drop("_run")


def square_metres(df: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """Adds ``is_unit``: a lone 2 or 3 after a text that ends in ``m`` is no provision."""
    before = F.lag(text).over(Window.partitionBy(*key).orderBy("pos"))
    return df.withColumn("is_unit", F.coalesce(F.trim(F.col(text)).isin("2", "3") & F.trim(before).rlike(r"(?:^|\W|\d)[kcdm]?m$"), F.lit(False)))


def merge_rows(df: DataFrame, key: list[str], joins: Column, separator: Column | None = None, text: str = "text") -> DataFrame:
    """(key, pos, text): each row that ``joins`` goes to the row before it, in order."""
    w = Window.partitionBy(*key).orderBy("pos")
    groups = df.withColumn("_j", F.coalesce(joins, F.lit(False)) & (F.row_number().over(w) > 1)).withColumn("_s", separator if separator is not None else F.lit(""))
    groups = groups.withColumn("_g", F.sum(F.when(F.col("_j"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct("pos", F.when(F.col("_j"), F.concat("_s", text)).otherwise(F.col(text)).alias("t"))))
    return groups.groupBy(*key, "_g").agg(F.min("pos").alias("pos"), F.array_join(F.transform(parts, lambda x: x["t"]), "").alias(text)).drop("_g")


def split_provision(text: str) -> Column:
    """array: ``§ 12a. rest`` as its label and its rest; other text as one."""
    pattern, t = r"^(§ \d+[a-zA-Z]?\.)(.*)$", F.trim(F.col(text))
    label, rest = F.regexp_extract(t, pattern, 1), F.trim(F.regexp_extract(t, pattern, 2))
    return F.when(label != "", F.filter(F.array(label, rest), lambda x: x != "")).otherwise(F.array(text))


def cell_columns(cells: DataFrame, headers: DataFrame, table: str) -> DataFrame:
    """(table, cell_id, column_id): the header a cell overlaps most, by share of its
    width; without overlap the header of nearest centre. Ties go to the first header.

    A header row has some dozen columns, gathered to one array a table.
    """
    h = headers.groupBy(table).agg(F.array_sort(F.collect_list(F.struct(F.col("id").alias("i"), "x0", "x1"))).alias("_h"))
    width = F.greatest(F.col("x1") - F.col("x0"), F.lit(1e-9))
    rated = F.transform(
        "_h",
        lambda x: F.struct(
            (F.greatest(F.lit(0.0), F.least(F.col("x1"), x["x1"]) - F.greatest(F.col("x0"), x["x0"])) / width).alias("share"),
            (-F.abs((F.col("x0") + F.col("x1")) / 2 - (x["x0"] + x["x1"]) / 2)).alias("near"),
            (-x["i"]).alias("first"),
        ),
    )
    best = F.array_max(F.transform(rated, lambda x: F.struct(x["share"].alias("share"), F.when(F.array_max(F.transform(rated, lambda y: y["share"])) > 0, F.lit(0.0)).otherwise(x["near"]).alias("near"), x["first"].alias("first"))))
    return cells.join(h, table).select(table, F.col("id").alias("cell_id"), (-best["first"]).alias("column_id"))


def geometry_tables(cells: DataFrame, table: str, tolerance: float = 5.0) -> DataFrame:
    """(table, html) of positioned cells: id, x0, x1, y0 and text.

    Rows begin where a cell lies more than ``tolerance`` below the one before it, in
    order of height; the first row is the header, and the others' cells go to the
    header column that they overlap most.  Cells of one place are joined by spaces.
    """
    from codexlake.functions.scalar import xml_escape

    down = Window.partitionBy(table).orderBy("y0", "x0", "id")
    opens = F.when(F.col("y0") - F.lag("y0").over(down) <= tolerance, 0).otherwise(1)
    rows = cells.withColumn("_o", opens).withColumn("_row", F.sum("_o").over(down.rowsBetween(Window.unboundedPreceding, 0))).drop("_o")
    heads = rows.where("_row = 1")
    columns = heads.withColumn("_column", F.row_number().over(Window.partitionBy(table).orderBy("x0", "id")))
    placed = cell_columns(rows.where("_row > 1"), heads, table).withColumnRenamed("cell_id", "id")
    body = rows.join(placed, [table, "id"]).join(columns.select(table, F.col("id").alias("column_id"), "_column"), [table, "column_id"])
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y0", "x0", "id", "text"))), lambda x: x["text"]), " ")
    filled = body.groupBy(table, "_row", "_column").agg(xml_escape(text).alias("_text"))
    width = columns.groupBy(table).agg(F.max("_column").alias("_width"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_column", xml_escape("text").alias("t")))), lambda x: F.concat(F.lit("<th>"), x["t"], F.lit("</th>"))), "").alias("_head"))
    lines = filled.groupBy(table, "_row").agg(F.map_from_entries(F.collect_list(F.struct("_column", "_text"))).alias("_cells")).join(width, table)
    line = F.array_join(F.transform(F.sequence(F.lit(1), "_width"), lambda n: F.concat(F.lit("<td>"), F.coalesce(F.try_element_at("_cells", n), F.lit("")), F.lit("</td>"))), "")
    bodies = lines.withColumn("_line", F.concat(F.lit("<tr>"), line, F.lit("</tr>"))).groupBy(table).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_row", "_line"))), lambda x: x["_line"]), "").alias("_body"))
    whole = width.join(bodies, table, "left")
    body_html = F.coalesce(F.concat(F.lit("<tbody>"), F.col("_body"), F.lit("</tbody>")), F.lit(""))
    return whole.select(table, F.concat(F.lit("<table><thead><tr>"), F.col("_head"), F.lit("</tr></thead>"), body_html, F.lit("</table>")).alias("html"))


def rows_by_height(df: DataFrame, table: str, tolerance: float = 5.0) -> DataFrame:
    """(table, y, row): for each distinct height, the texts within ``tolerance``, by x.

    Heights meet elements by equality of table and cell of one tolerance's width.
    """
    cell = F.floor(F.col("y0") / tolerance)
    heights = df.select(table, F.col("y0").alias("y")).distinct().select(table, "y", F.explode(F.sequence(F.floor(F.col("y") / tolerance) - 1, F.floor(F.col("y") / tolerance) + 1)).alias("_cell"))
    met = heights.join(df.select(table, cell.alias("_cell"), "y0", "x0", "pos", "text"), [table, "_cell"]).where(F.abs(F.col("y0") - F.col("y")) <= tolerance)
    return met.groupBy(table, "y").agg(F.transform(F.array_sort(F.collect_list(F.struct("x0", "pos", "text"))), lambda x: x["text"]).alias("row"))


def table_of_path(elements: DataFrame, tables: DataFrame, doc: str) -> DataFrame:
    """Elements with the first table whose path is theirs or an ancestor of it.

    Every ancestor of a path is spelled out, so the prefix join is an equi-join.
    """
    steps = F.split("path", "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))
    up = elements.select(doc, "pos", F.explode(ancestors).alias("_path"))
    hits = up.join(tables.select(doc, F.col("path").alias("_path"), "table_id", F.col("pos").alias("_order")), [doc, "_path"]).groupBy(doc, "pos").agg(F.min_by("table_id", "_order").alias("table_id"))
    return elements.drop("table_id").join(hits, [doc, "pos"], "left")


def merge_like_tables(df: DataFrame, doc: str, header: str, body: str) -> DataFrame:
    """Neighbouring tables of equal header as one, bodies in order."""
    w = Window.partitionBy(doc).orderBy("pos")
    opens = F.when(F.lag(header).over(w).eqNullSafe(F.col(header)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    g = df.withColumn("_o", opens).withColumn("_g", F.sum("_o").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.col(body).alias("b")))), lambda x: x["b"]))
    return g.groupBy(doc, "_g").agg(F.min("pos").alias("pos"), F.min_by(header, "pos").alias(header), rows.alias(body)).drop("_g")


def to_html(df: DataFrame, doc: str, tag: str = "tag", text: str = "text") -> DataFrame:
    """(doc, html): elements as tags in order."""
    from codexlake.functions.scalar import xml_escape

    kind = F.when(F.col(tag) == "provision", F.lit('p class="provision"')).otherwise(F.col(tag))
    end = F.when(F.col(tag) == "provision", F.lit("p")).otherwise(F.col(tag))
    piece = F.concat(F.lit("<"), kind, F.lit(">"), xml_escape(text), F.lit("</"), end, F.lit(">"))
    return df.groupBy(doc).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", piece.alias("p")))), lambda x: x["p"]), "\n").alias("html"))


def flatten_kids(df: DataFrame, key: list[str], column: str) -> DataFrame:
    """(key, pos, path, text) of a JSON tree of elements with ``Kids``, parents first."""
    import json

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                *ids, tree = row
                stack, pos = list(reversed(json.loads(tree or "[]"))), 0
                while stack:
                    e = stack.pop()
                    out.append((*ids, pos, e.get("Path"), e.get("Text")))
                    pos += 1
                    stack += reversed(e.get("Kids") or [])
            yield pd.DataFrame(out, columns=[*key, "pos", "path", "text"])

    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in key)
    ship(df.sparkSession)
    return df.select(*key, column).mapInPandas(walk, f"{kinds}, pos int, path string, text string")


def headers_with_section(df: DataFrame, table: str, row: str, text: str = "text") -> DataFrame:
    """Where a table's first row holds a section sign, that row leaves the table and
    the rows below move up by one, so that the second becomes the header."""
    w = Window.partitionBy(table)
    has = F.coalesce(F.max(F.when((F.col(row) == 1) & F.col(text).contains("§"), 1)).over(w), F.lit(0)) == 1
    held = df.withColumn("_has", F.col(table).isNotNull() & has)
    out = held.withColumn(table, F.when(F.col("_has") & (F.col(row) == 1), F.lit(None)).otherwise(F.col(table)))
    return out.withColumn(row, F.when(F.col("_has"), F.when(F.col(row) > 1, F.col(row) - 1)).otherwise(F.col(row))).drop("_has")


def keeps_superscript(position: str, text: str = "text") -> Column:
    """A superscript of more than five letters is ordinary text."""
    return (F.col(position) == "Sup") & (F.length(F.regexp_replace(text, "[^a-zA-ZäöüÄÖÜß]", "")) <= 5)


def grid_elements(df: DataFrame, key: list[str], grid: str) -> DataFrame:
    """(key, path, text): a grid's cells as elements, the first row as header cells."""
    rows = df.select(*key, F.posexplode(grid).alias("_r", "_row"))
    cells = rows.select(*key, "_r", F.posexplode("_row").alias("_c", "text"))
    kind = F.when(F.col("_r") == 0, "TH").otherwise("TD")
    return cells.select(*key, F.concat(F.lit("/Table/TR["), F.col("_r") + 1, F.lit("]/"), kind, F.lit("["), F.col("_c") + 1, F.lit("]")).alias("path"), "text")


#: What may end with a dot before an enumerator that is none.
ABBREVIATIONS = ("bzw", "ca", "Dr", "Fr", "Nr", "resp", "usw", "vgl", "z.B", "inkl", "exkl")


def split_enumerators(text: str) -> Column:
    """array: before, mark and rest of the first letter or Roman enumerator in a text.

    An open bracket, an abbreviation or a provision's number before it, and a single
    capital, keep the text whole.
    """
    pattern = r"(?s)^(.+?)\s+([IVXLCDM]+|[a-zA-Z])([.)])\s+(.+)$"
    before, mark, end, after = (F.regexp_extract(text, pattern, n) for n in range(1, 5))
    named = "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS)
    kept = (mark == "") | (before.contains("(") & ~before.contains(")")) | before.rlike(rf"(?:{named})\s*$") | before.rlike(r"(?:§\s*|Art\.\s*|Artikel\s*)\d+[a-z]?\s*$") | mark.rlike("^[A-Z]$")
    parts = F.array(F.rtrim(before), F.concat(mark, end), F.ltrim(after))
    return F.when(F.coalesce(kept, F.lit(True)), F.array(text)).otherwise(F.filter(parts, lambda x: x != ""))


def split_notes(text: str) -> Column:
    """array: a note's text cut before each enumerator in it but one at its start."""
    pattern = r"(?U)(?<=\S)(\s*)(?<!\w)((?:[IVXLCDM]+|[ivxlcdm]+|[a-zA-Z]|\d+)[.)]\s+)"
    return F.transform(F.split(F.regexp_replace(F.col(text), pattern, "\u0000$2"), "\u0000"), lambda x: x)


def enumerator_parts(text: str) -> Column:
    """struct<mark, content> of a text that an enumerator opens; a null mark if none."""
    pattern = r"(?s)^\s*((?:[ivxIVX]+|[a-zA-Z]|\d+)(?:bis|ter|quater)?[.)]|[–-](?=\s))\s*(.*)$"
    mark = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    return F.struct(mark.alias("mark"), F.when(mark.isNotNull(), F.regexp_extract(text, pattern, 2)).otherwise(F.col(text)).alias("content"))


def annex(df: DataFrame, doc: str, footnotes: Column, text: str = "text") -> DataFrame:
    """Adds ``in_annex``: from the first annex heading to the first footnote after it."""
    w = Window.partitionBy(doc)
    start = F.min(F.when(F.lower(F.trim(F.col(text))).rlike(r"(?U)^(anhang|anhänge|verzeichnis)\b"), F.col("pos"))).over(w)
    placed = df.withColumn("_start", start)
    end = F.min(F.when(footnotes & (F.col("pos") > F.col("_start")), F.col("pos"))).over(w)
    return placed.withColumn("_end", end).withColumn("in_annex", F.coalesce((F.col("pos") >= F.col("_start")) & (F.col("_end").isNull() | (F.col("pos") < F.col("_end"))), F.lit(False))).drop("_start", "_end")


def article_label(text: str) -> Column:
    """struct<label, rest> of a text that begins ``Art. n``; a null label if none."""
    pattern = r"(?s)^\s*(Art\.\s*\d+[a-z]*(?:\s*(?:bis|ter|quater)\b)?)\s*(.*)$"
    label = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    return F.struct(label.alias("label"), F.when(label.isNotNull(), F.regexp_extract(text, pattern, 2)).otherwise(F.col(text)).alias("rest"))


def prepared(elements: DataFrame, tables: DataFrame, heights: DataFrame, doc: str) -> DataFrame:
    """Raw elements as those that a page is made of, by all the rules of layout in order.

    ``elements`` has doc, pos, page, path, row, text, x0, y0, x1, y1 (upwards), size,
    weight and position; ``tables`` doc, pos, path and table_id; ``heights`` doc, page
    and height.  Tables are mapped and their headers with section signs taken out,
    empty text dropped, boxes turned downwards, lines put in reading order, margins
    removed, and units, raised text and small text marked.
    """
    placed = table_of_path(elements, tables, doc)
    placed = headers_with_section(placed, "table_id", "row").where("text is not null and text <> ''")
    placed = placed.join(heights.select(doc, "page", "height"), [doc, "page"], "left")
    box = flip(F.col("y0"), F.col("y1"), F.col("height"))
    placed = placed.withColumn("_box", box).withColumns({"y0": F.col("_box.y0"), "y1": F.col("_box.y1"), "height": F.coalesce("height", F.lit(595.0))}).drop("_box")
    lines = sort_lines(placed, doc, "height")
    order = Window.partitionBy(doc).orderBy("page", "line", "x0", "pos")
    read = body_only(lines.withColumn("pos", F.row_number().over(order) - 1), "height")
    marked = fractions(square_metres(demote_after_final(read, doc), [doc]), doc)
    # After the closing provisions bold text is plain.
    return marked.withColumns({"weight": F.when(F.col("after_final") & (F.col("weight") > 400) & (F.col("size") <= 9.2), F.lit(400.0)).otherwise(F.col("weight")), "is_raised": keeps_superscript("position")})


def as_paragraphs(elements: DataFrame, doc: str) -> DataFrame:
    """(doc, items): a document's elements in order as the paragraphs that passes take, weights as sizes."""
    from codexlake.operators.passes import PARAGRAPHS

    one = F.struct(F.lit("p").alias("tag"), F.array().cast("array<string>").alias("cls"), F.col("pos").cast("string").alias("id"), F.col("text").alias("html"), F.col("weight").cast("double").alias("size"))
    rows = F.array_sort(F.collect_list(F.struct("pos", one.alias("e"))))
    return elements.groupBy(doc).agg(F.transform(rows, lambda x: x["e"]).cast(PARAGRAPHS).alias("items"))
