"""Layout rules over events and lines: a user or an order is a document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexlake.catalog import query, table
from codexlake.operators import layout


def _elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as boxes: the value is the left edge, the second of the day the height."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value", "event_type")
    y = F.pmod(F.col("event_id") * 37, F.lit(842)).cast("double")
    return e.select(
        F.col("user_id").alias("doc"), F.col("event_id").alias("pos"), (F.col("event_id") % 3).cast("int").alias("page"), F.round("value", 2).alias("x0"), y.alias("y0"),
        (F.round("value", 2) + 20).alias("x1"), (y + 10).alias("y1"), F.col("event_type").alias("text"), F.lit(842.0).alias("height"),
        (F.col("event_id") % 7 + 6).cast("double").alias("size"), (F.col("event_id") % 4 * 200).cast("double").alias("weight"),
    )


@query("""
SELECT user_id AS doc, event_id AS pos FROM events
WHERE NOT ((event_id * 37 % 842 + 10) <= 21 * 2.83465 OR (event_id * 37 % 842) >= 842 - 21 * 2.83465)
""")
def header_footer_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.body_only(_elements(spark, sf_dir), "height").select("doc", "pos")


@query("""
SELECT user_id AS doc, event_id AS pos, (event_id % 7 + 6) < 0.7 * avg((event_id % 7 + 6)::DOUBLE) OVER (PARTITION BY user_id) AS is_small FROM events
""")
def small_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.fractions(_elements(spark, sf_dir), "doc").select("doc", "pos", "is_small")


_VARIANTS = "v AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY weight DESC, size DESC)::INT AS level FROM (SELECT DISTINCT user_id AS doc, (event_id % 4 * 200)::DOUBLE AS weight, (event_id % 7 + 6)::DOUBLE AS size FROM events WHERE event_id % 4 * 200 > 400))"


@query(f"WITH {_VARIANTS} SELECT * FROM v")
def font_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.font_variants(_elements(spark, sf_dir), "doc")


@query(f"""
WITH {_VARIANTS}
SELECT e.user_id AS doc, event_id AS pos, coalesce(min(level), 0)::INT AS level FROM events e LEFT JOIN v ON v.doc = e.user_id AND v.weight = e.event_id % 4 * 200 AND v.size >= e.event_id % 7 + 6 GROUP BY ALL
""")
def heading_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _elements(spark, sf_dir)
    return layout.heading_level(e, layout.font_variants(e, "doc"), "doc").select("doc", "pos", F.coalesce("level", F.lit(0)).alias("level"))


@query("""
WITH e AS (SELECT user_id || '/' || event_id % 3 AS doc, event_id, (event_id * 37 % 842)::DOUBLE AS y, round(value, 2) AS x, event_type AS text FROM events),
c AS (SELECT *, unnest([floor(y / 5) - 1, floor(y / 5), floor(y / 5) + 1]) AS cell FROM (SELECT DISTINCT doc, y FROM e))
SELECT c.doc, c.y, string_agg(b.text, '|' ORDER BY b.x, b.event_id) AS row FROM c JOIN e b ON c.doc = b.doc AND c.cell = floor(b.y / 5) AND abs(c.y - b.y) <= 5 GROUP BY c.doc, c.y
""")
def grid_by_height(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each page of each document."""
    pages = _elements(spark, sf_dir).withColumn("doc", F.concat_ws("/", F.col("doc").cast("string"), F.col("page").cast("string")))
    rows = layout.rows_by_height(pages, "doc")
    return rows.select("doc", "y", F.array_join("row", "|").alias("row"))


@query("""
WITH k AS (SELECT conv_id, turn, role, text, CASE role WHEN 'user' THEN 'letter' WHEN 'assistant' THEN 'number' END AS kind FROM conversations),
o AS (SELECT *, CASE WHEN kind IS NULL OR lag(kind) OVER w IS NULL THEN 1 ELSE 0 END AS o FROM k WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
g AS (SELECT *, sum(o) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS g FROM o)
SELECT conv_id, turn, role, md5(text) AS text_md5, CASE WHEN kind IS NULL THEN 0 WHEN kind = first_value(kind) OVER (PARTITION BY conv_id, g ORDER BY turn, role, text) THEN 1 ELSE 2 END::INT AS enum_level FROM g
""")
def enumeration_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").withColumn("kind", F.when(F.col("role") == "user", "letter").when(F.col("role") == "assistant", "number"))
    out = layout.enumeration_levels(c, ["conv_id"], ["turn", "role", "text"], "kind")
    return out.select("conv_id", "turn", "role", F.md5("text").alias("text_md5"), F.coalesce("enum_level", F.lit(0)).alias("enum_level"))


@query("""
WITH RECURSIVE e AS (
  SELECT user_id AS doc, (event_id % 3)::INT AS page, event_id AS pos, (event_id * 37 % 842)::DOUBLE AS y, row_number() OVER (PARTITION BY user_id, event_id % 3 ORDER BY event_id) AS k FROM events),
f(doc, page, k, pos, spans, place) AS (
  SELECT DISTINCT doc, page, 0::BIGINT, NULL::BIGINT, []::STRUCT(t DOUBLE, b DOUBLE)[], 0::BIGINT FROM e
  UNION ALL
  SELECT doc, page, k, pos, CASE WHEN place > len(spans) THEN list_append(spans, {'t': y, 'b': y + 10}) ELSE list_concat(list_slice(spans, 1, place - 1), [{'t': least(spans[place].t, y), 'b': greatest(spans[place].b, y + 10)}], list_slice(spans, place + 1, len(spans))) END, place
  FROM (SELECT e.doc, e.page, e.k, e.pos, e.y, f.spans, coalesce(list_position(list_transform(f.spans, lambda s: abs((s.t + s.b) / 2 - (e.y + 5)) <= 0.005 * 842), true), len(f.spans) + 1)::BIGINT AS place
        FROM f JOIN e ON e.doc = f.doc AND e.page = f.page AND e.k = f.k + 1)),
l AS (SELECT doc, page, arg_max(spans, k) AS spans FROM f GROUP BY doc, page),
n AS (SELECT doc, page, unnest(range(1, len(spans) + 1)) AS place, spans FROM l),
r AS (SELECT doc, page, place, row_number() OVER (PARTITION BY doc, page ORDER BY spans[place].t + spans[place].b, place)::INT AS line FROM n)
SELECT f.doc, f.pos, f.page, r.line FROM f JOIN r ON r.doc = f.doc AND r.page = f.page AND r.place = f.place WHERE f.k > 0
""")
def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements in lines, by greedy clustering; the SQL steps through each page."""
    return layout.sort_lines(_elements(spark, sf_dir), "doc", "height").select("doc", "pos", "page", "line")


@query("""
SELECT user_id AS doc, string_agg('<p>' || event_type || '</p>', chr(10) ORDER BY event_id) AS html FROM events GROUP BY user_id
""")
def elements_to_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = layout.demote_after_final(_elements(spark, sf_dir).withColumn("level", F.lit(None).cast("int")), "doc")
    return layout.to_html(tagged.withColumn("tag", layout.tag_of("text", "level", "after_last_final")), "doc")
