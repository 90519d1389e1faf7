"""Ordered text, search and references over documents and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexlake.catalog import query, table
from codexlake.operators import html, segment, text

KINDS = {"bracket": r"\((\d+)\)", "mail": r"([A-Za-z0-9._]+@[A-Za-z0-9.]+)", "licence": r"(Apache|MIT|GPL|BSD|MPL)"}


@query(r"""
WITH k(kind, p) AS (VALUES ('bracket', '\((\d+)\)'), ('mail', '([A-Za-z0-9._]+@[A-Za-z0-9.]+)'), ('licence', '(Apache|MIT|GPL|BSD|MPL)'))
SELECT doc_id, kind, unnest(regexp_extract_all(text, p, 1)) AS value FROM documents, k
""")
def cross_reference_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.references(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"], "text", KINDS)


_BODY = r"""'###### Margin ' || (p_partkey % 7)::VARCHAR || chr(10) || chr(10) || '[⟨§ ' || (p_partkey % 90 + 1)::VARCHAR || ' a.⟩](https://e.org/x.html#seq-0-prov-1) ' || p_name || chr(10) || chr(10) || p_type || chr(10) || '## Part' || chr(10) || 'dropped ' || p_brand || chr(10) || '[⟨Art. ' || p_size::VARCHAR || 'b⟩](u) ' || p_brand || chr(10) || '###### not a margin'"""


@query(f"""
WITH b AS (SELECT p_partkey, p_name, p_type, p_brand, p_size, p_partkey % 7 AS m, p_partkey % 90 + 1 AS n FROM part)
SELECT p_partkey, 1::INT AS sequence, 'section' AS type, n::VARCHAR || 'a' AS number,
  trim('###### Margin ' || m::VARCHAR || chr(10) || chr(10) || '[⟨§ ' || n::VARCHAR || ' a.⟩](https://e.org/x.html#seq-0-prov-1) ' || p_name || chr(10) || chr(10) || p_type) AS text FROM b
UNION ALL SELECT p_partkey, 2::INT, 'article', p_size::VARCHAR || 'b', '[⟨Art. ' || p_size::VARCHAR || 'b⟩](u) ' || p_brand FROM b
""")
def segment_provisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisions of a Markdown body made from every part."""
    key, nl = F.col("p_partkey"), F.lit("\n")
    body = F.concat(
        F.lit("###### Margin "), (key % 7).cast("string"), nl, nl, F.lit("[⟨§ "), (key % 90 + 1).cast("string"), F.lit(" a.⟩](https://e.org/x.html#seq-0-prov-1) "), F.col("p_name"), nl, nl,
        F.col("p_type"), nl, F.lit("## Part"), nl, F.lit("dropped "), F.col("p_brand"), nl, F.lit("[⟨Art. "), F.col("p_size").cast("string"), F.lit("b⟩](u) "), F.col("p_brand"), nl, F.lit("###### not a margin"),
    )
    return segment.provisions(table(spark, sf_dir, "part").select("p_partkey", body.alias("body")), ["p_partkey"], "body")


@query("""
WITH f AS (SELECT *, CASE WHEN role = 'user' THEN text END AS heading FROM conversations)
SELECT conv_id, turn, role, md5(last_value(heading IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS heading_md5 FROM f
""")
def carry_forward_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    out = segment.carry_forward(c, ["conv_id"], ["turn", "role", "text"], F.col("text"), F.col("role") == "user", "heading")
    return out.select("conv_id", "turn", "role", F.md5("heading").alias("heading_md5"))


@query("""
SELECT conv_id, turn, role, md5(text) AS text_md5, 'seq-' || (row_number() OVER (PARTITION BY conv_id, role ORDER BY turn, text) - 1)::VARCHAR || '-prov-' || role AS anchor FROM conversations
""")
def sequence_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = segment.occurrence(table(spark, sf_dir, "conversations"), ["conv_id", "role"], ["turn", "text"])
    return out.select("conv_id", "turn", "role", F.md5("text").alias("text_md5"), F.concat(F.lit("seq-"), F.col("seq").cast("string"), F.lit("-prov-"), F.col("role")).alias("anchor"))


@query("""
WITH g AS (SELECT *, count(CASE WHEN role = 'user' THEN 1 END) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS g FROM conversations)
SELECT conv_id, g::INT AS position, min(turn) AS first_turn, count(*) AS n_lines, sum(length(text))::BIGINT AS n_chars FROM g WHERE g > 0 GROUP BY conv_id, g
""")
def conversation_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments that a user's turn opens; what comes before the first is dropped."""
    lines = table(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", "role", "text").alias("place"), F.when(F.col("role") == "user", F.col("turn")).alias("number"), "text")
    merged = segment.merge_continuations(lines, ["conv_id"], "place", F.col("number"), "text")
    # The texts are joined by single spaces, one fewer than there are lines.
    return merged.select("conv_id", "position", F.col("number").alias("first_turn"), F.col("n_lines"), (F.length("text") - F.col("n_lines") + 1).cast("long").alias("n_chars"))


QUERY_TERMS = ["the", "que", "und", "les"]


@query("""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM documents),
i AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN ('the', 'que', 'und', 'les') GROUP BY doc_id, term),
d AS (SELECT term, count(*) AS df FROM i GROUP BY term), n AS (SELECT count(*) AS n FROM documents)
SELECT doc_id, round(sum(tf * ln((n + 1.0) / (df + 1.0))), 6) AS score, count(*) AS n_terms FROM i JOIN d USING (term), n GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 20
""")
def tfidf_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return text.tfidf(text.terms(docs, "doc_id", "text"), docs.count(), QUERY_TERMS, "doc_id", 20)


@query("""
SELECT 'lang' AS facet, lang AS value, count(*) AS n_all, count(*) FILTER (contains(lower(text), 'tion') AND n_chars > 1000) AS n_chosen FROM documents GROUP BY lang
UNION ALL SELECT 'source', source, count(*), count(*) FILTER (contains(lower(text), 'tion') AND n_chars > 1000) FROM documents GROUP BY source
""")
def search_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return text.facets(docs, ["lang", "source"], F.lower("text").contains("tion") & (F.col("n_chars") > 1000))


@query("""
SELECT sha256(text) AS hash, count(DISTINCT doc_id) AS n_versions, min(doc_id) AS first_version, max(doc_id) AS last_version FROM documents GROUP BY sha256(text)
""")
def unique_tables_across_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from codexlake.operators import tables

    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("hash"), F.lit(1).alias("one"))
    return tables.unique_tables(docs, ["one"], "hash", "doc_id").drop("one")


_BARE = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<script.*?</script>', '', 'g'), '(?is)<style.*?</style>', '', 'g'), '(?is)<title.*?</title>', '', 'g'), '(?s)<!--.*?-->|<![^>]*>', '', 'g')"""
_BLOCKS = "</?(?:p|div|li|ul|ol|table|tr|h[1-6]|article|section|nav|footer|header|br|hr|body|main|blockquote|dl|dt|dd)(?:\\s[^>]*)?/?>"


def _plain(x: str) -> str:
    """SQL for text with the entities of the pages resolved and white space squeezed."""
    for entity, character in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">")):
        x = f"replace({x}, '&{entity};', '{character}')"
    return f"trim(regexp_replace(regexp_replace({x}, '&amp;?', '&', 'g'), '\\s+', ' ', 'g'))"


@query(rf"""
WITH a AS (SELECT page_id, regexp_replace(regexp_replace({_BARE}, '(?is)<nav.*?</nav>|<footer.*?</footer>', chr(1), 'g'), '(?i)<(h[1-6])(?:\s[^>]*)?>', chr(1) || '\1' || chr(2), 'g') AS h FROM pages),
b AS (SELECT page_id, string_split(regexp_replace(regexp_replace(regexp_replace(h, '(?i)<li(?:\s[^>]*)?>', chr(1) || '- ', 'g'), '(?i){_BLOCKS}', chr(1), 'g'), '<[^>]*>', '', 'g'), chr(1)) AS parts FROM a),
c AS (SELECT page_id, list_transform(parts, lambda x: CASE WHEN contains(x, chr(2)) THEN repeat('#', least(substr(x, 2, 1)::INT, 5)) || ' ' || {_plain("split_part(x, chr(2), 2)")} ELSE {_plain("x")} END) AS lines FROM b)
SELECT page_id, array_to_string(list_filter(lines, lambda x: trim(x, '# -') <> ''), chr(10) || chr(10)) AS markdown FROM c
""")
def html_to_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.to_markdown(table(spark, sf_dir, "pages").select("page_id", "html"), "page_id", "html")


@query(rf"""
SELECT page_id, {_plain(f"regexp_replace(regexp_replace({_BARE}, '(?i){_BLOCKS}', ' ', 'g'), '<[^>]*>', '', 'g')")} AS text FROM pages
""")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.visible_text(table(spark, sf_dir, "pages").select("page_id", "html"), "page_id", "html")


@query(rf"""
WITH a AS (SELECT page_id, url, regexp_extract_all(coalesce(html, ''), '<a href="([^"]+)">([^<]*)</a>', 1) AS refs, regexp_extract_all(coalesce(html, ''), '<a href="([^"]+)">([^<]*)</a>', 2) AS texts FROM pages),
b AS (SELECT page_id, url, unnest(range(len(refs))) AS n, refs, texts FROM a),
c AS (SELECT page_id, n::INT AS position, {_plain("refs[n + 1]")} AS href, {_plain("texts[n + 1]")} AS text, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS root, regexp_extract(url, '^([^#]*)', 1) AS page FROM b),
d AS (SELECT *, CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href WHEN starts_with(href, '/') THEN root || href WHEN starts_with(href, '#') THEN page || href ELSE root || '/' || href END AS absolute FROM c)
SELECT page_id, position, href, text, absolute, NOT starts_with(absolute, root) AS external FROM d
""")
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.links(table(spark, sf_dir, "pages").select("page_id", "url", "html"), "page_id", "html", "url")


@query(r"""
WITH t AS (SELECT page_id, unnest(regexp_extract_all(regexp_replace(html, '(?is)<script.*?</script>', '<script>', 'g'), '<([a-z][a-z0-9]*)', 1)) AS tag FROM pages)
SELECT page_id, tag, count(*) AS n FROM t GROUP BY page_id, tag
""")
def html_tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.tag_counts(table(spark, sf_dir, "pages").select("page_id", "html"), "page_id", "html")


@query()
def html_diff_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-level differences between each page and the next of its host.

    Only ids go through the window; the pages are joined to the pairs afterwards, so
    a host with very many pages sorts numbers and not their text.
    """
    from pyspark.sql import Window

    pages = table(spark, sf_dir, "pages")
    ids = pages.select("page_id", F.regexp_extract("url", "://([^/?#]*)", 1).alias("host"))
    pairs = ids.withColumn("next_id", F.lead("page_id").over(Window.partitionBy("host").orderBy("page_id"))).where("next_id is not null").drop("host")
    pairs = pairs.join(pages.select("page_id", "html"), "page_id").join(pages.select(F.col("page_id").alias("next_id"), F.col("html").alias("next_html")), "next_id")
    return html.diff(pairs, ["page_id", "next_id"], "html", "next_html")


@query(r"""
SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages
""")
def html_link_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.links(table(spark, sf_dir, "pages").select("page_id", "url", "html"), "page_id", "html", "url").select("page_id", "href")
