"""Search over text: inverted index, facets, ranked look-ups, excerpts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+"


def terms(df: DataFrame, key: str, text: str, pattern: str = WORD) -> DataFrame:
    """(key, term, tf): the inverted index."""
    return df.select(key, F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(f"({pattern})"), F.lit(1))).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))


def tfidf(index: DataFrame, n_docs: int, query: list[str], key: str, top: int) -> DataFrame:
    """The ``top`` documents by summed tf-idf of the query's terms.

    Only the query's postings are read for the score.
    """
    hits = index.where(F.col("term").isin(query))
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    score = F.round(F.sum(F.col("tf") * F.log((F.lit(n_docs) + 1.0) / (F.col("df") + 1.0))), 6)
    return hits.join(df, "term").groupBy(key).agg(score.alias("score"), F.count("*").alias("n_terms")).orderBy(F.desc("score"), key).limit(top)


def facets(df: DataFrame, names: list[str], chosen: Column) -> DataFrame:
    """(facet, value, n_all, n_chosen): counts without and with the active filter."""
    parts = [df.groupBy(F.col(n).cast("string").alias("value")).agg(F.count("*").alias("n_all"), F.count_if(F.coalesce(chosen, F.lit(False))).alias("n_chosen")).withColumn("facet", F.lit(n)) for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("facet", "value", "n_all", "n_chosen")


def autocomplete(df: DataFrame, query: str, fields: list[str], short: str, tie: list[str], top: int = 15) -> DataFrame:
    """Rows that contain the query in any field: exact short name, its beginning, the rest."""
    q = query.lower()
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    hit = F.lit(False)
    for f in fields:
        hit = hit | low(f).contains(q)
    rank = F.when(low(short) == q, 0).when(low(short).startswith(q), 1).otherwise(2)
    return df.where(hit).withColumn("match_rank", rank).orderBy("match_rank", *tie).limit(top)


def excerpt(text: str, word: str, before: int = 10, length: int = 20) -> Column:
    """``length`` words around the first that contains ``word``; else the first words."""
    words = F.filter(F.split(F.regexp_replace(F.col(text), r"\[\d+\]", ""), r"\s+"), lambda w: w != "")
    hits = F.filter(F.transform(words, lambda w, i: F.when(F.lower(w).contains(word.lower()), i)), lambda i: i.isNotNull())
    at = F.greatest(F.coalesce(F.try_element_at(hits, F.lit(1)), F.lit(0)) - before, F.lit(0))
    return F.array_join(F.slice(words, at + 1, F.lit(length)), " ")
