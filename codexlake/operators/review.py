"""Table reviews: statuses, work for the editor, its answers, and what a law's tables come to.

Corrections are rows (law, version, hash, status, corrected), tables rows (law,
version, hash, grid, page, pdf, source); ``law`` and ``hash`` join them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DONE = ("confirmed_without_changes", "confirmed_with_changes", "rejected")
_OPERATIONS = {"confirmed_without_changes": "confirm", "confirmed_with_changes": "edit", "rejected": "reject"}


def file_status(status: Column, readable: Column) -> Column:
    """A correction file's state: ``error`` if it cannot be read, ``not_started`` if there is none."""
    return F.when(~F.coalesce(readable, F.lit(True)), "error").otherwise(F.coalesce(status, F.lit("not_started")))


def is_completed(status: Column) -> Column:
    return F.coalesce(status == "completed", F.lit(False))


def editor_tables(tables: DataFrame, corrections: DataFrame, re_review: bool) -> DataFrame:
    """``tables`` with status, operation, corrected grid and whether the editor shows them.

    A new or undefined table is pending, to be confirmed; any other keeps its status.
    Unless everything is reviewed again, decided and merged tables are not shown.
    """
    known = corrections.select("law", "hash", F.col("status").alias("_s"), "corrected")
    out = tables.join(known, ["law", "hash"], "left")
    s = F.coalesce("_s", F.lit("undefined"))
    decided = s.isin(*DONE) | s.startswith("merged")
    operation = F.when(s.startswith("merged"), "merge")
    for status, name in _OPERATIONS.items():
        operation = operation.when(s == status, name)
    return out.select(
        *tables.columns, F.when(s == "undefined", "pending").otherwise(s).alias("status"), operation.otherwise("confirm").alias("operation"), "corrected",
        (F.lit(re_review) | ~decided).alias("shown"),
    )


def editor_counts(shown: DataFrame) -> DataFrame:
    """(law, total, to_review, reviewed) of ``editor_tables``."""
    return shown.groupBy("law").agg(F.count("*").alias("total"), F.count_if("shown").alias("to_review"), F.count_if(~F.col("shown")).alias("reviewed"))


def versioned_tables(tables: DataFrame, corrections: DataFrame, re_review: bool) -> DataFrame:
    """One version's tables in the editor's older form: maps by version, and a status.

    Decided tables are left out unless everything is reviewed again.
    """
    known = corrections.select("law", "hash", F.col("status").alias("_s"), "corrected")
    out = tables.join(known, ["law", "hash"], "left")
    s = F.coalesce("_s", F.lit("undefined"))
    if not re_review:
        out = out.where(s == "undefined")
    by = lambda c: F.create_map("version", c)
    return out.select(
        "law", "hash", F.array("version").alias("found_in_versions"), by("page").alias("pages"), by("pdf").alias("pdf_paths"), by("source").alias("source_links"),
        F.col("grid").alias("original"), s.alias("status"), F.when(F.lit(re_review), F.col("corrected")).alias("corrected"),
    )


def editor_answers(answers: DataFrame, column: str) -> DataFrame:
    """(hash, status, entry) of a JSON object of tables; entries without a status are dropped."""
    parsed = answers.select(*(c for c in answers.columns if c != column), F.explode(F.from_json(column, "map<string,string>")).alias("hash", "entry"))
    return parsed.withColumn("status", F.get_json_object("entry", "$.status")).where("status is not null")


def simulated_answers(tables: DataFrame) -> DataFrame:
    """An editor that confirms every table with rows and rejects empty ones."""
    has = F.size("grid") > 0
    return tables.select("law", "hash", F.when(has, "confirmed").otherwise("rejected").alias("status"), F.when(has, F.col("grid")).alias("corrected"), F.when(~has, "Empty table structure").alias("reason"))


def law_metrics(corrections: DataFrame, seconds: int = 30) -> DataFrame:
    """(law, tables, confirmed, rejected, edited, merged, errors, seconds, hashes): the older statuses counted.

    Any other status is an error; a table is estimated at ``seconds`` of work.
    """
    words = ("confirmed", "rejected", "edited", "merged")
    return corrections.groupBy("law").agg(
        F.count("*").alias("tables"), *(F.count_if(F.col("status") == w).alias(w) for w in words), F.count_if(F.coalesce(~F.col("status").isin(*words), F.lit(True))).alias("errors"),
        (F.count("*") * seconds).alias("seconds"), F.sort_array(F.collect_list("hash")).alias("hashes"),
    )


def older_applied(tables: DataFrame, corrections: DataFrame) -> DataFrame:
    """Grids by the three older statuses: confirmed as it is, edited as corrected, rejected gone; merges stay as they are."""
    known = corrections.select("law", "hash", F.col("status").alias("_s"), F.col("corrected").alias("_c"))
    out = tables.join(known, ["law", "hash"], "left").where("_s is null or _s <> 'rejected'")
    return out.withColumn("grid", F.when((F.col("_s") == "edited") & F.col("_c").isNotNull(), F.col("_c")).otherwise(F.col("grid"))).drop("_s", "_c")


def seeded(tables: DataFrame, corrections: DataFrame) -> DataFrame:
    """(law, version, tables): new rows of status ``undefined`` that versions without a file would get."""
    new = tables.join(corrections.select("law", "version").distinct(), ["law", "version"], "left_anti")
    return new.groupBy("law", "version").agg(F.count_distinct("hash").alias("tables"))


def regenerated(corrections: DataFrame, tables: DataFrame, laws: DataFrame | None = None) -> DataFrame:
    """Corrections after those of some laws (or all) are deleted and seeded again from their tables."""
    chosen = tables if laws is None else tables.join(laws.select("law").distinct(), "law", "left_semi")
    kept = corrections.limit(0) if laws is None else corrections.join(laws.select("law").distinct(), "law", "left_anti")
    empty = F.lit(None).cast(corrections.schema["corrected"].dataType)
    fresh = chosen.select("law", "version", "hash").distinct().select("law", "version", "hash", F.lit("undefined").alias("status"), empty.alias("corrected"))
    return kept.select("law", "version", "hash", "status", "corrected").unionByName(fresh)


def repeal(versions: DataFrame, repeals: DataFrame, latest_only: bool = False) -> DataFrame:
    """``versions`` (law, version, repealed) with the repeal dates of ``repeals`` (law, repealed).

    All versions of a law get its date, or its latest one alone; ``changed`` says where
    that altered a row.
    """
    out = versions.join(repeals.select("law", F.col("repealed").alias("_r")), "law", "left")
    new = F.col("_r")
    if latest_only:
        last = versions.groupBy("law").agg(F.max("version").alias("_last"))
        out = out.join(last, "law")
        new = F.when(F.col("version") == F.col("_last"), F.col("_r"))
    value = F.coalesce(new, F.col("repealed"))
    return out.withColumn("changed", ~value.eqNullSafe(F.col("repealed"))).withColumn("repealed", value).select(*versions.columns, "changed")


def updated_laws(changed: DataFrame) -> DataFrame:
    """The laws in which anything changed."""
    return changed.where("changed").select("law").distinct()


def verified_copy(original: DataFrame, copy: DataFrame) -> DataFrame:
    """(rows, missing, added) of an exported table against its original; copies of rows count."""
    left, right = original.select(F.lit(1).alias("a"), F.lit(0).alias("b"), *original.columns), copy.select(F.lit(0).alias("a"), F.lit(1).alias("b"), *original.columns)
    sides = left.unionByName(right).groupBy(*original.columns).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return sides.agg(F.sum("a").alias("rows"), F.sum(F.greatest(F.col("a") - F.col("b"), F.lit(0))).alias("missing"), F.sum(F.greatest(F.col("b") - F.col("a"), F.lit(0))).alias("added"))


def in_batches(items: DataFrame, key: list[str], order: str, size: int, result: Column, error: Column) -> DataFrame:
    """Items with their batch of ``size`` within a key, and a result or an error each: one failure stops nothing."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(order))
    out = items.withColumn("batch", F.floor((place - 1) / size).cast("int")).withColumn("result", result)
    return out.withColumn("error", F.when(F.col("result").isNull(), error))
