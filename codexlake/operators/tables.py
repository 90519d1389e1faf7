"""Tables in documents: grids, content hashes, corrections and their review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexlake.functions.scalar import review_status

ROW, CELL = r"/TR(?:\[(\d+)\])?", r"/T[HD](?:\[(\d+)\])?"


def path_index(path: str, pattern: str) -> Column:
    """The index in a path, 1 where it has none; null without such a step."""
    return F.when(F.col(path).rlike(pattern), F.coalesce(F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")).cast("int"), F.lit(1)))


def grid(df: DataFrame, key: list[str], row: Column, cell: Column, pos: str, text: str) -> DataFrame:
    """(key, grid): a dense rectangle; texts of one cell joined by spaces, gaps ''."""
    cells = df.select(*key, row.alias("_r"), cell.alias("_c"), F.col(pos).alias("_p"), F.trim(F.col(text)).alias("_t")).where("_r is not null and _c is not null")
    cells = cells.repartition(*key)  # one shuffle serves the three groupings below
    parts = F.array_sort(F.collect_list(F.when(F.col("_t") != "", F.struct("_p", "_t"))))
    one = cells.groupBy(*key, "_r", "_c").agg(F.array_join(F.transform(parts, lambda x: x["_t"]), " ").alias("_t"))
    # A row's cells by column with the gaps filled, then a table's rows with the gaps filled: each is passed once.
    blank = lambda n: F.array_repeat(F.lit(""), F.greatest(n, F.lit(0)).cast("int"))
    before = lambda xs, i, c: F.coalesce(F.try_element_at(xs, F.when(i > 0, i).cast("int"))[c], F.lit(0))
    row_cells = F.array_sort(F.collect_list(F.struct(F.col("_c").alias("c"), F.col("_t").alias("t"))))
    rows = one.groupBy(*key, "_r").agg(row_cells.alias("_cells"), F.max("_c").alias("_w"))
    rows = rows.withColumn("_row", F.flatten(F.transform("_cells", lambda x, i: F.concat(blank(x["c"] - before(F.col("_cells"), i, "c") - 1), F.array(x["t"])))))
    whole = rows.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.col("_r").alias("r"), F.col("_row").alias("t")))).alias("_rows"), F.max("_w").alias("_nc"))
    full = lambda cells: F.concat(cells, blank(F.col("_nc") - F.size(cells)))
    gap = lambda x, i: F.array_repeat(blank(F.col("_nc")), F.greatest(x["r"] - before(F.col("_rows"), i, "r") - 1, F.lit(0)).cast("int"))
    return whole.select(*key, F.flatten(F.transform("_rows", lambda x, i: F.concat(gap(x, i), F.array(full(x["t"]))))).alias("grid"))


def rectangular(grid_col: str) -> Column:
    """Not empty, and all rows of one length."""
    return (F.size(grid_col) > 0) & (F.size(F.array_distinct(F.transform(grid_col, lambda r: F.size(r)))) == 1)


def content_hash(df: DataFrame, key: list[str], path: str, pos: str, text: str) -> DataFrame:
    """(key, hash): 16 hex digits of SHA-256 over the non-blank texts, by path as text."""
    t = F.trim(F.col(text))
    rows = F.array_sort(F.collect_list(F.when(t != "", F.struct(F.col(path).alias("a"), F.col(pos).alias("b"), t.alias("t")))))
    return df.groupBy(*key).agg(F.substring(F.sha2(F.array_join(F.transform(rows, lambda x: x["t"]), "|"), 256), 1, 16).alias("hash"))


def unique_tables(df: DataFrame, key: list[str], digest: str, version: str) -> DataFrame:
    """(key, hash, versions, first): one row a content, with the versions that hold it.

    Counts and ends only, so that a content found in a third of all rows is safe.
    """
    return df.groupBy(*key, digest).agg(F.count_distinct(version).alias("n_versions"), F.min(version).alias("first_version"), F.max(version).alias("last_version"))


def apply_corrections(tables: DataFrame, corrections: DataFrame, on: list[str]) -> DataFrame:
    """Tables with their decision; ``outcome`` says what becomes of each.

    ``corrections`` has ``on``, status, original and corrected.
    """
    decided = tables.join(corrections.withColumn("decision", review_status("status", "original", "corrected")), on, "left")
    d = F.coalesce("decision", F.lit("undefined"))
    return decided.withColumn("outcome", F.when(d == "confirmed_with_changes", "rebuilt").when(d == "rejected", "untabled").when(d == "merged", "merged").otherwise("kept"))


def new_tables(tables: DataFrame, corrections: DataFrame, on: list[str]) -> DataFrame:
    """Corrections for tables that have none yet, as undefined."""
    return tables.select(*on).distinct().join(corrections.select(*on), on, "left_anti").withColumn("status", F.lit("undefined"))


def correction_errors(rules: dict[str, Column]) -> Column:
    """The messages of the rules that a row breaks, in order."""
    return F.filter(F.array(*(F.when(F.coalesce(bad, F.lit(False)), message) for message, bad in rules.items())), lambda x: x.isNotNull())


def cell_changes(original: str, corrected: str) -> Column:
    """array<struct<r,c,old,new>> of the cells in which two grids differ."""
    row = lambda g: F.coalesce(g, F.array().cast("array<string>"))  # noqa: E731  a row that one grid lacks
    cells = lambda x, r: F.transform(F.arrays_zip(row(x["o"]).alias("o"), row(x["n"]).alias("n")), lambda y, c: F.struct((r + 1).alias("r"), (c + 1).alias("c"), y["o"].alias("old"), y["n"].alias("new")))
    rows = F.transform(F.arrays_zip(F.col(original).alias("o"), F.col(corrected).alias("n")), cells)
    return F.filter(F.flatten(rows), lambda x: ~x["old"].eqNullSafe(x["new"]))


def clear_from_section(df: DataFrame, table: str, pos: str, text: str) -> DataFrame:
    """Rows of a table from its first section sign on are no longer in it."""
    first = F.min(F.when(F.col(text).startswith("§"), F.col(pos))).over(Window.partitionBy(table))
    return df.withColumn(table, F.when(first.isNull() | (F.col(pos) < first), F.col(table)))


def drop_single_rows(df: DataFrame, table: str, row: Column) -> DataFrame:
    """Rows of tables with one row are no longer in a table."""
    w = Window.partitionBy(table)
    return df.withColumn("_r", row).withColumn(table, F.when(F.min("_r").over(w) < F.max("_r").over(w), F.col(table))).drop("_r")


def statistics(df: DataFrame, size: str) -> DataFrame:
    """One row: counts, mean, median, sample deviation (0 for one), range, size classes."""
    n = F.col(size)
    return df.agg(
        F.count("*").alias("n_laws"), F.sum(n).alias("n_tables"), F.round(F.avg(n), 6).alias("mean_tables"), F.round(F.median(n), 6).alias("median_tables"),
        F.round(F.coalesce(F.stddev_samp(n), F.lit(0.0)), 6).alias("stdev_tables"), F.min(n).alias("min_tables"), F.max(n).alias("max_tables"),
        F.count_if(n == 1).alias("single"), F.count_if((n >= 2) & (n <= 5)).alias("few"), F.count_if(n >= 6).alias("many"),
    )
