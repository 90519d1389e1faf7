"""Acquisition and processing state: look-ups by key list, changes, steps, progress."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookup(keys: DataFrame, facts: DataFrame, on: str, value: str, order: str, default: str = "") -> DataFrame:
    """(key, value) of every asked key; the last binding wins, none gives the default."""
    last = facts.join(keys.select(on), on, "left_semi").groupBy(on).agg(F.max_by(value, order).alias(value))
    return keys.select(on).join(last, on, "left").select(on, F.coalesce(value, F.lit(default)).alias(value))


def versions_of(keys: DataFrame, facts: DataFrame, on: str, item: Column, order: list[str]) -> DataFrame:
    """(key, versions) of every asked key, an empty array where there are none."""
    rows = facts.join(keys.select(on), on, "left_semi").groupBy(on).agg(F.array_sort(F.collect_list(F.struct(*order, item.alias("_item")))).alias("_r"))
    return keys.select(on).join(rows, on, "left").select(on, F.coalesce(F.transform("_r", lambda x: x["_item"]), F.array().cast("array<string>")).alias("versions"))


def match_either(left: DataFrame, right: DataFrame, date: str, left_key: str, right_keys: list[str], order: str) -> DataFrame:
    """Left rows with the first right row of the same date that has the key in any of
    several columns: one equi-join on the unpivoted keys in place of an OR."""
    spread = right.select(date, F.explode(F.array_distinct(F.filter(F.array(*right_keys), lambda k: k.isNotNull()))).alias(left_key), order)
    first = spread.groupBy(date, left_key).agg(F.min(order).alias("matched"))
    return left.join(first, [date, left_key], "left")


def change_reasons(reasons: dict[str, Column]) -> Column:
    """The names of what changed, in order; empty if nothing did."""
    return F.filter(F.array(*(F.when(F.coalesce(test, F.lit(False)), name) for name, test in reasons.items())), lambda x: x.isNotNull())


def stamp(steps: str, name: str, at: Column) -> Column:
    """The step map with one step set."""
    return F.map_concat(F.map_filter(F.coalesce(F.col(steps), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))), lambda k, v: k != name), F.create_map(F.lit(name), at))


def completed(steps: str, names: list[str]) -> Column:
    """Whether every named step has a stamp that is not blank."""
    done = lambda n: F.trim(F.coalesce(F.try_element_at(F.col(steps), F.lit(n)), F.lit(""))) != ""
    out = F.lit(True)
    for n in names:
        out = out & done(n)
    return out


def progress(df: DataFrame, done: Column, failed: Column, seconds: Column) -> DataFrame:
    """One row: totals, share done, mean time and what is left at that pace."""
    n, d = F.count("*"), F.count_if(done)
    mean = F.avg(F.when(done, seconds))
    return df.agg(n.alias("total"), d.alias("done"), F.count_if(failed).alias("failed"), F.round(d * 100.0 / n, 6).alias("percent"), F.round(mean, 6).alias("mean_seconds"), F.round(mean * (n - d), 6).alias("seconds_left"))


def remaining(work: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    return work.join(done.select(*on), on, "left_anti")


def undecided(tables: DataFrame, corrections: DataFrame, law: str, key: str) -> DataFrame:
    """(law, key) of tables without a decision, or with none but undefined.

    Rows, not arrays: one law may have very many.
    """
    decided = corrections.where(F.coalesce(F.col("status"), F.lit("undefined")) != "undefined")
    return tables.select(law, key).join(decided.select(law, key), [law, key], "left_anti")


def completion(tables: DataFrame, corrections: DataFrame, law: str, key: str) -> DataFrame:
    """(law, n_tables, n_undecided, complete) by partial counts."""
    c = corrections.select(law, key, F.col("status").alias("_s"))
    open_ = F.col("_s").isNull() | (F.col("_s") == "undefined")
    return tables.join(c, [law, key], "left").groupBy(law).agg(F.count("*").alias("n_tables"), F.count_if(open_).alias("n_undecided")).withColumn("complete", F.col("n_undecided") == 0)


def hits_by_anchor(hits: DataFrame, anchors: DataFrame, doc: str) -> DataFrame:
    """(doc, anchor, n): hits between an anchor and the next one, by one ordered pass."""
    both = anchors.select(doc, "at", F.lit(0).alias("_side"), F.col("anchor")).unionByName(hits.select(doc, "at", F.lit(1).alias("_side"), F.lit(None).cast("string").alias("anchor")))
    w = Window.partitionBy(doc).orderBy("at", "_side", "anchor").rowsBetween(Window.unboundedPreceding, 0)
    placed = both.withColumn("anchor", F.last("anchor", ignorenulls=True).over(w)).where("_side = 1 and anchor is not null")
    return placed.groupBy(doc, "anchor").agg(F.count("*").alias("n"))


def page_of(df: DataFrame, order: list, number: int, size: int = 20) -> DataFrame:
    """One page of results."""
    return df.orderBy(*order).offset(number * size).limit(size)


def positions(df: DataFrame, order: str, name: str = "position") -> DataFrame:
    """Adds ``position``, from 1 in the order of one column, and ``next``, the value that follows.

    Rows are dealt by range, numbered within each range, and moved on by the sizes of
    those before: no task holds more than its range.  Nulls come last.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    within = Window.partitionBy("_p").orderBy(F.asc_nulls_last(order))
    # The range is a function of the value alone: both uses see the same ones, whatever a shuffle samples.
    parts = df.withColumn("_p", _range_of(order, _bounds(df, order, n))).withColumns({"_n": F.row_number().over(within), "next": F.lead(order).over(within)})
    sizes = parts.groupBy("_p").agg(F.count("*").alias("_size"), F.min(order).alias("_first"))
    whole = Window.orderBy("_p")  # a row a range
    before = sizes.select("_p", "_size", F.coalesce(F.sum("_size").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"), F.lead("_first").over(whole).alias("_then"))
    out = parts.join(before, "_p").withColumn("next", F.when(F.col("_n") == F.col("_size"), F.col("_then")).otherwise(F.col("next")))
    return out.withColumn(name, (F.col("_n") + F.col("_base")).cast("int")).drop("_p", "_n", "_size", "_base", "_then")


def _bounds(df: DataFrame, order: str, n: int, each: int = 32) -> list:
    """Values that cut a column into about ``n`` like ranges, from the ``each * n`` of least hash; every row gets a range."""
    chosen = df.where(F.col(order).isNotNull()).select(order).orderBy(F.xxhash64(order), order).limit(each * n)
    values = [r[0] for r in chosen.orderBy(order).collect()]
    return values[:: max(1, -(-len(values) // n))][1:]


def _range_of(order: str, bounds: list) -> Column:
    """How many of the bounds are not above the value, found in two steps; nulls are beyond all."""
    if not bounds:
        return F.col(order).isNull().cast("int")
    step = math.isqrt(len(bounds)) + 1
    up_to = lambda some: F.size(F.filter(some, lambda b: b <= F.col(order)))
    coarse = up_to(F.lit(bounds[step - 1 :: step])) if len(bounds) >= step else F.lit(0)
    fine = up_to(F.slice(F.lit(bounds), coarse * step + 1, F.lit(step - 1)))
    return F.when(F.col(order).isNull(), len(bounds) + 1).otherwise(coarse * step + fine)
