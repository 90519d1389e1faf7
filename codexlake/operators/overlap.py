"""Spatial and temporal matching: groups by gap, best overlap, next-after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def proximity_groups(df: DataFrame, key: list[str], order: list, gap: Column, threshold: float, name: str = "group_id") -> DataFrame:
    """Number the runs of rows whose gap to the row before stays below ``threshold``.

    ``gap`` is an expression over the row and ``lag`` columns it makes itself.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    opens = F.when(F.row_number().over(w) == 1, 1).when(gap >= threshold, 1).otherwise(0)
    return df.withColumn("_opens", opens).withColumn(name, F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_opens")


def boxes(df: DataFrame, key: list[str], group: str) -> DataFrame:
    """Union of the boxes (x0, y0, x1, y1) of each group, with the least page."""
    return df.groupBy(*key, group).agg(F.min("page").alias("page"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(a1, b1) - F.greatest(a0, b0))


def best_overlap(left: DataFrame, right: DataFrame, on: list[str], cell: float) -> DataFrame:
    """(left_id, right_id, overlap): for each left span the right one it overlaps most.

    Both have ``on``, ``id``, ``lo`` and ``hi``; ties go to the smaller right id.
    Spans are cut into cells of width ``cell`` and meet by equality of key and cell,
    so the join shuffles instead of comparing all with all; a pair counts only in
    the first cell that both touch.
    """

    def spread(df: DataFrame, side: str) -> DataFrame:
        first, last = F.floor(F.col("lo") / cell), F.floor(F.col("hi") / cell)
        return df.select(*on, F.col("id").alias(f"{side}_id"), F.col("lo").alias(f"{side}_lo"), F.col("hi").alias(f"{side}_hi"), F.explode(F.sequence(first, last)).alias("_cell"))

    a, b = spread(left, "left"), spread(right, "right")
    met = a.join(b, [*on, "_cell"]).where(F.col("_cell") == F.floor(F.greatest("left_lo", "right_lo") / cell))
    size = overlap(F.col("left_lo"), F.col("left_hi"), F.col("right_lo"), F.col("right_hi"))
    best = met.withColumn("overlap", size).where("overlap > 0").groupBy(*on, "left_id").agg(F.max_by(F.struct("right_id", "overlap"), F.struct("overlap", -F.col("right_id"))).alias("_b"))
    return best.select(*on, "left_id", "_b.right_id", "_b.overlap")


def next_after(left: DataFrame, right: DataFrame, on: list[str], at: str) -> DataFrame:
    """(left_id, right_id): the first right row at or after each left row.

    A union and one window in place of a range join: linear, with one sort a key.
    At equal places the smallest right id is taken.
    """
    both = left.select(*on, at, F.lit(1).alias("_side"), F.col("id").alias("_id")).unionByName(right.select(*on, at, F.lit(0).alias("_side"), F.col("id").alias("_id")))
    # Read backwards, right rows at the same place come first, the smallest id last.
    w = Window.partitionBy(*on).orderBy(F.desc(at), "_side", F.desc("_id")).rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("right_id", F.last(F.when(F.col("_side") == 0, F.col("_id")), ignorenulls=True).over(w))
    return seen.where("_side = 1").select(*on, F.col("_id").alias("left_id"), "right_id")
