"""Version algebra: latest, older and newer, neighbours, pairs, terminal versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str, order: list[Column], keep: list[str]) -> DataFrame:
    """The row of each key that is last in ``order``.

    One aggregation with map-side combining: a hot key sends one row a task.  The
    order must be total; nulls count as least.
    """
    return df.groupBy(key).agg(F.max_by(F.struct(*keep), F.struct(*order)).alias("_last")).select(key, "_last.*")


def ranks(df: DataFrame, key: str, version: str, tie: str) -> DataFrame:
    """How many versions of the key are strictly older and newer, and the nearest.

    Equal versions are neither; a null version has no links and is nobody's link.
    Linear in the size of a key, unlike ``links``.
    """
    known = df.where(F.col(version).isNotNull())
    up, down = Window.partitionBy(key).orderBy(version), Window.partitionBy(key).orderBy(F.desc(version))
    before, after = up.rangeBetween(Window.unboundedPreceding, Window.currentRow), down.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = known.withColumn("n_older", F.rank().over(up) - 1).withColumn("n_newer", F.rank().over(down) - 1)
    out = out.withColumn("oldest", F.when(F.col("n_older") > 0, F.min_by(tie, F.struct(version, tie)).over(before)))
    out = out.withColumn("newest", F.when(F.col("n_newer") > 0, F.max_by(tie, F.struct(version, tie)).over(after)))
    nothing = df.where(F.col(version).isNull()).withColumns({"n_older": F.lit(0), "n_newer": F.lit(0), "oldest": F.lit(None).cast(df.schema[tie].dataType), "newest": F.lit(None).cast(df.schema[tie].dataType)})
    return out.unionByName(nothing)


def links(df: DataFrame, key: str, version: str, item: Column, tie: str) -> DataFrame:
    """Arrays ``older`` and ``newer`` of ``item`` for every version, in order.

    Cut from one sorted array a key.  The result itself is quadratic in a key's
    versions; use ``ranks`` where one key may have very many.
    """
    known = df.where(F.col(version).isNotNull())
    every = known.groupBy(F.col(key).alias("_k")).agg(F.array_sort(F.collect_list(F.struct(F.col(version).alias("v"), F.col(tie).alias("t"), item.alias("i")))).alias("_all"))
    up, down = Window.partitionBy(key).orderBy(F.asc_nulls_last(version)), Window.partitionBy(key).orderBy(F.desc_nulls_last(version))
    places = df.withColumns({"_older": F.rank().over(up) - 1, "_newer": F.rank().over(down) - 1})
    out = places.join(every, F.col(key).eqNullSafe(F.col("_k")), "left")
    # In the sorted array of a key the older ones are the first, the newer ones the last.
    items = lambda part: F.transform(part, lambda x: x["i"])
    nothing = F.slice(items(F.col("_all")), 1, 0)
    named = F.col(version).isNotNull()
    older, newer = items(F.slice("_all", F.lit(1), F.col("_older"))), items(F.slice("_all", F.size("_all") - F.col("_newer") + 1, F.col("_newer")))
    empty = F.transform(F.array(item), lambda x: x)
    value = lambda part: F.coalesce(F.when(named, part).otherwise(nothing), F.slice(empty, 1, 0))
    return out.withColumns({"older": value(older), "newer": value(newer)}).drop("_k", "_all", "_older", "_newer")


def neighbours(df: DataFrame, key: str, order: list, item: str) -> DataFrame:
    """Previous, next and newest item of each version."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumns(
        {"prev": F.lag(item).over(w), "next": F.lead(item).over(w), "newest": F.last(item).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))}
    )


def consecutive_pairs(df: DataFrame, key: str, order: list[Column], item: str, last: int = 3) -> DataFrame:
    """(key, newer, older, rank) of adjacent versions among the ``last`` newest.

    ``order`` runs newest first.  The rank limit is taken before the shuffle, so a
    hot key sends ``last`` rows a task.
    """
    w = Window.partitionBy(key).orderBy(*order)
    ranked = df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= last)
    pairs = ranked.withColumn("older", F.lead(item).over(Window.partitionBy(key).orderBy("rank")))
    return pairs.where(F.col("older").isNotNull()).select(key, F.col(item).alias("newer"), "older", "rank")


def drop_terminal(df: DataFrame, key: str, order: list, is_terminal: Column) -> DataFrame:
    """All versions less a key's newest where that one is terminal."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(~((F.col("_rank") == 1) & F.coalesce(is_terminal, F.lit(False)))).drop("_rank")


def missing(wanted: DataFrame, have: DataFrame, on: list[str], order: list) -> DataFrame:
    """Wanted rows whose key is not there yet, the first of each key by ``order``."""
    first = wanted.withColumn("_rank", F.row_number().over(Window.partitionBy(*on).orderBy(*order))).where("_rank = 1").drop("_rank")
    return first.join(have.select(*on).distinct(), on, "left_anti")


def upsert(df: DataFrame, on: list[str], order: list[Column]) -> DataFrame:
    """The last writer of each key wins, by an explicit total order."""
    rest = [c for c in df.columns if c not in on]
    return df.groupBy(*on).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*on, "_row.*")
