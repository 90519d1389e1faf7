"""Connected components of an edge table, without gathering edges anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexlake.llm.common import cut, discard


def _checksum(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
    return r["n"], r["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that is not itself its component's least.

    ``edges`` has columns a and b of one kind that can be ordered.  Large-star and
    small-star steps alternate until they change nothing; every step is written to the
    shared folder.  Hubs are safe: minima combine before the shuffle, joins may split a
    hub's edges, and the number of edges never grows.
    """
    now = cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _checksum(now)
    for _ in range(max_rounds if seen[0] else 0):
        before, half = now, cut(_large_star(now), "large-star")
        now = cut(_small_star(half), "small-star")
        discard(before, half)
        if (after := _checksum(now)) == seen:
            break
        seen = after
    else:
        if seen[0]:
            raise RuntimeError(f"components still change after {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
