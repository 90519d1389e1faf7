"""Exact top-k search over 64-bit codes by incremental multi-index hashing.

Codes are cut into m segments, each with a table from segment value to codes.  The
queries search all tables at radius 0, 1, 2 and so on, a round for each.  After the
round of radius r every code within m * (r + 1) - 1 bits has been met in some
segment, so a query leaves as soon as its k-th verified distance is covered, and only
the others go on.

The tables are built once and dealt by segment and by the first bits of its value,
so that each code is written m times, whatever the number of queries; a query visits
only those parts whose first bits are within the radius, and probes the remaining
bits there.  Equal codes collapse to one entry with its k least ids, equal query
codes to one query.  A part that holds too many codes is dealt over salts.

Defined cases: a null code is no row and no query; ties at one distance go to the
smaller id; fewer than k rows give fewer answers; repeated ids count each; without
items or queries there are no answers; other columns of either table, whatever their
names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexlake.llm.common import cut, discard, on_workers


def sign_codes(df: DataFrame, id_col: str, vector_col: str, bits: int = 64, seed: int = 42) -> DataFrame:
    """(id, code): bit i is 1 if component i is at least 0.

    Vectors of more than ``bits`` components are first projected on that many
    random directions drawn from ``seed``; shorter ones leave the upper bits 0.
    A null vector has a null code; null or NaN components count as negative.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes: list[int | None] = []
            for v in batch.column(1).to_pylist():
                if v is None:
                    codes.append(None)
                    continue
                x = np.array([math.nan if c is None else c for c in v], np.float64)
                if len(x) > bits:
                    x = np.random.default_rng(seed).standard_normal((bits, len(x))) @ np.nan_to_num(x)
                packed = np.zeros(64, np.uint8)
                packed[: len(x)] = x >= 0
                codes.append(int(np.packbits(packed, bitorder="little").view(np.int64)[0]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.int64())], ["id", "code"])

    kind = df.schema[id_col].dataType.simpleString()
    return on_workers(df).select(id_col, vector_col).mapInArrow(run, f"id {kind}, code long").withColumnRenamed("id", id_col)


def segments_of(size: int) -> list[tuple[int, int]]:
    """(low bit, width) of each segment: about as many values as there are codes, 2 to 8 segments."""
    m = max(2, min(8, round(64 / max(8, math.log2(max(2, size))))))
    edges = np.linspace(0, 64, m + 1).round().astype(int).tolist()
    return [(low, high - low) for low, high in zip(edges, edges[1:], strict=False)]


def masks(width: int, radius: int) -> np.ndarray:
    """All numbers of ``width`` bits with exactly ``radius`` bits set."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], np.uint64)


class SegmentTable:
    """The part of one segment's table whose values share a prefix: from suffix to codes."""

    def __init__(self, codes: np.ndarray, ids: np.ndarray, counts: np.ndarray, low: int, width: int, prefix: int):
        suffix = (codes >> np.uint64(low)) & np.uint64((1 << (width - prefix)) - 1)
        order = np.argsort(suffix, kind="stable")
        self.codes, self.ids, self.counts = codes[order], ids[order], counts[order]
        self.keys, starts = np.unique(suffix[order], return_index=True)
        self.starts = np.r_[starts, len(order)]
        self.low, self.width, self.prefix = low, width, prefix
        self.head = int(codes[0] >> np.uint64(low + width - prefix)) & ((1 << prefix) - 1)

    def probe(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of all whose segments differ in exactly ``radius`` bits."""
        short = self.width - self.prefix
        own = (queries >> np.uint64(self.low)) & np.uint64((1 << short) - 1)
        heads = (queries >> np.uint64(self.low + short)) & np.uint64((1 << self.prefix) - 1)
        left = radius - np.bitwise_count(heads ^ np.uint64(self.head)).astype(np.int64)
        asked, keys = [], []
        for r in np.unique(left).tolist():
            if not 0 <= r <= short:
                continue
            rows = np.flatnonzero(left == r)
            few = math.comb(short, r) < len(self.keys)
            each = max(1, (1 << 20) // (math.comb(short, r) if few else len(self.keys)))
            for at in range(0, len(rows), each):
                part = rows[at : at + each]
                if few:
                    want = own[part, None] ^ masks(short, r)
                    found = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
                    q, k = np.nonzero(self.keys[found] == want)
                    k = found[q, k]
                else:  # fewer keys than probes: compare the keys themselves
                    q, k = np.nonzero(np.bitwise_count(self.keys ^ own[part, None]) == r)
                asked.append(part[q])
                keys.append(k)
        if not asked:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        q, k = np.concatenate(asked), np.concatenate(keys)
        sizes = self.starts[k + 1] - self.starts[k]
        first = np.cumsum(sizes) - sizes
        return np.repeat(q, sizes), np.repeat(self.starts[k] - first, sizes) + np.arange(int(sizes.sum()))

    def nearest(self, queries: np.ndarray, bounds: np.ndarray, radius: int, k: int) -> tuple[np.ndarray, ...]:
        """(query, code, distance, id, count) of the k best new rows of each query, none beyond its bound."""
        parts = []
        for low in range(0, len(queries), 1024):
            q, row = self.probe(queries[low : low + 1024], radius)
            q += low
            distance = np.bitwise_count(self.codes[row] ^ queries[q]).astype(np.int64)
            near = distance <= bounds[q]
            q, row, distance = q[near], row[near], distance[near]
            order = np.lexsort((self.ids[row], distance, q))
            q, row, distance = q[order], row[order], distance[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            q, row, distance = (x[rank < k] for x in (q, row, distance))
            parts.append((queries[q], self.codes[row], distance, self.ids[row], self.counts[row]))
        return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


_FOUND = ["qcode", "code", "distance", "id", "n"]


def _search(own: list[tuple[int, int]], prefix: int, radius: int, k: int):
    """Over rows sorted by (seg, head, salt, asks): a run's table rows, then its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, table = None, [], None
        for batch in batches:
            seg, head, salt, asks, code, number, n = (np.asarray(c) for c in batch.columns)
            if not len(seg):
                continue
            change = np.flatnonzero((seg[1:] != seg[:-1]) | (head[1:] != head[:-1]) | (salt[1:] != salt[:-1]) | (asks[1:] != asks[:-1])) + 1
            for low, high in zip(np.r_[0, change].tolist(), [*change.tolist(), len(seg)], strict=True):
                if key != (now := (int(seg[low]), int(head[low]), int(salt[low]))):
                    key, rows, table = now, [], None
                if not asks[low]:
                    rows.append((code[low:high].view(np.uint64), number[low:high], n[low:high]))
                    continue
                if table is None and rows:
                    table, rows = SegmentTable(*(np.concatenate(c) for c in zip(*rows, strict=True)), *own[key[0]], prefix), []
                if table is not None:
                    found = table.nearest(code[low:high].view(np.uint64), number[low:high], radius, k)
                    yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c, pa.int64()) for c in found], _FOUND)

    return run


def segment_rows(entries: DataFrame, own: list[tuple[int, int]], prefix: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Each code once a segment, as (seg, head, salt, code, id, n); and the salts of crowded heads.

    ``head`` is the first ``prefix`` bits of the segment's value.  A head with over
    twice ``block`` codes is dealt over salts, each of which every query visits.
    """
    rows = entries.select(F.explode(_heads(own, prefix)).alias("at"), "code", F.element_at("ids", 1).alias("id"), F.size("ids").cast("long").alias("n")).select("at.*", "code", "id", "n")
    crowded = rows.groupBy("seg", "head").count().where(F.col("count") > 2 * block).select("seg", "head", F.ceil(F.col("count") / block).cast("int").alias("salts"))
    crowded = cut(crowded, "crowded-heads")
    salt = F.coalesce(F.pmod(F.xxhash64("code"), "salts"), F.lit(0)).cast("int").alias("salt")
    return rows.join(crowded, ["seg", "head"], "left").select("seg", "head", salt, "code", "id", "n"), crowded


def _heads(own: list[tuple[int, int]], prefix: int) -> Column:
    head = lambda low, width: F.shiftrightunsigned("code", low + width - prefix).bitwiseAND(F.lit((1 << prefix) - 1))
    return F.array(*(F.struct(F.lit(n).alias("seg"), (head(low, width) if prefix else F.lit(0)).cast("long").alias("head")) for n, (low, width) in enumerate(own)))


def visits(active: DataFrame, own: list[tuple[int, int]], prefix: int, radius: int, crowded: DataFrame) -> DataFrame:
    """(seg, head, salt, code, bound): each query once for every head within the radius."""
    near = F.array(*(F.lit(int(x)) for r in range(min(radius, prefix) + 1) for x in masks(prefix, r)))
    rows = active.select(F.explode(_heads(own, prefix)).alias("at"), "code", "bound").select("at.seg", F.explode(F.transform(near, lambda x: F.col("at.head").bitwiseXOR(x.cast("long")))).alias("head"), "code", "bound")
    salts = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    return rows.join(crowded, ["seg", "head"], "left").select("seg", "head", F.explode(salts).alias("salt"), "code", "bound")


def exact_topk(items: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "id", query_col: str = "query_id", block: int = 8192) -> DataFrame:
    """(query, rank, id, distance): the k items nearest each query, exactly.

    Both tables have a long column ``code``; ids are longs.  A run of a segment's
    table holds about ``block`` codes, at most twice as many.
    """
    rank = Window.partitionBy("code").orderBy("id")
    pairs = items.where("code is not null").select(F.col(id_col).cast("long").alias("id"), "code")
    firsts = pairs.withColumn("n", F.row_number().over(rank)).where(F.col("n") <= k)
    entries = cut(firsts.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    asked = cut(queries.where("code is not null").select(F.col(query_col).alias("q"), "code"), "queries")
    wanted = cut(asked.select("code").distinct(), "query-codes")
    size, total = entries.agg(F.count("*"), F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()
    own, enough = segments_of(size), min(k, total)
    prefix = min(min(w for _, w in own), max(0, math.ceil(math.log2(max(1, size) / block))))
    table, crowded = segment_rows(entries, own, prefix, block)
    table = cut(table, "segment-tables")
    best = None
    active = wanted.select("code", F.lit(64).cast("long").alias("bound"))
    order = Window.partitionBy("qcode").orderBy("distance", "id")
    for radius in range(max(w for _, w in own) + 1):
        asks = visits(active, own, prefix, radius, crowded)
        rows = table.select("seg", "head", "salt", F.lit(0).alias("asks"), "code", F.col("id").alias("number"), "n").unionByName(asks.select("seg", "head", "salt", F.lit(1).alias("asks"), "code", F.col("bound").alias("number"), F.lit(0).cast("long").alias("n")))
        dealt = rows.repartition("seg", "head", "salt").sortWithinPartitions("seg", "head", "salt", "asks")
        found = on_workers(dealt).mapInArrow(_search(own, prefix, radius, k), ", ".join(f"{c} long" for c in _FOUND))
        # Codes that hold the k best rows: those with fewer than k rows before them.
        pool = (found if best is None else found.unionByName(best)).distinct()
        earlier, asked_before = best, active
        before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        best = cut(pool.withColumn("before", before).where(F.col("before") < k).drop("before"), f"nearest-{radius}")
        seen = best.groupBy("qcode").agg(F.sum("n").alias("rows"), F.max("distance").alias("bound"))
        # All codes within this many bits have been met in some segment.
        covered = len(own) * (radius + 1) - 1
        going = wanted.join(seen, F.col("code") == F.col("qcode"), "left").where(f"rows is null or rows < {enough} or bound > {covered}")
        active = cut(going.select("code", F.when(F.col("rows") >= k, F.col("bound")).otherwise(64).cast("long").alias("bound")), f"active-{radius}")
        discard(*(x for x in (earlier, asked_before) if x is not None))
        if not total or not active.head(1):
            break
    near = best.select("qcode", "code", "distance").join(entries, "code").select("qcode", "distance", F.explode("ids").alias("id"))
    best = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return asked.join(best, F.col("qcode") == asked["code"]).select(F.col("q").alias(query_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "distance")
