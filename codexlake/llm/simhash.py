"""SimHash near-duplicates by segment popcounts.

A 64-bit fingerprint is cut into 2-bit segments; the counts of set bits in them are
a point of a lattice whose Manhattan distance never exceeds the Hamming distance
of the fingerprints.  Of two halves with 3 differing bits between them, one has a
Manhattan distance of at most 1.  So each fingerprint is a member of the lattice
cell of either half, and visits the cells one step up; every linked pair meets in
a cell, at least one of them as its own member, and is verified there on all 64 bits;
visitors are not compared with each other.  Copies collapse to one fingerprint first.  A cell with many fingerprints is cut into blocks that meet pair by pair,
and a pair of blocks yields a spanning forest of its links, never all pairs.

Defined cases: a null or empty text has fingerprint zero, linked like any other;
repeated rows stay; an id counts once however often it occurs; a group whose ids
are all null has a null component; a very long text is read in steps; an empty table
gives none; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexlake.llm.common import bytes_of, cut, on_workers
from codexlake.llm.components import connected_components

#: Byte -> 8 one-byte counters, so that one 64-bit addition counts 8 bits.
_SPREAD = sum(((np.arange(256, dtype=np.uint64) >> np.uint64(j)) & np.uint64(1)) << np.uint64(8 * j) for j in range(8))


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 (seed 42) of every word shingle; A-Z count as a-z."""
    w = text.lower().split()
    if not w:
        return np.empty(0, np.uint64)
    if len(w) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(w), 42)], np.uint64)
    h, join = xxhash.xxh64_intdigest, b" ".join
    return np.fromiter((h(join(s), 42) for s in zip(*(w[k:] for k in range(words)), strict=False)), np.uint64, len(w) - words + 1)


def bit_counts(hashes: np.ndarray, step: int = 255 * 256) -> np.ndarray:
    """How many of the hashes have each of the 64 bits, least bit first."""
    total = np.zeros(64, np.int64)
    for low in range(0, len(hashes), step):
        lanes = _SPREAD[hashes[low : low + step].view(np.uint8).reshape(-1, 8)]
        blocks = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
        total += blocks.view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)
    return total


def fingerprint(text: bytes, words: int = 3) -> int:
    """The SimHash as an unsigned number: bits set in over half the hashes."""
    hashes = shingle_hashes(text, words)
    return int(np.packbits(2 * bit_counts(hashes) > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp): the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t, words) for t in bytes_of(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["id", "fp"])

    kind = df.schema[id_col].dataType.simpleString()
    return on_workers(df).select(id_col, text_col).mapInArrow(run, f"id {kind}, fp long").withColumnRenamed("id", id_col)


def segment_counts(fp: np.ndarray) -> np.ndarray:
    """Popcounts of the 2-bit segments, each in its own 2 bits."""
    return fp - ((fp >> np.uint64(1)) & np.uint64(0x5555555555555555))


def _cells(distinct: DataFrame) -> DataFrame:
    """(cell, fp, rep, visits): the two own cells, and the cells one step up as a visitor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, rep = (np.asarray(c) for c in batch.columns)
            counts = segment_counts(fp.view(np.uint64))
            for half in range(2):
                own = ((counts >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)) | np.uint64(half << 40)
                for step in range(-1, 16):
                    if step < 0:
                        keep, cell = slice(None), own
                    else:
                        keep = np.flatnonzero(((own >> np.uint64(2 * step)) & np.uint64(3)) < 2)
                        cell = own[keep] + np.uint64(1 << (2 * step))
                    visits = pa.array(np.full(len(cell), step >= 0))
                    yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(fp[keep]), pa.array(rep[keep]), visits], ["cell", "fp", "rep", "visits"])

    return on_workers(distinct).select("fp", "rep").mapInArrow(run, "cell long, fp long, rep long, visits boolean")


def _forest(fp: np.ndarray, rep: np.ndarray, visits: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within one group, by breadth-first search.

    Two visitors of a cell are not compared: if they are near, they meet elsewhere.
    """
    edges, rest = [], np.arange(len(fp))
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            i = front.pop()
            near = (np.bitwise_count(fp[rest] ^ fp[i]) <= bits) & ~(visits[rest] & visits[i])
            if near.any():
                met = rest[near]
                edges += [(rep[i], rep[j]) for j in met if rep[i] != rep[j]]
                front += met.tolist()
                rest = rest[~near]
    return edges


def _links(group: np.ndarray, fp: np.ndarray, rep: np.ndarray, visits: np.ndarray, bits: int, small: int = 24, step: int = 1 << 20) -> list[tuple[int, int]]:
    """Links within runs of equal ``group``; all lie sorted by it, a run's own members before its visitors."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    own = np.add.reduceat(~visits, starts, dtype=np.int64)
    edges: list[tuple[int, int]] = []
    large = (own > small) | (sizes > 4 * small)
    for s, n in zip(starts[large & (own > 0)], sizes[large & (own > 0)], strict=True):
        edges += _forest(fp[s : s + n], rep[s : s + n], visits[s : s + n], bits)
    # In small runs each own member is compared with all that stand behind it.
    chosen = np.flatnonzero(~large & (own > 0) & (sizes > 1))
    first = np.repeat(starts[chosen], own[chosen]) + _within(own[chosen])
    behind = np.repeat(starts[chosen] + sizes[chosen], own[chosen]) - first - 1
    ends = np.cumsum(behind)
    cuts = [0, *np.searchsorted(ends, np.arange(step, ends[-1] + step, step), "left").tolist(), len(first)] if len(ends) and ends[-1] else [0]
    for low, high in zip(cuts, cuts[1:], strict=False):
        if low < high:
            i = np.repeat(first[low:high], behind[low:high])
            j = i + 1 + _within(behind[low:high])
            hit = np.flatnonzero((np.bitwise_count(fp[i] ^ fp[j]) <= bits) & (rep[i] != rep[j]))
            edges += zip(rep[i[hit]].tolist(), rep[j[hit]].tolist(), strict=True)
    return edges


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2 and so on within each of consecutive stretches."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def link_fingerprints(distinct: DataFrame, bits: int = 3, block: int = 4096) -> DataFrame:
    """Edges (a, b) between the ids ``rep`` of distinct fingerprints ``fp``.

    The edges connect exactly what pairs within ``bits`` (at most 3) connect.
    """
    if not 0 <= bits <= 3:
        raise ValueError("the cells cover at most 3 differing bits")
    cells = _cells(distinct)
    hot = cut(cells.groupBy("cell").count().where(F.col("count") > block).select("cell", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "hot-cells")
    dealt = cells.join(hot, "cell", "left").withColumn("own", F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("fp"), "blocks")).otherwise(0).cast("int"))
    meets = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", F.explode(meets)).select(
        F.when(F.col("blocks").isNull(), F.col("cell")).otherwise(F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other"))).alias("meet"), "fp", "rep", "visits"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = [np.empty(0, np.int64)] * 3 + [np.empty(0, bool)]
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [np.concatenate([k, c.to_numpy(zero_copy_only=False)]) for k, c in zip(kept, batch.columns, strict=True)]
            last = int(np.searchsorted(columns[0], columns[0][-1]))
            kept = [c[last:] for c in columns]
            yield out([c[:last] for c in columns])
        yield out(kept)

    def out(columns: list[np.ndarray]) -> pa.RecordBatch:
        edges = _links(columns[0], columns[1].view(np.uint64), *columns[2:], bits) if len(columns[0]) else []
        a, b = zip(*edges, strict=True) if edges else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    # A meeting's number may be shared by chance; that only adds verified comparisons.
    return on_workers(dealt).repartition("meet").sortWithinPartitions("meet", "visits").mapInArrow(run, "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, bits: int = 3) -> DataFrame:
    """(id, fingerprint, component_id) of every row; ids are longs."""
    prints = cut(fingerprints(df, id_col, text_col, words).withColumnRenamed(id_col, "id"), "fingerprints")
    distinct = cut(prints.groupBy("fp").agg(F.min("id").cast("long").alias("rep")), "distinct-fingerprints")
    components = connected_components(link_fingerprints(distinct.where("rep is not null"), bits))
    found = distinct.join(components, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(found, "fp", "left").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
