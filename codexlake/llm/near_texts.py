"""Near-duplicate texts by shingle similarity: SimHash fingerprints, cells of segment popcounts.

Texts are linked whose sets of word shingles (five words) have a Jaccard similarity
of 0.8 or more.  Such a pair differs in some 15 % of a fingerprint's bits, so no
radius around one cell of a whole fingerprint holds it and tells texts apart.  So a
fingerprint of 256 bits lies in one cell of each of many tables: a table's cell is the
counts of set bits in its own few 2-bit segments, which a linked pair shares with a
probability of 0.73 for each segment.  Within a cell all fingerprints are compared by
popcount; pairs near enough are candidates, and their shingles decide.

No group is written out as pairs.  Texts of the same words are one class first.  A
class that is near another one in some cell keeps the list of such cells.  These cells
are read again with a bitmap of each class's shingles, which bounds what two share, and
give a spanning forest of what may be linked.  Only where such a link fails, so that
a cell holds possible links between different components, are those outside its
largest component compared by shingles with all that are possible, block by block within
tasks, and a block returns at most a forest of links.  So no candidate link between
different components is lost, however large the group.

Defined cases: a null or empty text is a class of its own words, none; a text of
fewer words than a shingle has is one shingle; repeated rows are copies; rows without
an id are kept; an empty table gives an empty one; other columns may have any name.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexlake.llm.common import bytes_of, cut, discard, on_workers, tidy
from codexlake.llm.components import connected_components
from codexlake.llm.simhash import bit_counts, segment_counts, shingle_hashes

#: 64-bit words of a fingerprint, and how many of its bits may differ.
WORDS, BITS = 4, 70
#: How many of the first two words' bits may differ within a cell.
FIRST_BITS = 40
#: Segments of a cell, and tables of cells: of 4,000 random pairs of similarity 0.8 none shared none, of those of 4 and 5 shingles 42.
SEGMENTS, TABLES = 7, 128
#: Bits of the bitmap of a set of shingles; it bounds what two sets share.
BITMAP = 1024
_ODD = np.random.default_rng(42).integers(0, 1 << 63, (2, WORDS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PRINTS = [f"f{k}" for k in range(WORDS)]


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """``WORDS`` SimHash words of one set of shingles, each over its own remix of the hashes."""
    out = np.zeros(WORDS, np.uint64)
    for k in range(WORDS):
        mixed = hashes * _ODD[0, k]
        mixed ^= mixed >> np.uint64(32)
        mixed *= _ODD[1, k]
        mixed ^= mixed >> np.uint64(29)
        out[k] = np.packbits(2 * bit_counts(mixed) > len(mixed), bitorder="little").view(np.uint64)[0]
    return out


def tables_of(segments: int) -> int:
    """How many tables find a linked pair as surely as ``TABLES`` of ``SEGMENTS``."""
    return math.ceil(TABLES * 0.7307 ** (SEGMENTS - segments))


def cells(prints: np.ndarray, segments: int = SEGMENTS) -> np.ndarray:
    """A cell of each table for every fingerprint (a row of words): counts of some of its 2-bit segments."""
    tables = tables_of(segments)
    chosen = np.random.default_rng(7).random((tables, 32 * WORDS)).argsort(1)[:, :segments]
    counts = (segment_counts(prints)[:, :, None] >> (2 * np.arange(32, dtype=np.uint64))) & np.uint64(3)
    digits = counts.reshape(len(prints), -1).astype(np.int64)
    out = np.arange(tables) * 3**segments + np.zeros((len(prints), 1), np.int64)
    for k in range(segments):
        out += digits[:, chosen[:, k]] * 3**k
    return out


def bands(hashes: np.ndarray) -> np.ndarray:
    """The cells of one set of shingles; none for no shingles."""
    return cells(wide_fingerprint(hashes)[None])[0] if len(hashes) else np.empty(0, np.int64)


def sketches(rows: DataFrame, words: int) -> DataFrame:
    """(id, h, class, n, f0.., bits) of (id, h, text): a class is the words alone, n its shingles, bits a bitmap of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, sizes, prints, bits = [], [], [], []
            for text in bytes_of(batch.column(2)):
                classes.append(hashlib.md5(b" ".join(text.lower().split())).digest())
                hashes = np.unique(shingle_hashes(text, words))
                sizes.append(len(hashes))
                prints.append(wide_fingerprint(hashes))
                bits.append(bitmap_of(hashes))
            wide = np.array(prints, np.uint64).reshape(-1, WORDS).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(classes, pa.binary()), pa.array(sizes, pa.int32()), *(pa.array(wide[:, k]) for k in range(WORDS)), pa.array(bits, pa.binary())],
                ["id", "h", "class", "n", *_PRINTS, "bits"],
            )
        tidy()

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, h long, class binary, n int, {', '.join(f'{c} long' for c in _PRINTS)}, bits binary")


def bitmap_of(hashes: np.ndarray) -> bytes:
    """A bitmap of ``BITMAP`` bits: each hash sets the one its first bits name."""
    out = np.zeros(BITMAP, np.uint8)
    out[hashes >> np.uint64(64 - BITMAP.bit_length() + 1)] = 1
    return np.packbits(out).tobytes()


def maybe_similar(n: int, bitmap: np.ndarray, sizes: np.ndarray, bitmaps: np.ndarray, similarity: float) -> np.ndarray:
    """Whether a set of shingles may be as similar as asked to each of others; never false for one that is.

    A bit that only one bitmap has stands for a shingle at least that only its set has.
    """
    common = np.minimum(n - np.bitwise_count(bitmap & ~bitmaps).sum(1, dtype=np.int64), sizes - np.bitwise_count(bitmaps & ~bitmap).sum(1, dtype=np.int64))
    return common * (1 + similarity) >= similarity * (n + sizes) - 1e-6


def _members(classes: DataFrame, segments: int) -> DataFrame:
    """(cell, node, f0, f1) of each class with shingles, a row a table; ``node`` is a hash of the class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                node, *prints = (np.asarray(c) for c in batch.slice(low, 1000).columns)
                found = cells(np.stack(prints, 1).view(np.uint64), segments)
                each = found.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(found.ravel()), *(pa.array(np.repeat(c, each)) for c in (node, *prints[:2]))], ["cell", "node", "f0", "f1"])

    rows = classes.where("n > 0").select(F.xxhash64("class").alias("node"), *_PRINTS)
    return on_workers(rows).mapInArrow(run, "cell long, node long, f0 long, f1 long")


def near_in_cell(node: np.ndarray, prints: np.ndarray, most: int = 4, step: int = 1 << 19) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Near pairs of a cell's rows, and none else; or, where they are many, a leader for each row and all rows that are near another."""
    n, pairs, total, met = len(node), [], 0, np.zeros(len(node), bool)
    for low in range(0, n, max(1, step // n)):
        high = min(n, low + max(1, step // n))
        apart = np.bitwise_count(prints[low:high, None, 0] ^ prints[None, low:, 0]) + np.bitwise_count(prints[low:high, None, 1] ^ prints[None, low:, 1])
        i, j = np.nonzero(apart <= FIRST_BITS)
        later = j > i
        i, j = i[later] + low, j[later] + low
        met[i] = met[j] = True
        total += len(i)
        if total <= most * n + 64:
            pairs.append((i, j))
    if total <= most * n + 64:
        return [(a, b) for i, j in pairs for a, b in zip(node[i].tolist(), node[j].tolist(), strict=True)], np.empty(0, np.int64)
    led, rest = [], np.flatnonzero(met)
    while len(rest):
        lead, rest = rest[0], rest[1:]
        near = np.bitwise_count(prints[rest, :2] ^ prints[lead, :2]).sum(1) <= FIRST_BITS
        led += [(int(node[lead]), b) for b in node[rest[near]].tolist()]
        rest = rest[~near]
    return led, node[met]


def _near_nodes(members: DataFrame, block: int = 4096) -> DataFrame:
    """(meet, node) of the nodes of a cell that are near another one there by the first words.

    A cell of more than ``block`` rows is cut into blocks, which meet pair by pair.
    """
    hot = cut(members.groupBy("cell").count().where(F.col("count") > block).select("cell", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "crowded-cells")
    dealt = members.join(hot, "cell", "left").withColumn("own", F.when(F.col("blocks") > 1, F.pmod("node", "blocks")).otherwise(0).cast("int"))
    meets = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    meet = F.when(F.col("blocks").isNull(), F.col("cell")).otherwise(F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")))
    dealt = dealt.withColumn("other", F.explode(meets)).select(meet.alias("meet"), "node", "f0", "f1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in whole_keys(batches):
            meet, node = (np.asarray(c) for c in whole.columns[:2])
            prints = np.stack([np.asarray(c) for c in whole.columns[2:]], 1).view(np.uint64)
            meets, nodes = [], []
            for low, high in runs(meet):
                if high - low > 1:
                    pairs, many = near_in_cell(node[low:high], prints[low:high])
                    own = many if len(many) else np.unique(np.array(pairs, np.int64))
                    meets.append(np.full(len(own), meet[low]))
                    nodes.append(own)
            none = np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *x])) for x in (meets, nodes)], ["meet", "node"])
        tidy()

    return on_workers(dealt).repartition("meet").sortWithinPartitions("meet").mapInArrow(run, "meet long, node long")


def whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of rows sorted by their first column, a number, cut where it changes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            key = np.asarray(batch.column(0))
            last = int(np.searchsorted(key, key[-1]))
            if held and (last or held[0].column(0)[0].as_py() != key[-1]):
                yield pa.concat_batches([*held, batch.slice(0, last)])
                held = []
            elif last:
                yield batch.slice(0, last)
            held.append(batch.slice(last))
    if held:
        yield pa.concat_batches(held)


def runs(key: np.ndarray) -> list[tuple[int, int]]:
    """Where each run of one key starts and ends."""
    edges = np.r_[0, np.flatnonzero(key[1:] != key[:-1]) + 1, len(key)]
    return list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)) if len(key) else []


class Cell:
    """The classes of a cell that have a near one there, with all that is known of them but their shingles."""

    def __init__(self, sizes: np.ndarray, prints: np.ndarray, bitmaps: np.ndarray, similarity: float):
        self.sizes, self.prints, self.bitmaps, self.similarity = sizes, prints, bitmaps, similarity

    def near(self, one: int, others: np.ndarray) -> np.ndarray:
        """Which of ``others`` may be as similar to ``one`` as asked."""
        sizes = self.sizes[others]
        fits = np.minimum(sizes, self.sizes[one]) >= self.similarity * np.maximum(sizes, self.sizes[one])
        fits[fits] = np.bitwise_count(self.prints[others[fits]] ^ self.prints[one]).sum(1) <= BITS
        fits[fits] = maybe_similar(self.sizes[one], self.bitmaps[one], self.sizes[others[fits]], self.bitmaps[others[fits]], self.similarity)
        return fits

    def forest(self) -> list[tuple[int, int]]:
        """A spanning forest of what may be linked."""
        rest, links = np.arange(len(self.sizes)), []
        while len(rest):
            reached, rest = [int(rest[0])], rest[1:]
            while reached and len(rest):
                one = reached.pop()
                fits = self.near(one, rest)
                links += [(one, k) for k in rest[fits].tolist()]
                reached += rest[fits].tolist()
                rest = rest[~fits]
        return links

    def rivals(self, component: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that may be linked with one of another component, and which of them lie outside the largest component."""
        names, label, count = np.unique(component, return_inverse=True, return_counts=True)
        outside = label != count.argmax()
        found = np.zeros(len(label), bool)
        for one in np.flatnonzero(outside).tolist():
            others = np.flatnonzero(label != label[one])
            fits = self.near(one, others)
            found[others[fits]] = True
            found[one] |= fits.any()
        return np.flatnonzero(found), outside[found]


def _in_cells(rows: DataFrame, similarity: float, work, kinds: str) -> DataFrame:
    """What ``work`` makes of each ``Cell`` of rows (key, class, component, n, f0.., bits)."""
    names = [x.split()[0] for x in kinds.split(", ")]
    types = [pa.binary() if x.endswith("binary") else pa.int64() for x in kinds.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in whole_keys(batches):
            key, sizes = np.asarray(whole.column("key")), np.asarray(whole.column("n")).astype(np.int64)
            prints = np.stack([np.asarray(whole.column(c)) for c in _PRINTS], 1).view(np.uint64)
            bitmaps = np.frombuffer(b"".join(whole.column("bits").to_pylist()), np.uint64).reshape(len(key), -1)
            classes, components = (np.array(whole.column(c).to_pylist(), object) for c in ("class", "component"))
            out = [x for low, high in runs(key) for x in work(int(key[low]), Cell(sizes[low:high], prints[low:high], bitmaps[low:high], similarity), classes[low:high], components[low:high])]
            out = list(dict.fromkeys(out))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names)
        tidy()

    dealt = rows.select("key", "class", "component", "n", *_PRINTS, "bits").repartition("key").sortWithinPartitions("key", "class")
    return dealt.mapInArrow(run, kinds)


def _forest(key: int, cell: Cell, classes: np.ndarray, components: np.ndarray) -> list[tuple]:
    return [(classes[a], classes[b]) if classes[a] < classes[b] else (classes[b], classes[a]) for a, b in cell.forest()]


def _rivals(block: int):
    def work(key: int, cell: Cell, classes: np.ndarray, components: np.ndarray) -> list[tuple]:
        if (components == components[0]).all():
            return []
        found, outside = cell.rivals(components)
        blocks = math.ceil(len(found) / block)
        return [(key, c, blocks, int(o)) for c, o in zip(classes[found], outside, strict=True)]

    return work


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sets of shingle hashes, each sorted, are as similar as asked."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return bool(common) and common >= similarity * (len(a) + len(b) - common)


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Of pairs (a, b) of classes, those whose shingles are as similar as asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = ([np.frombuffer(x, np.uint64) for x in batch.column(c).to_pylist()] for c in (2, 3))
            at = pa.array([n for n, (a, b) in enumerate(zip(left, right, strict=True)) if similar(a, b, similarity)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], ["a", "b"])

    left, right = (sets.select(F.col("class").alias(c), F.col("shingles").alias(f"shingles_{c}")) for c in "ab")
    return cut(pairs.join(right, "b").join(left, "a").select("a", "b", "shingles_a", "shingles_b").mapInArrow(run, "a binary, b binary"), "links")


def _across(similarity: float):
    """Links (a, b) between components, over rows sorted by (key, block, asks): a block, then who asks it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, Block(similarity)
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("key", "block")), strict=True))
            asks, classes, components, n = (batch.column(c).to_pylist() for c in ("asks", "class", "component", "n"))
            prints = np.stack([np.asarray(batch.column(c)) for c in _PRINTS], 1).view(np.uint64)
            links = []
            for k, at in enumerate(keys):
                if at != key:
                    key, block = at, Block(similarity)
                row = (classes[k], components[k], n[k], prints[k], np.frombuffer(batch.column("shingles")[k].as_py(), np.uint64))
                if asks[k]:
                    links += block.ask(*row)
                else:
                    block.rows.append(row)
            a, b = zip(*links, strict=True) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return run


class Block:
    """Some classes of a cell; links found in it merge their components for what follows."""

    def __init__(self, similarity: float):
        self.similarity, self.rows, self.number, self.root = similarity, [], {}, np.empty(0, np.int64)
        self.table: tuple | None = None

    def _place(self, component: bytes) -> int:
        """The present root of a component."""
        if component not in self.number:
            self.number[component] = len(self.root)
            self.root = np.append(self.root, len(self.root))
        return int(self.root[self.number[component]])

    def ask(self, class_: bytes, component: bytes, n: int, prints: np.ndarray, shingles: np.ndarray) -> list[tuple[bytes, bytes]]:
        if self.table is None:
            for row in self.rows:
                self._place(row[1])
            self.table = np.array([r[2] for r in self.rows]), np.array([r[3] for r in self.rows], np.uint64).reshape(-1, WORDS), np.array([self.number[r[1]] for r in self.rows], np.int64)
        own, (sizes, table, labels) = self._place(component), self.table
        apart = np.bitwise_count(table ^ prints).sum(1)
        near = np.flatnonzero((apart <= BITS) & (np.minimum(sizes, n) >= self.similarity * np.maximum(sizes, n)) & (self.root[labels] != own))
        links = []
        for k in near[np.argsort(apart[near], kind="stable")].tolist():
            if (other := int(self.root[labels[k]])) != own and similar(shingles, self.rows[k][4], self.similarity):
                links.append((class_, self.rows[k][0]))
                self.root[self.root == other] = own
        return links


def segments_for(n: int) -> int:
    """Segments of a cell for so many classes: a cell holds some 2,000 of them on average at most."""
    return max(SEGMENTS, math.ceil(math.log(max(n, 1) / 2000, 8 / 3)))


def components_of(classes: DataFrame, texts: DataFrame, words: int, similarity: float, block: int = 1024) -> DataFrame:
    """(node, component) of classes that are linked with another one."""
    near = _near_nodes(_members(classes, segments_for(classes.count())))
    known = classes.select(F.xxhash64("class").alias("node"), "class", "n", *_PRINTS, "bits")
    # A row a class, with its cells: what is known of it joins once.
    placed = cut(near.groupBy("node").agg(F.collect_list("meet").alias("keys")).join(known, "node").drop("node"), "near-classes")
    rows = placed.withColumn("component", F.col("class")).withColumn("key", F.explode("keys"))
    first = cut(_in_cells(rows, similarity, _forest, "a binary, b binary").distinct(), "forest")
    wanted = classes.join(first.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "class", "left_semi").select("class", "id", "h")
    sets = cut(_shingles(texts.join(wanted, ["id", "h"]).groupBy("class").agg(F.first("text").alias("text")), words), "shingles")
    links = _verified(first, sets, similarity)
    found = connected_components(links)
    # Cells where classes of different components may still be linked: those outside the largest ask every block.
    # A class without a link in the forests has no possible one.
    labelled = placed.join(sets.select("class"), "class", "left_semi").join(found, F.col("class") == F.col("node"), "left").withColumn("component", F.coalesce("component", "class")).drop("node")
    apart = cut(_in_cells(labelled.withColumn("key", F.explode("keys")), similarity, _rivals(block), "key long, class binary, blocks long, outside long"), "mixed-cells")
    if apart.head(1):
        by_class = apart.groupBy("class").agg(F.collect_list(F.struct("key", "blocks", "outside")).alias("cell"))
        held = by_class.join(labelled.drop("keys", "bits"), "class").join(sets, "class").withColumn("cell", F.explode("cell"))
        # A class lies in its own block; one outside asks all blocks besides.
        own = F.struct(F.pmod(F.xxhash64("class"), "cell.blocks").cast("int").alias("block"), F.lit(0).alias("asks"))
        every = F.transform(F.sequence(F.lit(0), (F.col("cell.blocks") - 1).cast("int")), lambda k: F.struct(k.alias("block"), F.lit(1).alias("asks")))
        each = held.withColumn("at", F.explode(F.when(F.col("cell.outside") == 1, F.concat(F.array(own), every)).otherwise(F.array(own))))
        rows = each.select("cell.key", "at.block", "at.asks", "class", "component", "n", *_PRINTS, "shingles")
        more = rows.repartition("key", "block").sortWithinPartitions("key", "block", "asks").mapInArrow(_across(similarity), "a binary, b binary")
        links_too = cut(links.unionByName(more), "all-links")
        discard(found)
        found = connected_components(links_too)
        discard(links_too)
    discard(placed, first, sets, links, apart)
    return found


def _shingles(texts: DataFrame, words: int) -> DataFrame:
    """(class, shingles): the distinct shingle hashes of (class, text), as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(t, words)).tobytes() for t in bytes_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["class", "shingles"])

    return texts.select("class", "text").mapInArrow(run, "class binary, shingles binary")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``df`` less all but one of each group of near-duplicate texts.

    The row of least id stays, then the one of least row hash; rows with a null id
    all stay.  Texts that no chain of links joins stay, whatever their ids.
    """
    named = on_workers(df).where(F.col(id_col).isNotNull())
    plain = [c for c, kind in df.dtypes if "map<" not in kind and kind != "variant"]  # the kinds that hash
    digest, mark = F.xxhash64(*(F.col(f"`{c}`") for c in plain)), "_" * max(map(len, df.columns))  # no column is called mark + anything
    texts = named.select(F.col(id_col).alias("id"), digest.alias("h"), F.col(text_col).alias("text"))
    rows = cut(sketches(texts, words), "sketches")
    columns = ["n", *_PRINTS, "bits"]
    classes = rows.groupBy("class").agg(F.min(F.struct("id", "h")).alias("row"), *(F.first(c).alias(c) for c in columns))
    classes = cut(classes.select("class", "row.id", "row.h", *columns), "classes")
    found = components_of(classes, texts, words, similarity)
    # Every class's least row, then every component's; what repeats wholly is one row.
    chosen = classes.join(found, F.col("class") == F.col("node"), "left").groupBy(F.coalesce("component", "class")).agg(F.min(F.struct("id", "h")).alias("row"))
    kept = cut(chosen.select(F.col("row.id").alias(f"{mark}id"), F.col("row.h").alias(f"{mark}h")), "kept-rows")
    repeated = bool(rows.groupBy("id", "h").count().where("count > 1").head(1))
    discard(rows, classes, found)
    out = named.join(kept, (F.col(id_col) == F.col(f"{mark}id")) & (digest == F.col(f"{mark}h")), "left_semi")
    if repeated:
        out = out.dropDuplicates(plain)
    return out.unionByName(df.where(F.col(id_col).isNull()))
