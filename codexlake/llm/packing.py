"""Best-fit packing of tokenised documents into sequences.

Bins have three capacities: tokens, documents and attention cost (the sum of
squared piece lengths).  Pieces come longest first; each goes to the open bin that
the rule prefers among those where it fits every capacity: ``norm`` leaves the
smallest weighted residual norm, ``dot`` has the largest weighted dot product of
demand and residual.  A new bin is opened only if none fits.

Placing a run whole equals placing its pieces one by one under ``norm``, where the
bin just chosen stays the best until it is full; ``dot`` fills a chosen bin too.

A piece's demand follows from its length alone, so the plan needs just the number
of pieces of each length: at most ``max_tokens`` numbers, however large the
corpus.  Bins with equal residuals are one class with a count, so whole runs are
placed at once, with the same outcome as one by one.  Pieces then find their
place by their rank among those of equal length.

Defined cases: a null text counts as empty; an empty text is one piece with the
end id alone; a very long text is cut into pieces of ``max_tokens``, the first one
shorter; the string of an added token is that token; repeated rows and null ids are
packed separately; ties between bins go to the one opened first; an empty table
gives no rows; other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codexlake.llm.common import cut, on_workers, tidy

#: How a byte-level tokenizer file of this kind splits text before its merges.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space in runs that the rank engine's backtracking may not get through.
_LONG_SPACE = re.compile(r"\s{1000}")


def token_bytes(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """The bytes behind a byte-level vocabulary, where printable Latin-1 stands for itself."""
    plain = [b for b in range(256) if chr(b).isprintable() and chr(b) != " "]
    letters = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)}
    return {bytes(map(letters.__getitem__, t)): i for t, i in vocabulary.items()}


def ranks_suffice(path: str) -> bool:
    """Whether merging by the rank of the merged token gives the ids that the file's merge list gives.

    It does if ids ascend with the merges and every token, taken alone, encodes to
    itself.  Merges within a span that is never crossed go as they go for the span
    alone, so before a token's own merge its span is in the one state that this merge
    takes, whatever pair of neighbours could also spell it.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, split = file["model"], file["pre_tokenizer"] or {}
    usual = {"dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "byte_fallback": False, "ignore_merges": False}
    if file["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) or model["type"] != "BPE":
        return False
    if any((model.get(k) or v) != v for k, v in usual.items()):
        return False
    vocabulary = model["vocab"]
    merged = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:], strict=False)) or len(merged) + 256 != len(vocabulary):
        return False
    alone = Tokenizer.from_str(json.dumps(file | {"pre_tokenizer": None, "added_tokens": []}))
    found = alone.encode_batch_fast(list(vocabulary), add_special_tokens=False)
    return all(e.ids == [i] for e, i in zip(found, vocabulary.values(), strict=True))


class Encoder:
    """Token ids of one text as little-endian uint32 bytes; nothing is remembered between texts.

    Where ``ranks_suffice``, the file's merges run in the rank engine, at a third of
    the cost.  Texts with an added token's string, and those with very long runs of
    white space, go to the tokenizer itself.
    """

    def __init__(self, path: str, by_ranks: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path, self.ranked, self.odd, self._whole = path, None, None, None
        if by_ranks:
            import tiktoken

            with open(path, encoding="utf-8") as f:
                file = json.load(f)
            self.ranked = tiktoken.Encoding("file", pat_str=_SPLIT, mergeable_ranks=token_bytes(file["model"]["vocab"]), special_tokens={})
            self.odd = re.compile("|".join([*(re.escape(t["content"]) for t in file["added_tokens"]), _LONG_SPACE.pattern]))

    def whole(self, text: str) -> list[int]:
        """Ids by the tokenizer itself."""
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self.path)
        return self._whole.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, text: str) -> bytes:
        ids = self.whole(text) if self.ranked is None or self.odd.search(text) else self.ranked.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()


#: Of this worker process: tasks share the loaded tables.
_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder_of(path: str, by_ranks: bool) -> Encoder:
    """The worker's encoder; a module's function, so that pickling leaves it where it is."""
    if (path, by_ranks) not in _ENCODERS:
        _ENCODERS[path, by_ranks] = Encoder(path, by_ranks)
    return _ENCODERS[path, by_ranks]


@dataclass
class Run:
    """``count`` pieces of one length, by rank, in like bins: ``per_bin`` to each."""

    first: int
    count: int
    per_bin: int
    bin: int
    offset: int


def cut_points(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the first may be shorter."""
    head = n % size or size
    return [(0, head)] + [(s, size) for s in range(head, n, size)]


def plan(counts: dict[int, int], capacities: tuple[int, int, int], weights: tuple[float, float, float], rule: str = "norm") -> dict[int, list[Run]]:
    """Runs by length for so many pieces of each length.

    A class is the bins with equal residuals, as spans of bin numbers.  A run fills
    each of a class's first bins with as many pieces as fit.
    """
    cap = np.array(capacities, float)
    weight = np.array(weights, float)
    classes: dict[tuple[int, int, int], list[tuple[int, int]]] = defaultdict(list)  # residual -> [(first bin, bins)]
    runs: dict[int, list[Run]] = defaultdict(list)
    bins = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        demand = (length, 1, length * length)
        if any(d > c for d, c in zip(demand, capacities, strict=True)):
            raise ValueError(f"a piece of {length} tokens fits no empty bin")

        def fits(residual: tuple[int, int, int]) -> int:
            return min(r // d for r, d in zip(residual, demand, strict=True))

        open_ = [r for r in classes if fits(r)]
        if open_:
            residuals = np.array(open_, float)
            if rule == "norm":
                score = ((((residuals - demand) / cap) ** 2) * weight).sum(1)
            else:
                score = -((residuals / cap) * (np.array(demand) / cap) * weight).sum(1)
            queue = [(float(s), r) for s, r in zip(score, open_, strict=True)]
            heapq.heapify(queue)
        else:
            queue = []
        while left:
            if queue:
                residual = heapq.heappop(queue)[1]
                spans = classes.pop(residual)
            else:
                residual, each = capacities, fits(capacities)
                spans = [(bins, -(-left // each))]
                bins += spans[0][1]
            each, filled, kept = fits(residual), capacities[0] - residual[0], []
            for first, number in spans:
                full = min(number, left // each)
                steps = [(first, full, each)] if full else []
                if full < number and left % each and left < (full + 1) * each:
                    steps.append((first + full, 1, left - full * each))
                for start, n, per in steps:
                    runs[length].append(Run(rank, n * per, per, start, filled))
                    classes[tuple(r - per * d for r, d in zip(residual, demand, strict=True))].append((start, n))
                    rank += n * per
                    left -= n * per
                used = sum(n for _, n, _ in steps)
                if used < number:
                    kept.append((first + used, number - used))
            if kept:
                classes[residual] += kept
    return dict(runs)


def pack(
    df: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_tokens: int = 1024,
    max_documents: int | None = None,
    max_attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3),
    rule: str = "norm",
    end_id: int = 2,
) -> DataFrame:
    """Pieces of every document with their sequence and offset.

    Without ``max_documents`` and ``max_attention`` those capacities are as large
    as ``max_tokens`` alone allows, so only tokens bind.  The tokenizer file lies at
    the same path everywhere.
    """
    by_ranks = ranks_suffice(tokenizer_path)

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path, by_ranks)
        part, ranks, end = TaskContext.get().partitionId(), defaultdict(int), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            owner: list[int] = []
            for n, text in enumerate(batch.column(1)):
                ids = encoder.encode(text.as_py() or "") + end
                for piece, (start, length) in enumerate(cut_points(len(ids) // 4, max_tokens)):
                    owner.append(n)
                    rows.append((piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), ranks[length]))
                    ranks[length] += 1
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True)), pa.array([part] * len(rows), pa.int32())],
                ["id", "piece", "start", "length", "ids_crc32", "_rank", "_part"],
            )
        tidy()

    kind = df.schema[id_col].dataType.simpleString()
    pieces = cut(
        on_workers(df).select(id_col, text_col).mapInArrow(tokenise, f"id {kind}, piece int, start long, length long, ids_crc32 long, _rank long, _part int"), "pieces"
    )
    # Ranks run within a task; the sums before each (length, task) make them global.
    tallies = cut(pieces.groupBy("length", "_part").agg(F.count("*").alias("_n")), "tallies")
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = tallies.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    counts = {r["length"]: r["n"] for r in tallies.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most max_tokens rows
    capacities = (max_tokens, max_documents or max_tokens, max_attention or max_tokens * max_tokens)
    runs = plan(counts, capacities, weights, rule)
    # Runs: a bounded table by length, searched by rank.
    table = {n: tuple(np.array(c, np.int64) for c in zip(*((r.first, r.per_bin, r.bin, r.offset) for r in own), strict=True)) for n, own in runs.items()}
    shared = df.sparkSession.sparkContext.broadcast(table)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("length", "_rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length).tolist():
                rows = np.flatnonzero(length == n)
                first, per, start, filled = shared.value[n]
                at = np.searchsorted(first, rank[rows], "right") - 1
                within = rank[rows] - first[at]
                sequence[rows] = start[at] + within // per[at]
                offset[rows] = filled[at] + within % per[at] * n
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"])

    ranked = pieces.join(bases.drop("_n"), ["length", "_part"]).select("id", "piece", "start", "length", "ids_crc32", (F.col("_rank") + F.col("_base")).alias("_rank"))
    placed = ranked.mapInArrow(place, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return placed.withColumnRenamed("id", id_col)
