"""SentencePiece encoding and decoding with N-best segmentations.

The pieces of a text form a lattice over its characters.  A forward Viterbi pass
gives every position the best score of reaching it from the start.  A backward A*
search from the end uses those as its heuristic; they are exact, so complete paths
leave the agenda in order of score and the n-th to leave is the n-th best.

No piece spans some places, a change to a space above all, and there the lattice
falls into chunks.  Best paths join chunk by chunk; an n-best path of the text
differs from the best one only in the n - 1 chunks whose second path costs least,
and only those are searched further.

Scores and pieces are the model file's.  A character that is no piece becomes its
UTF-8 bytes, at the least score of any piece less 10.

Defined cases: a null or empty text has no pieces and one segmentation, the empty
one; equal scores come in the same order each time; a text with fewer than n
segmentations has all of them; ids that are no piece decode to U+2047; a very long
text, or a long run that no piece spans, takes time in proportion; repeated rows give
equal results; an empty table gives none; other columns, whatever their names, are
not read.
"""

from __future__ import annotations

import heapq
import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from codexlake.llm.common import on_workers, texts_of

SPACE = "▁"
_NONE = (b"", 0)
#: The cost of a second path where there is none.
NEVER = 1 << 60


def none_at(found: list) -> list[int]:
    """Where a list holds None."""
    out, at = [], -1
    try:
        while True:
            at = found.index(None, at + 1)
            out.append(at)
    except ValueError:
        return out


class PieceModel:
    """Pieces and scores of a SentencePiece file, with a bounded memory of chunks.

    ``memory`` bounds its bytes, at what a chunk, its ids and its entry take.
    """

    def __init__(self, path: str, memory: int = 320 << 20):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        self.byte_ids: dict[int, int] = {}
        self.table: dict[str, tuple[bytes, int]] = {}  # piece -> (id as bytes, score); a mere beginning of pieces -> _NONE
        self.out: list[bytes] = []
        pairs: set[str] = set()
        scores = []
        for k in range(sp.get_piece_size()):
            piece = sp.id_to_piece(k)
            if sp.is_byte(k):
                self.byte_ids[int(piece[3:5], 16)] = k
                self.out.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(k) or sp.is_unknown(k):
                self.out.append("⁇".encode() if sp.is_unknown(k) else b"")
            else:
                self.table[piece] = (k.to_bytes(4, "little"), int(sp.get_score(k)))
                self.out.append(piece.replace(SPACE, " ").encode())
                pairs.update(piece[i : i + 2] for i in range(len(piece) - 1))
                if sp.get_score(k) > -1e8:
                    scores.append(int(sp.get_score(k)))
        for piece in list(self.table):
            for i in range(1, len(piece)):
                self.table.setdefault(piece[:i], _NONE)
        self.pairs, self.unknown, self.memory = pairs, min(scores, default=0) - 10, memory
        self.known: dict[str, tuple[bytes, int, int]] = {}
        # Cut before a space that follows another character, and around line ends, if no piece spans there.
        spaced = not any(p[1] == SPACE and p[0] != SPACE for p in pairs)
        lined = not any("\n" in p for p in self.table)
        body = f"[^{SPACE}\n]" if lined else f"[^{SPACE}]"
        self.cutter = re.compile(f"{SPACE}*{body}+|{SPACE}+|\n") if spaced else re.compile(r"(?s).+")

    def lattice(self, text: str) -> tuple[list[int], list[list[tuple[int, bytes, int]]]]:
        """Forward Viterbi scores, and each position's edges (from, ids, score)."""
        n, get = len(text), self.table.get
        best = [0] + [-(1 << 60)] * n
        into: list[list[tuple[int, bytes, int]]] = [[] for _ in range(n + 1)]
        for i in range(n):
            base = best[i]
            single = False
            j = i + 1
            while j <= n and (hit := get(text[i:j])) is not None:
                if hit is not _NONE:
                    single = single or j == i + 1
                    into[j].append((i, *hit))
                    if base + hit[1] > best[j]:
                        best[j] = base + hit[1]
                j += 1
            if not single:
                into[i + 1].append((i, *self._spelled(text[i])))
                if base + self.unknown > best[i + 1]:
                    best[i + 1] = base + self.unknown
        return best, into

    def _spelled(self, character: str) -> tuple[bytes, int]:
        """The bytes of a character that is no piece, and their score."""
        return b"".join(self.byte_ids[b].to_bytes(4, "little") for b in character.encode("utf-8", "surrogatepass")), self.unknown

    def first_two(self, text: str) -> tuple[bytes, int, int]:
        """Ids and score of the best path, and what the second costs (NEVER: none).

        The second path leaves the best one somewhere by the next best edge into a
        place, so each place keeps its two best ways in and no list of edges.
        """
        n, get, low = len(text), self.table.get, -(1 << 62)
        best, second, came = [0] + [low] * n, [low] * (n + 1), [(0, _NONE)] * (n + 1)
        for i in range(n):
            base, j, single = best[i], i + 1, False
            hit = get(text[i:j])
            while hit is not None:
                if hit is not _NONE:
                    single = single or j == i + 1
                    value = base + hit[1]
                    if value > best[j]:
                        second[j], best[j], came[j] = best[j], value, (i, hit)
                    elif value > second[j]:
                        second[j] = value
                j += 1
                if j > n:
                    break
                hit = get(text[i:j])
            if not single:
                hit, j = self._spelled(text[i]), i + 1
                value = base + hit[1]
                if value > best[j]:
                    second[j], best[j], came[j] = best[j], value, (i, hit)
                elif value > second[j]:
                    second[j] = value
        at, cost, ids = n, NEVER, []
        while at:
            if second[at] > low and best[at] - second[at] < cost:
                cost = best[at] - second[at]
            at, hit = came[at]
            ids.append(hit[0])
        return b"".join(reversed(ids)), best[n], cost

    def search(self, text: str, n: int) -> list[tuple[int, bytes]]:
        """The n best paths (score, ids), by A* from the end.

        Among equals the one nearest the start goes first, so that the many ties of
        a long repeated character do not all have to be opened.
        """
        best, into = self.lattice(text)
        agenda: list[tuple] = [(-best[-1], len(text), 0, 0, None)]
        out: list[tuple[int, bytes]] = []
        order = 0
        while agenda and len(out) < n:
            _, at, _, score, path = heapq.heappop(agenda)
            if not at:
                ids = []
                while path:
                    ids.append(path[0])
                    path = path[1]
                out.append((score, b"".join(ids)))
                continue
            for start, ids, own in into[at]:
                order += 1
                heapq.heappush(agenda, (-(score + own + best[start]), start, order, score + own, (ids, path)))
        return out

    def _learn(self, chunk: str) -> tuple[bytes, int, int]:
        pairs, cuts = self.pairs, [0]
        cuts += [i for i in range(1, len(chunk)) if chunk[i - 1 : i + 1] not in pairs]  # no piece holds both characters
        if len(cuts) == 1:
            own = self.first_two(chunk)
        else:
            parts = []
            for low, high in zip(cuts, [*cuts[1:], len(chunk)], strict=True):
                part = chunk[low:high]
                if (found := self.known.get(part)) is None:
                    found = self._keep(part, self.first_two(part))
                parts.append(found)
            ids, scores, costs = zip(*parts, strict=True)
            own = (b"".join(ids), sum(scores), min(costs))
        return self._keep(chunk, own)

    def _keep(self, chunk: str, own: tuple[bytes, int, int]) -> tuple[bytes, int, int]:
        """Remembers a chunk, unless it is so long that it hardly comes again."""
        if self.memory > 0 and len(chunk) <= 256:
            self.known[chunk] = own
            self.memory -= sys.getsizeof(chunk) + sys.getsizeof(own[0]) + 250  # the tuple, its numbers and the place in the table
        return own

    def chunks(self, text: str) -> list[str]:
        """The text with its leading space marker, where no piece spans a cut."""
        return self.cutter.findall(f"{SPACE}{text.replace(' ', SPACE)}") if text else []

    def encode(self, text: str, n: int = 1) -> list[tuple[int, bytes]]:
        """The n best segmentations as (score, little-endian 32-bit ids)."""
        chunks = self.chunks(text)
        if not chunks:
            return [(0, b"")]
        known = list(map(self.known.get, chunks))
        for at in none_at(known):
            known[at] = self.known.get(chunks[at]) or self._learn(chunks[at])
        ids, scores, costs = zip(*known, strict=True)
        first = (sum(scores), b"".join(ids))
        if n == 1:
            return [first]
        left, places = list(costs), []
        while len(places) < n - 1 and (least := min(left)) < NEVER:
            places.append(left.index(least))
            left[places[-1]] = NEVER
        # Of equal paths the search may find others first; the one chosen above leads.
        paths = [[(scores[i], ids[i]), *(p for p in self.search(chunks[i], n) if p[1] != ids[i])][:n] for i in places]
        agenda, seen, out = [(0, (0,) * len(places))], {(0,) * len(places)}, []
        while agenda and len(out) < n:
            lost, choice = heapq.heappop(agenda)
            if out:
                own = list(ids)
                for i, p, k in zip(places, paths, choice, strict=True):
                    own[i] = p[k][1]
                out.append((first[0] - lost, b"".join(own)))
            else:
                out.append(first)
            for q, k in enumerate(choice):
                if k + 1 < len(paths[q]) and (then := (*choice[:q], k + 1, *choice[q + 1 :])) not in seen:
                    seen.add(then)
                    heapq.heappush(agenda, (lost + paths[q][k][0] - paths[q][k + 1][0], then))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes joined, the leading space marker gone."""
        size, out = len(self.out), self.out
        if ids and min(ids) >= 0 and max(ids) < size:
            raw = b"".join(map(out.__getitem__, ids))
        else:
            raw = b"".join([out[k] if 0 <= k < size else "⁇".encode() for k in ids])
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


#: Of this worker process: what one task has learnt serves the next.
_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", n: int = 3) -> DataFrame:
    """(id, rank, score, ids): the n best segmentations of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(model_path)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows = [(k, rank, score, np.frombuffer(ids, "<i4")) for k, t in enumerate(texts_of(part.column(1))) for rank, (score, ids) in enumerate(own.encode(t, n), 1)]
                where, rank, score, ids = zip(*rows, strict=True) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(where, pa.int64())), pa.array(rank, pa.int32()), pa.array(score, pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["id", "rank", "score", "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return on_workers(df).select(id_col, text_col).mapInArrow(run, f"id {kind}, rank int, score long, ids array<int>").withColumnRenamed("id", id_col)


def decode(df: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of a column of ids; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(model_path)
        for batch in batches:
            texts = [None if ids is None else own.decode([-1 if k is None else k for k in ids]) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    kind = df.schema[id_col].dataType.simpleString()
    return on_workers(df).select(id_col, ids_col).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def digest(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", n: int = 3) -> DataFrame:
    """Per row: pieces, score and CRC-32 of the best ids, all n as text, and whether decoding restores the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(model_path)
        for batch in batches:
            rows = []
            for text in texts_of(batch.column(1)):
                paths = own.encode(text, n)
                score, ids = paths[0]
                back = own.decode(np.frombuffer(ids, "<i4").tolist())
                rows.append((len(ids) // 4, score, zlib.crc32(ids), len(paths), ",".join(f"{s}:{len(i) // 4}:{zlib.crc32(i)}" for s, i in paths), back == text))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], ["id", "n_pieces", "score", "ids_crc32", "n_best", "best", "restored"]
            )

    kind = df.schema[id_col].dataType.simpleString()
    return on_workers(df).select(id_col, text_col).mapInArrow(run, f"id {kind}, n_pieces long, score long, ids_crc32 long, n_best int, best string, restored boolean").withColumnRenamed("id", id_col)
