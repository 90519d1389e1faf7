"""Log-likelihood of whole documents under a gated recurrent language model.

The base score is an add-0.1 unigram model whose counts cover every training
document.  The model is a GRU in numpy over the most frequent words, as many as the
square root of the counted tokens at least, with an output softmax factored by
frequency classes: P(word) = P(class | state) P(word | class, state).  It starts
from a bounded sample on the driver; then each task goes on from there by truncated
backpropagation over all its training rows, and the tasks' weights are averaged by
the symbols they saw.  A rarer
word is the symbol ``other`` times its share of the rare words' unigram mass, so
every text has a proper probability.  Documents are scored in lanes: a lane reads
one document after another in windows, and its state is carried from window to
window and cleared where a document begins.

Counts: the most frequent words, a bounded number, are sent to all tasks; each
document's rarer words are joined with the table of counts by word, which grows
with the corpus and stays distributed.

Defined cases: a null text counts as empty; an empty text is the end symbol alone;
without training rows every count is 0 and the model is uniform; very long texts are
scored whole and learnt in pieces; repeated rows are scored separately, alike; an
empty table gives none; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexlake.llm.common import cut, hash_sample, on_workers, tidy

END = b"\n"  # no word holds a line end
_LN10 = math.log(10.0)


def _bounded(w: np.ndarray, b: np.ndarray) -> bool:
    """Whether no logit of a state, whose entries are within -1 and 1, can overflow an exponential."""
    return float((np.ones(len(w), w.dtype) @ np.abs(w) + np.abs(b)).max()) < 60


def _order(keys: np.ndarray) -> np.ndarray:
    """A stable order of small numbers; short ones are sorted by radix."""
    return np.argsort(keys.astype(np.uint16) if len(keys) and keys.max() < 1 << 16 else keys, kind="stable")


def _sum_by(rows: np.ndarray, keys: np.ndarray, many: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and the sums of their rows (of each of some parts, which come first).

    Rare keys are added up together, the frequent ones each at once.
    """
    order = _order(keys)
    ordered = keys[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    counts = np.diff(np.r_[first, len(keys)])
    by = np.argsort(-counts, kind="stable")
    first, counts = first[by], counts[by]
    out = np.take(rows, order[first], axis=1)
    frequent = int(np.searchsorted(-counts, -many, "right"))
    for k in range(1, many):
        end = int(np.searchsorted(-counts, -k, "left"))  # those that occur more than k times
        if end <= frequent:
            break
        out[:, frequent:end] += np.take(rows, order[first[frequent:end] + k], axis=1)
    ones = np.ones(int(counts[0]), rows.dtype)
    for k, (low, n) in enumerate(zip(first[:frequent].tolist(), counts[:frequent].tolist(), strict=True)):
        out[:, k] = ones[:n] @ np.take(rows, order[low : low + n], axis=1)
    return ordered[first], out


def _adam(p: np.ndarray, m: np.ndarray, v: np.ndarray, g: np.ndarray, step: int, rate: float, block: int = 1 << 14) -> None:
    """One step of Adam in place, for flat arrays.  Means are kept 10 and 100 times as large; blocks stay in a core's cache."""
    root = math.sqrt(1 - 0.99**step)
    rate, least, room = rate * root / (1 - 0.9**step), 1e-6 * root, np.empty(min(block, len(g)), g.dtype)
    for low in range(0, len(g), block):
        gb, mb, vb = g[low : low + block], m[low : low + block], v[low : low + block]
        t = room[: len(gb)]
        np.multiply(gb, gb, out=t)
        vb *= 0.99
        vb += t
        mb *= 0.9
        mb += gb
        np.sqrt(vb, out=t)
        t += least
        np.divide(mb, t, out=t)
        t *= rate
        p[low : low + block] -= t


def _clip(g: np.ndarray, square: float | None = None) -> None:
    """A gradient made no longer than 1; ``square`` is its squared length, where that is known."""
    square = float(np.vdot(g, g)) if square is None else square
    if square > 1:
        g *= 1 / math.sqrt(square)


@dataclass
class GruModel:
    """Symbols are words by falling count; 0 is ``other``.  Classes split them in order."""

    words: dict[bytes, int]
    classes: np.ndarray  # symbol -> class
    starts: np.ndarray  # class -> first symbol, and one more
    p: dict[str, np.ndarray]

    @property
    def hidden(self) -> int:
        return self.p["u"].shape[0]

    @classmethod
    def new(cls, words: list[bytes], hidden: int, n_classes: int, seed: int) -> GruModel:
        size = len(words) + 1
        n_classes = max(1, min(n_classes, size))
        # Classes grow with rank: where counts fall as 1 / rank, a target's class is then smallest on average.
        edges = np.unique(np.r_[0, np.maximum((size * (np.arange(1, n_classes + 1) / n_classes) ** 2).round(), np.arange(1, n_classes + 1))]).astype(np.int64)
        n_classes = len(edges) - 1
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) * 0.1).astype(np.float32)
        p = {"x": draw(size + 1, 3 * hidden), "u": draw(hidden, 3 * hidden), "c": draw(hidden, n_classes), "cb": np.zeros(n_classes, np.float32), "w": draw(hidden, size), "wb": np.zeros(size, np.float32)}
        return cls({w: k + 1 for k, w in enumerate(words)}, np.repeat(np.arange(n_classes), np.diff(edges)), edges, p)

    def forward(self, inputs: np.ndarray, fresh: np.ndarray, state: np.ndarray, keep: bool = False):
        """States after each of T steps; ``fresh`` says where a lane's state is cleared.

        Inputs are symbols, or the number of symbols where a document begins.  Gates and
        candidates lie apart, each without gaps.
        """
        h, (n, lanes) = self.hidden, inputs.shape
        kind = self.p["u"].dtype
        x = np.take(self.p["x"].reshape(-1, h), inputs.astype(np.int64) * 3 + np.arange(3)[:, None, None], axis=0)  # reset, update, candidate
        x[:2] *= 0.5
        u = self.p["u"].reshape(h, 3, h).transpose(1, 0, 2)
        ug, uc = u[:2] * kind.type(0.5), np.ascontiguousarray(u[2])
        states, start = np.empty((n, lanes, h), kind), state
        pair, room = np.empty((2, lanes, h), kind), np.empty((lanes, h), kind)
        clear = _by_step(fresh)
        for t in range(n):
            gates, candidate, new = x[:2, t], x[2, t], states[t]
            if len(clear[t]):
                state = state.copy()
                state[clear[t]] = 0
            np.matmul(state, ug, out=pair)
            gates += pair
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            np.multiply(gates[0], state, out=room)
            candidate += np.matmul(room, uc, out=pair[0])
            np.tanh(candidate, out=candidate)
            np.subtract(state, candidate, out=new)
            new *= gates[1]
            new += candidate
            state = new
        saved = None
        if keep:
            before = np.empty_like(states)
            before[:1], before[1:] = start, states[:-1]
            before[fresh] = 0
            saved = (before, x[:2], x[2])
        return states, state.copy(), saved

    def log_probabilities(self, states: np.ndarray, targets: np.ndarray, step: int = 2048, layers: list | None = None) -> np.ndarray:
        """Natural log of P(target | state), for flat states and targets."""
        layers = layers or self._layers()
        order = _order(self.classes[targets])
        found = np.empty((2, len(targets)), layers[0][0].dtype)
        whole = np.empty_like(found)
        for _ in self._parts(_with_one(states, found.dtype, order), targets[order], layers, found, whole, step):
            pass
        found -= np.log(whole, out=whole)
        out = np.empty(len(targets), found.dtype)
        out[order] = found[0] + found[1]
        return out

    def _layers(self) -> list[tuple[np.ndarray, bool]]:
        """Of the softmax over classes and that over words: a row of weights and bias for each unit, and whether logits are bounded."""
        return [(np.concatenate([self.p[w], self.p[b][None]]).T.copy(), _bounded(self.p[w], self.p[b])) for w, b in (("c", "cb"), ("w", "wb"))]

    def _parts(self, flat: np.ndarray, targets: np.ndarray, layers: list, found: np.ndarray, whole: np.ndarray, step: int = 2048, room: int = 1 << 18) -> Iterator[tuple[int, slice, np.ndarray, np.ndarray, list]]:
        """Exponentials of logits, and their sums (``whole``) and targets' logits (``found``), for both layers.

        Rows come in the order of their classes.  Some blocks at a time, as many as a core's
        cache holds: (layer, rows, exponentials, places of the targets, blocks), where a
        block is (rows, units, its exponentials).
        """
        group, kind = self.classes[targets], flat.dtype
        bounds, starts, n = np.searchsorted(group, np.arange(len(self.starts))).tolist(), self.starts.tolist(), len(targets)
        ones = np.ones(int(np.diff(self.starts).max(initial=len(starts) - 1)), kind)
        cuts = [(low, min(n, low + step), 0, len(starts) - 1) for low in range(0, n, step)], [
            (low, min(last, low + step), starts[k], starts[k + 1]) for k, (first, last) in enumerate(zip(bounds, bounds[1:], strict=False)) for low in range(first, last, step)
        ]
        most = max([room, *((high - low) * (end - start) for own in cuts for low, high, start, end in own)])
        held = np.empty(most, kind)
        for layer, (w, bounded) in enumerate(layers):
            units, own = (np.full(n, len(starts) - 1), group) if layer == 0 else (np.diff(self.starts)[group], targets - self.starts[group])
            place = np.cumsum(units) - units + own
            blocks, at, used, base = [], 0, 0, 0
            for low, high, start, end in [*cuts[layer], (n, n, 0, most + 1)]:
                size = (high - low) * (end - start)
                if blocks and (low == n or used + size > most):
                    rows, part = slice(at, low), held[:used]
                    here = place[rows] - base
                    found[layer, rows] = part[here]
                    np.exp(part, out=part)
                    for r, u, x in blocks:
                        np.matmul(x, ones[: u.stop - u.start], out=whole[layer, r])
                    yield layer, rows, part, here, blocks
                    blocks, at, base, used = [], low, base + used, 0
                if low < n:
                    x = held[used : used + size].reshape(high - low, end - start)
                    np.matmul(flat[low:high], w[start:end].T, out=x)
                    if not bounded:
                        x -= x.max(1, keepdims=True)
                    blocks.append((slice(low, high), slice(start, end), x))
                    used += size

    def train(self, documents: list[np.ndarray], lanes: int = 64, window: int = 32, epochs: int = 1, rate: float = 0.01, decay: float = 0.2, context: list[int] | None = None) -> float:
        """Adam with backpropagation cut off at each window's start; mean loss."""
        p, h = self.p, self.hidden
        layers = self._layers()
        own = {"x": p["x"], "u": p["u"], "c": layers[0][0], "w": layers[1][0]}  # the last two with their biases, a row for each unit
        first, second = ({k: np.zeros_like(v) for k, v in own.items()} for _ in range(2))
        step, losses = 0, []
        plan = lane_plan([len(d) for d in documents], lanes)
        total = max((sum(len(documents[d]) for d in lane) for lane in plan), default=0) // window * epochs + 1
        for _ in range(epochs):
            for inputs, fresh, targets, mask in windows(documents, plan, window, len(self.classes), context):
                if step == 0 or fresh.shape[1] != state.shape[0]:  # noqa: F821
                    state = np.zeros((fresh.shape[1], self.hidden), np.float32)
                if step % 8 == 0:  # eight steps move no logit by more than 8 * 2.4 * rate * (hidden + 1)
                    layers = [(w, _bounded(w[:, :h].T, w[:, h])) for w, _ in layers]
                states, state_after, saved = self.forward(inputs, fresh, state, keep=True)
                keys, g, loss = self._gradients(inputs, fresh, targets, mask, states, saved, layers)
                state, step = state_after, step + 1
                losses.append(loss)
                lr = rate * (decay + (1 - decay) * (1 - step / (total + 1)))
                for k in ("c", "w"):
                    both, bias = float(np.vdot(g[k], g[k])), float(np.vdot(g[k][:, h], g[k][:, h]))
                    _clip(g[k][:, :h], both - bias)
                    _clip(g[k][:, h], bias)
                for k in ("c", "w", "u"):
                    if k == "u":
                        _clip(g[k])
                    _adam(*(a.reshape(-1) for a in (own[k], first[k], second[k], g[k])), step, lr)
                _clip(g["x"])
                seen = [np.take(a["x"], keys, axis=0) for a in (own, first, second)]  # of inputs that did not occur nothing is touched
                _adam(*(a.reshape(-1) for a in (*seen, g["x"])), step, lr)
                own["x"][keys], first["x"][keys], second["x"][keys] = seen
        for w, b in (("c", "cb"), ("w", "wb")):
            p[w], p[b] = own[w][:, :h].T.copy(), own[w][:, h].copy()
        return float(np.mean(losses[-50:])) if losses else 0.0

    def _backward(self, inputs, fresh, targets, mask, states, saved):
        """Of each weight the rows that have a gradient, and it; the loss."""
        keys, g, loss = self._gradients(inputs, fresh, targets, mask, states, saved, self._layers())
        for k in ("c", "w"):
            g[k], g[k + "b"] = g[k][:, :-1].T, g[k][:, -1]
        return {k: (keys if k == "x" else slice(None), v) for k, v in g.items()}, loss

    def _gradients(self, inputs, fresh, targets, mask, states, saved, layers):
        p, h = self.p, self.hidden
        kind = p["u"].dtype
        live = np.flatnonzero(mask.ravel())
        live = live[_order(self.classes[targets.ravel()[live]])]  # by class from here on
        flat = _with_one(states.reshape(-1, h), kind, live)
        scale = 1.0 / max(1, len(live))
        d_flat, room = np.empty((len(live), h), kind), np.empty((len(live), h), kind)
        g = {"c": np.zeros_like(layers[0][0]), "w": np.zeros_like(layers[1][0])}
        found, whole = np.empty((2, len(live)), kind), np.empty((2, len(live)), kind)
        for layer, rows, part, own, blocks in self._parts(flat, targets.ravel()[live], layers, found, whole):
            w, g_w, d = layers[layer][0], g["cw"[layer]], room if layer else d_flat
            part[own] -= whole[layer, rows]
            # Probabilities are parts of a whole: what is narrow is divided by it, not all parts.
            share = (scale / whole[layer, rows])[:, None]
            shared, at = flat[rows] * share, rows.start
            for r, u, x in blocks:
                g_w[u] += x.T @ shared[r.start - at : r.stop - at]
                np.matmul(x, w[u, :h], out=d[r])
            d[rows] *= share
        d_flat += room
        loss = float((np.log(whole) - found).sum()) if len(live) else 0.0
        d_states = np.zeros((states.shape[0] * states.shape[1], h), kind)
        d_states[live] = d_flat
        d_states = d_states.reshape(states.shape)
        back = np.zeros(states.shape[1:], kind)
        before, gates, candidate = saved
        d_x = np.empty((3, *states.shape), kind)  # reset, update, candidate
        reset, update, u = gates[0], gates[1], p["u"].reshape(h, 3, h)
        # The derivatives by what each unit is fed, but for what comes from later steps.
        mixed = before * reset
        of_reset = np.subtract(1, reset)
        of_reset *= mixed
        of_candidate = np.multiply(candidate, candidate)
        np.subtract(1, of_candidate, out=of_candidate)
        rest = np.subtract(1, update)
        of_candidate *= rest
        of_update = np.subtract(before, candidate)
        of_update *= update
        of_update *= rest
        ug, uc = np.ascontiguousarray(u[:, :2].transpose(1, 2, 0)), np.ascontiguousarray(u[:, 2].T)
        pair, d_mixed, clear = np.empty((2, *back.shape), kind), np.empty_like(back), _by_step(fresh)
        for t in range(len(inputs) - 1, -1, -1):
            back += d_states[t]
            np.multiply(back, of_candidate[t], out=d_x[2, t])
            np.matmul(d_x[2, t], uc, out=d_mixed)
            np.multiply(d_mixed, of_reset[t], out=d_x[0, t])
            np.multiply(back, of_update[t], out=d_x[1, t])
            np.matmul(d_x[:2, t], ug, out=pair)
            back *= update[t]
            d_mixed *= reset[t]
            back += d_mixed
            back += pair[0]
            back += pair[1]
            if len(clear[t]):
                back[clear[t]] = 0
        of_u = [(a.transpose(0, 2, 1) @ d).sum(0) for a, d in zip((before, before, mixed), d_x, strict=True)]  # step by step, as caches hold
        g["u"] = np.concatenate(of_u, axis=1)
        keys, by_key = _sum_by(d_x.reshape(3, -1, h), inputs.ravel())
        g["x"] = np.concatenate(list(by_key), axis=1)
        return keys, g, loss * scale

    def score(self, documents: list[np.ndarray], lanes: int = 256, window: int = 64) -> np.ndarray:
        """Natural log-likelihood of each document's symbols."""
        out = np.zeros(len(documents))
        plan = lane_plan([len(d) for d in documents], lanes)
        layers = self._layers()
        state, at = np.zeros((len(plan), self.hidden), np.float32), 0
        owner = np.array([d for lane in plan for d in lane], np.int64).repeat([len(documents[d]) for lane in plan for d in lane])
        low = np.cumsum([0, *(sum(len(documents[d]) for d in lane) for lane in plan)])[:-1]
        for inputs, fresh, targets, mask in windows(documents, plan, window, len(self.classes)):
            n, k = inputs.shape  # lanes that have ended are the last ones and are gone
            states, state, _ = self.forward(inputs, fresh, state[:k])
            live = mask.ravel()
            logs = self.log_probabilities(states.reshape(-1, self.hidden)[live], targets.ravel()[live], layers=layers)
            places = low[:k] + at + np.arange(n)[:, None]
            out += np.bincount(owner[places.ravel()[live]], logs, len(documents))
            at += window
        return out


def _by_step(fresh: np.ndarray) -> list[np.ndarray]:
    """The lanes that begin a document, of each step."""
    step, lane = np.nonzero(fresh)
    at = np.searchsorted(step, np.arange(len(fresh) + 1)).tolist()
    return [lane[low:high] for low, high in zip(at, at[1:], strict=False)]


def _with_one(a: np.ndarray, kind: np.dtype, order: np.ndarray) -> np.ndarray:
    """Rows in this order, each with a 1 at its end, by which a bias is multiplied."""
    out = np.empty((len(order), a.shape[1] + 1), kind)
    out[:, :-1], out[:, -1] = np.take(a, order, axis=0), 1
    return out


def lane_plan(sizes: list[int], lanes: int) -> list[list[int]]:
    """Documents dealt to lanes, longest first to the shortest lane; longest lane first."""
    heap = [(0, k) for k in range(max(1, min(lanes, len(sizes))))]
    out: list[list[int]] = [[] for _ in heap]
    for d in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        load, k = heapq.heappop(heap)
        out[k].append(d)
        heapq.heappush(heap, (load + sizes[d], k))
    return sorted(out, key=lambda lane: -sum(sizes[d] for d in lane))


def windows(documents: list[np.ndarray], plan: list[list[int]], window: int, begin: int, context: list[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(inputs, fresh, targets, mask) of each window, step by lane; ended lanes go.

    ``context`` gives the symbol before each document, where that is not ``begin``.
    """
    order = [d for lane in plan for d in lane]
    sizes = np.array([len(documents[d]) for d in order], np.int64)
    lengths = np.array([sum(len(documents[d]) for d in lane) for lane in plan], np.int64)
    low_of = np.cumsum(lengths) - lengths
    own = np.concatenate([documents[d] for d in order]) if order else np.empty(0, np.int32)
    heads = (np.cumsum(sizes) - sizes)[sizes > 0]
    before, head = np.empty(len(own), np.int32), np.zeros(len(own), bool)
    before[1:] = own[:-1]
    before[heads] = begin if context is None else np.array(context, np.int32)[order][sizes > 0]
    head[heads] = True
    for low in range(0, int(lengths.max(initial=0)), window):
        alive = int((lengths > low).sum())
        n = int(min(window, lengths[0] - low))
        at = low + np.arange(n)[:, None]
        mask = at < lengths[:alive]
        at = np.where(mask, low_of[:alive] + at, 0)
        inputs, targets, fresh = before[at], own[at].astype(np.int32, copy=False), head[at]
        if not mask.all():
            inputs[~mask], targets[~mask], fresh[~mask] = begin, 0, False
        yield inputs, fresh, targets, mask


def tokens(text: bytes) -> list[bytes]:
    """Words in lower case (A-Z only), and the end."""
    return [*text.lower().split(), END]


def slices_of(texts: pa.Array, most: int = 12 << 20) -> Iterator[pa.Array]:
    """A column in slices of at most so many bytes, or of one text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(sizes, (sizes[low - 1] if low else 0) + most, "right")))
        yield texts.slice(low, high - low)
        low = high


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All texts' words in lower case (A-Z only), as bytes, and how many each text has; null counts as empty."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, counts = split.flatten().cast(pa.binary()), np.diff(split.offsets.to_numpy())
    if len(words) and pc.min(pc.binary_length(words)).as_py() == 0:  # beside white space at an end there is an empty one
        real = pc.not_equal(words, b"")
        counts = np.bincount(np.repeat(np.arange(len(counts)), counts)[real.to_numpy(zero_copy_only=False)], minlength=len(counts))
        words = words.filter(real)
    return words, counts


def places_of(texts: pa.Array, known: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Each token's place among the known ones (-1: none), where each text's tokens end, and the unknown tokens."""
    words, counts = words_of(texts)
    ends = np.cumsum(counts + 1)
    words = pa.concat_arrays([words, pa.array([END], pa.binary())])
    found = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy()
    out = np.full(len(words) - 1 + len(counts), found[-1], np.int32)
    is_word = np.ones(len(out), bool)
    is_word[ends - 1] = False
    out[is_word] = found[:-1]
    at = np.full(len(out), len(words) - 1)
    at[is_word] = np.arange(len(words) - 1)
    return out, ends, words.take(pa.array(at[out < 0]))


def count_tokens(docs: DataFrame, text_col: str, limit: int = 300_000) -> DataFrame:
    """(token, c) over all rows; tasks add up before the shuffle, in bounded tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list[pa.Table] = []
        for batch in batches:
            for texts in slices_of(batch.column(0)):
                counted = pc.value_counts(words_of(texts)[0])
                own.append(pa.table({"token": counted.field("values"), "c": counted.field("counts")}))
                own.append(pa.table({"token": pa.array([END], pa.binary()), "c": pa.array([len(texts)], pa.int64())}))
                if sum(x.num_rows for x in own) > limit:
                    own = [added(own)]
                    if own[0].num_rows > limit:
                        yield from own.pop().to_batches()
        if own:
            yield from added(own).to_batches()
        own.clear()
        tidy()

    def added(own: list[pa.Table]) -> pa.Table:
        return pa.TableGroupBy(pa.concat_tables(own), "token", use_threads=False).aggregate([("c", "sum")]).rename_columns({"token": "token", "c_sum": "c"}).select(["token", "c"])

    return on_workers(docs).select(text_col).mapInArrow(run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


def classes_for(vocabulary: int) -> int:
    """How many classes cost least: as many as an average target's class has words."""
    return max(2, round(math.sqrt(0.44 * vocabulary)))


def train(sample: list[bytes], words: list[bytes], hidden: int = 24, n_classes: int = 30, seed: int = 42) -> GruModel:
    model = GruModel.new(words, hidden, n_classes, seed)
    get = model.words.get
    documents = [np.array([get(t, 0) for t in tokens(x)], np.int32) for x in sample]
    # A small sample is read several times; the work stays within 2 million symbols.
    model.train(documents, epochs=max(1, min(8, 2_000_000 // max(1, sum(map(len, documents))))))
    return model


def pieces_of(symbols: list[np.ndarray], begin: int, most: int = 4096) -> tuple[list[np.ndarray], list[int]]:
    """Documents in pieces of bounded length, and the symbol before each piece."""
    parts = [(d[low : low + most], int(d[low - 1]) if low else begin) for d in symbols for low in range(0, len(d), most)]
    return [p for p, _ in parts], [c for _, c in parts]


def train_everywhere(model: GruModel, training: DataFrame, text_col: str, rate: float = 0.006, lanes: int = 512, block: int = 16 << 20, width: int = 1 << 16) -> GruModel:
    """The model after all rows: each task trains on its own, and the weights are averaged.

    Tasks start from one model, so that their weights can be averaged at all.  The
    sums are made in slices of the weights, none of them on the driver.
    """
    names = sorted(model.p)
    shared = training.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = shared.value
        own = GruModel(start.words, start.classes, start.starts, {k: v.copy() for k, v in start.p.items()})
        known, seen, held, size = pa.array(list(own.words), pa.binary()), 0, [], 0

        def learn() -> int:
            pieces, context = pieces_of(held, len(own.classes))
            n = sum(map(len, pieces))
            own.train(pieces, lanes=max(8, min(lanes, n // 4096)), rate=rate, context=context)  # few symbols still make many steps
            return n

        for batch in batches:
            for texts in slices_of(batch.column(0)):
                places, ends, _ = places_of(texts, known)
                tidy()
                sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
                for symbols, n in zip(np.split(places + 1, ends[:-1]), sizes, strict=True):
                    held.append(symbols)
                    size += n
                    if size >= block:
                        seen += learn()
                        held, size = [], 0
        if held:
            seen += learn()
        held.clear()
        if seen:
            flat = np.concatenate([own.p[k].ravel() for k in names])
            for n, low in enumerate(range(0, len(flat), width)):
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([seen], pa.int64()), pa.array([flat[low : low + width].tobytes()], pa.binary())], ["n", "task", "seen", "weights"])
        tidy()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for n, _, seen, weights in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                so_far = total.setdefault(n, [0, 0.0])
                so_far[0] += seen
                so_far[1] = so_far[1] + seen * np.frombuffer(weights, np.float32).astype(np.float64)
        for n, (seen, weights) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([(weights / seen).astype(np.float32).tobytes()], pa.binary())], ["n", "weights"])

    parts = on_workers(training).select(text_col).mapInArrow(run, "n int, task int, seen long, weights binary")
    slices = parts.repartition("n").sortWithinPartitions("n", "task").mapInArrow(add, "n int, weights binary").collect()
    if not slices:
        return model
    flat = np.concatenate([np.frombuffer(r["weights"], np.float32) for r in sorted(slices, key=lambda r: r["n"])])
    ends = np.cumsum([model.p[k].size for k in names])[:-1]
    return GruModel(model.words, model.classes, model.starts, {k: v.reshape(model.p[k].shape).copy() for k, v in zip(names, np.split(flat, ends), strict=True)})


def head_threshold(counts: DataFrame, limit: int) -> int:
    """The least count such that at most ``limit`` tokens have as much.

    Found from a histogram of counts on a logarithmic scale: some hundred rows.
    """
    step = F.floor(F.log2("c") * 16).alias("step")
    total, least = 0, None
    for r in sorted(counts.groupBy(step).agg(F.count("*").alias("n"), F.min("c").alias("c")).collect(), key=lambda r: -r["step"]):
        total += r["n"]
        if total > limit:
            break
        least = r["c"]
    return least if least is not None else 1 << 62


def start_texts(training: DataFrame, text_col: str, most: int, most_chars: int) -> list[bytes]:
    """The texts of least hash, ``most`` and ``most_chars`` at most, none over a twentieth of the latter.

    They are chosen by hash and length alone; only the chosen ones leave their tasks.
    """
    sizes = training.select(F.xxhash64(text_col).alias("h"), F.coalesce(F.length(text_col), F.lit(0)).alias("n"), F.col(text_col).alias("t")).where(F.col("n") <= most_chars // 20)
    place = F.pmod("h", F.lit(1 << 62))
    cutoff, chars = -1, 0
    for r in hash_sample(sizes.select("n", place.alias("place")), ["place", "n"], most, F.col("place")).collect():  # ``most`` pairs of numbers
        chars += r["n"]
        if chars > most_chars:
            break
        cutoff = r["place"]
    found = sizes.where(place <= cutoff).select(place.alias("place"), "t").collect()
    return [(r["t"] or "").encode() for r in sorted(found, key=lambda r: (r["place"], r["t"] or ""))][:most]


def score_documents(
    docs: DataFrame,
    training: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_head: int = 200_000,
    vocabulary: int = 2047,
    max_train: int = 4000,
    max_train_chars: int = 10_000_000,
) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``training`` holds the rows to learn from.  All of them are counted, and the GRU
    is trained on all of them.  Only its start is fitted to a sample: the ``max_train``
    texts of least hash among those of at most a twentieth of ``max_train_chars``, as
    far as that many characters go.  ``vocabulary`` is the least number of its words.
    """
    counts = cut(count_tokens(training, text_col), "token-counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = total["n"], total["v"]
    log_norm = math.log10(n + 0.1 * (v + 1))
    least = head_threshold(counts, max_head)
    top = sorted(((-r["c"], bytes(r["token"])) for r in counts.where(F.col("c") >= least).collect()))  # at most max_head rows
    values = np.array([math.log10(0.1 - c) - log_norm for c, _ in top] + [0.0])  # the last one: not in the head
    words = [w for _, w in top[: max(vocabulary, math.isqrt(n))]]
    model = train(start_texts(training, text_col, max_train, max_train_chars), words, n_classes=classes_for(len(words)))
    model = train_everywhere(model, training, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(([w for _, w in top], values, model))
    log_rare = math.log10(max(1e-12, 1.0 - sum(10**x for x in values[: len(words)].tolist())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, base_of, gru = shared.value
        known, n_symbols = pa.array(head, pa.binary()), len(gru.words)  # the GRU's words are the first of the head
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, low = batch.column(0), 0
            for texts in slices_of(batch.column(1)):
                n = len(texts)
                places, ends, tail = places_of(texts, known)
                tidy()
                firsts, value = np.r_[0, ends[:-1]], base_of[places]
                n_tail = np.add.reduceat(places < 0, firsts, dtype=np.int64)
                symbols = np.where(places < n_symbols, places + 1, 0).astype(np.int32, copy=False)
                gru_score = gru.score(np.split(symbols, ends[:-1])) / _LN10
                # Of the head's words, those the GRU calls "other" keep their unigram share.
                score = gru_score + np.add.reduceat(np.where(symbols == 0, value - log_rare, 0.0), firsts)
                n_tokens = ends - firsts
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + n)), ids.slice(low, n), pa.array(n_tokens), pa.array(n_tokens - n_tail), pa.array(np.add.reduceat(value, firsts)), pa.array(score), pa.ListArray.from_arrays(np.r_[0, np.cumsum(n_tail)].astype(np.int32), tail)],
                    ["row", "id", "n_tokens", "n_known", "base", "score", "tail"],
                )
                low, row = low + n, row + n
        tidy()

    kind = docs.schema[id_col].dataType.simpleString()
    rows = cut(on_workers(docs).select(id_col, text_col).mapInArrow(run, f"row long, id {kind}, n_tokens long, n_known long, base double, score double, tail array<binary>"), "lm-rows")
    value = F.log10(F.coalesce(F.col("c"), F.lit(0)) + F.lit(0.1)) - F.lit(log_norm)
    tails = (
        rows.select("row", F.explode("tail").alias("token")).join(counts.where(F.col("c") < least), "token", "left")
        .groupBy("row").agg(F.sum(value).alias("more"), F.count("c").alias("known"))
    )
    more = F.coalesce("more", F.lit(0.0))
    return rows.drop("tail").join(tails, "row", "left").select(
        F.col("id").alias(id_col), "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"), (F.col("score") + more).alias("score"),
    )
