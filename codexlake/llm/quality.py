"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad.  Its features are shape counts (letters,
symbols, repeats and the like), cut into quantile bins; a line's emission adds up
weights of its own bins and of both neighbours'.  Labels are of documents, so the
lines of a bad one are labelled first: by their own features alone, fitted to the
documents' labels, where all but the worst line may come out good.  Training then
maximises the chains' conditional likelihood.  A document's quality comes from the
length-weighted mean of the lines' forward-backward marginals and the length that
they call bad, turned into a probability by a logistic curve.

Defined cases: a null text counts as empty; an empty text is one empty line;
without labels of both kinds every text scores 1; labels whose id or value is null
are not learnt from; of labels for one id the greatest counts; very long texts are
scored whole; repeated rows score alike; an empty table gives none; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codexlake.llm.common import bytes_of, fit_logistic, hash_sample, on_workers, sigmoid, tidy

_UPPER, _LETTER, _DIGIT, _SYMBOL, _PIPE, _WIDE, _SPACE, _STOP = (1 << k for k in range(8))
_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91] = _UPPER | _LETTER
_CLASS[97:123] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[128:] = _WIDE
for _c in b"!\"#$%&()*+/:;<=>?@[\\]^_`{|}~":
    _CLASS[_c] = _SYMBOL
_CLASS[ord("|")] |= _PIPE
for _c in b" \t\n\r\x0b\x0c":
    _CLASS[_c] = _SPACE
for _c in b".,":
    _CLASS[_c] = _STOP
N_FEATURES, BINS = 13, 8


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines x features, bytes of each line, lines of each text)."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    # A text's own line ends and those put between texts are alike: one line each.
    ends = np.flatnonzero(raw == 10)
    starts = np.r_[0, ends[:-1] + 1]
    kinds = _CLASS[raw]
    length = (ends - starts).astype(np.float32)

    def per_line(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, starts, dtype=np.int32).astype(np.float32)

    upper, letter, digit, symbol, pipe, wide, stop = (per_line((kinds & k) != 0) for k in (_UPPER, _LETTER, _DIGIT, _SYMBOL, _PIPE, _WIDE, _STOP))
    last = np.r_[((kinds[:-1] & _SYMBOL) != 0) & ((kinds[1:] & _SPACE) != 0), False]
    tails = per_line(last)
    words, kinds_of_words, copies, counts = [], [], [], []
    for text in texts:
        lines = text.split(b"\n")
        counts.append(len(lines))
        seen = Counter(lines) if len(lines) > 1 else None
        for line in lines:
            w = line.split()
            words.append(len(w))
            kinds_of_words.append(len(set(w)))
            copies.append(1 if seen is None or not w else seen[line])
    n, unique, repeats = np.array(words, np.float32), np.array(kinds_of_words, np.float32), np.array(copies, np.float32)
    size, some = length + 1, np.maximum(n, 1)
    out = np.stack(
        [np.log1p(length), upper / (letter + 1), symbol / size, pipe / size, digit / size, wide / size, stop / some, length / some, np.log1p(n), unique / some, unique / np.sqrt(some), tails / some, np.log(repeats)], 1
    )
    return out.astype(np.float32), length, np.array(counts, np.int64)


@dataclass
class QualityModel:
    edges: list[np.ndarray]  # bin edges of each feature
    emit: np.ndarray  # 3 x features x bins: own, previous and next line's weights of "good"
    move: np.ndarray  # 2 x 2
    start: np.ndarray  # 2
    curve: np.ndarray

    def bins(self, features: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, features[:, k], "right") for k, e in enumerate(self.edges)], 1)

    def emissions(self, bins: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The score of "good" for each line."""
        columns = np.arange(bins.shape[1])
        own, before, after = (self.emit[k][columns, bins].sum(1) for k in range(3))
        first, last = _borders(counts)
        out = own.copy()
        out[1:] += np.where(first[1:], 0, before[:-1])
        out[:-1] += np.where(last[:-1], 0, after[1:])
        return out

    def rate(self, texts: list[bytes], chunk: int = 8 << 20) -> tuple[np.ndarray, list[np.ndarray]]:
        """Scores of the texts, and P(good) of their lines."""
        scores, lines, low = [], [], 0
        while low < len(texts):
            high, size = low, 0
            while high < len(texts) and (high == low or size + len(texts[high]) < chunk):
                size += len(texts[high])
                high += 1
            features, length, counts = line_features(texts[low:high])
            good, _, _, _ = marginals(self.emissions(self.bins(features), counts), counts, self.move, self.start)
            scores.append(sigmoid(summary(good, length, counts) @ self.curve[:-1] + self.curve[-1]))
            lines += np.split(good, np.cumsum(counts)[:-1])
            low = high
        return np.concatenate(scores) if scores else np.empty(0), lines


def _borders(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first, last = np.zeros(counts.sum(), bool), np.zeros(counts.sum(), bool)
    last[np.cumsum(counts) - 1] = True
    first[np.cumsum(counts) - counts] = True
    return first, last


def marginals(score: np.ndarray, counts: np.ndarray, move: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all chains at once, longest first.

    Returns P(good) of each line, the expected moves (2 x 2), the expected starts
    (2), and each chain's log normaliser.
    """
    order = np.argsort(-counts, kind="stable")
    at = (np.cumsum(counts) - counts)[order]
    sizes = counts[order]
    emit = np.zeros((len(score), 2))
    emit[:, 1] = score
    forward, backward = np.empty((len(score), 2)), np.zeros((len(score), 2))
    # How many chains are at least so long: they come first in the order.
    alive = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")
    for t, k in enumerate(alive):
        row = at[:k] + t
        forward[row] = emit[row] + (start if t == 0 else np.logaddexp(forward[row - 1, :1] + move[0], forward[row - 1, 1:] + move[1]))
    for t in range(len(alive) - 2, -1, -1):
        row = at[: alive[t + 1]] + t
        ahead = backward[row + 1] + emit[row + 1]
        backward[row] = np.logaddexp(move[:, 0] + ahead[:, :1], move[:, 1] + ahead[:, 1:])
    ends = at + sizes - 1
    z = np.empty(len(counts))
    z[order] = np.logaddexp(forward[ends, 0], forward[ends, 1])
    whole = np.repeat(z, counts)
    good = np.exp(np.minimum(forward[:, 1] + backward[:, 1] - whole, 0))
    first, _ = _borders(counts)
    later = np.flatnonzero(~first)
    pairs = np.exp(forward[later - 1][:, :, None] + move + (emit + backward)[later][:, None, :] - whole[later][:, None, None])
    starts = np.array([(1 - good[first]).sum(), good[first].sum()])
    return good, pairs.sum(0), starts, z


def summary(good: np.ndarray, length: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text: the length-weighted mean's logit, log length, and log bad length."""
    at = np.cumsum(counts) - counts
    weight = length + 1
    total = np.add.reduceat(weight, at) if len(at) else np.empty(0)
    mean = (np.add.reduceat(weight * good, at) if len(at) else np.empty(0)) / total
    mean = np.clip(mean, 1e-4, 1 - 1e-4)
    bad = np.add.reduceat(weight * (1 - good), at) if len(at) else np.empty(0)
    return np.stack([np.log(mean / (1 - mean)), np.log1p(total), np.log1p(bad)], 1)


def whole_texts(docs: DataFrame, few: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """The rows of ``few`` in order of hash, until their texts have ``most`` lines.

    The last text is taken whole, however long, so that no length is left out.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    sizes = docs.select(F.col(id_col).alias("id"), lines.alias("lines")).join(F.broadcast(few), "id").groupBy("id").agg(F.sum("lines").alias("lines"))
    before = Window.orderBy(F.pmod(F.xxhash64("id"), F.lit(1 << 30)), "id").rowsBetween(Window.unboundedPreceding, -1)
    return few.join(sizes.select("id", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("before")), "id").where(F.col("before") < most).drop("before")


def train(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = 10_000, max_lines: int = 300, window: int = 64, rounds: int = 200, l2: float = 1e-5) -> QualityModel | None:
    """Fit on ``labelled`` (id, label); a sample of whole texts, ``max_train`` at most.

    There are fewer of them where they have over ``max_train`` times ``max_lines`` lines
    in all.  The chain learns from windows of ``window`` lines, which cover a text;
    the curve is fitted to whole texts.  The sample is the same each time.  None
    without labels of both kinds.
    """
    few = hash_sample(labelled.where("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label")), ["id"], max_train)
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(whole_texts(docs, few, id_col, text_col, max_train * max_lines)), "id").select("text", "label")

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, label in zip(bytes_of(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                features, length, _ = line_features([text])
                rows.append((int(label == 1), features.tobytes(), length.tobytes()))
            columns = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary()), strict=True)], ["label", "features", "length"])

    rows = on_workers(sample).mapInArrow(shapes, "label int, features binary, length binary").collect()  # about max_train x max_lines lines at most
    rows.sort(key=lambda r: (r["features"], r["label"]))
    y = np.array([r["label"] for r in rows], float)
    if not 0 < y.sum() < len(y):
        return None
    features = np.concatenate([np.frombuffer(r["features"], np.float32).reshape(-1, N_FEATURES) for r in rows])
    length = np.concatenate([np.frombuffer(r["length"], np.float32) for r in rows])
    texts = np.array([len(r["length"]) // 4 for r in rows])
    counts = np.array([min(window, n - low) for n in texts.tolist() for low in range(0, n, window)])
    edges = [np.unique(np.quantile(features[:, k], np.arange(1, BINS) / BINS)) for k in range(N_FEATURES)]
    model = QualityModel(edges, np.zeros((3, N_FEATURES, BINS)), np.zeros((2, 2)), np.zeros(2), np.array([1.0, 0.0, 0.0, 0.0]))
    bins = model.bins(features)
    flat = bins + BINS * np.arange(N_FEATURES)
    first, last = _borders(counts)
    cells = N_FEATURES * BINS

    def fit(truth: np.ndarray, chained: bool, rounds: int) -> np.ndarray:
        """Adam on the conditional likelihood; P(good) of each line afterwards."""
        label = truth.astype(int)
        moves, later = np.zeros((2, 2)), np.flatnonzero(~first)
        np.add.at(moves, (label[later - 1], label[later]), 1)
        starts = np.array([(label[first] == 0).sum(), (label[first] == 1).sum()], float)
        parameters = np.zeros(3 * cells + 6)
        m, v = np.zeros_like(parameters), np.zeros_like(parameters)
        used = np.ones_like(parameters)
        if not chained:
            used[cells:] = 0
        for step in range(1, rounds + 2):
            model.emit = parameters[: 3 * cells].reshape(3, N_FEATURES, BINS)
            model.move, model.start = parameters[3 * cells : 3 * cells + 4].reshape(2, 2), parameters[-2:]
            if chained:
                good, expected, begun, _ = marginals(model.emissions(bins, counts), counts, model.move, model.start)
            else:  # without neighbours and moves each line stands alone
                good, expected, begun = sigmoid(model.emit[0].ravel()[flat].sum(1)), 0.0, 0.0
            if step > rounds:
                return good
            error = truth - good
            before, after = error.copy(), error.copy()
            before[first], after[last] = 0, 0
            own = [np.bincount(flat.ravel(), np.repeat(e, N_FEATURES), cells) for e in (error, np.r_[before[1:], 0], np.r_[0, after[:-1]])]
            gradient = (np.r_[np.concatenate(own), (moves - expected).ravel(), starts - begun] / len(y) - l2 * parameters) * used
            m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
            parameters = parameters + 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)

    alone = fit(np.repeat(y, texts), False, rounds // 2)
    worst = np.repeat(np.minimum.reduceat(alone, np.cumsum(texts) - texts), texts)
    good = fit(np.where(np.repeat(y, texts) == 1, 1.0, (alone > 0.5) & (alone > worst)), True, rounds)
    model.curve = fit_logistic(summary(good, length, texts), y)
    return model


def score_quality(docs: DataFrame, model: QualityModel | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """(id, score, predicted, n_lines, n_good): lines more likely good than bad."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = bytes_of(batch.column(1))
            score, lines = model.rate(texts) if model else (np.ones(len(texts)), [np.ones(t.count(b"\n") + 1) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array([len(g) for g in lines], pa.int64()), pa.array([int((g >= 0.5).sum()) for g in lines], pa.int64())],
                ["id", "score", "predicted", "n_lines", "n_good"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return on_workers(docs).select(id_col, text_col).mapInArrow(run, f"id {kind}, score double, predicted int, n_lines long, n_good long").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, model: QualityModel | None, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose text scores at least the threshold."""
    if model is None:
        return docs
    on_workers(docs)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(model.rate([(t or "").encode("utf-8") for t in texts])[0])
        tidy()

    return docs.where(score(F.col(text_col)) >= threshold)
