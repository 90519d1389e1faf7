"""Toxic passages as maximum-scoring segments.

Words, and the beginnings of words, get log-odds between toxic and clean training
texts under an informative Dirichlet prior (the pooled frequencies); what is
significantly toxic forms a lexicon.  Any other token scores the small negative
log-odds of not being in it.  A linear-time scan finds all maximal segments of a
text's scores.  Scores are calibrated by extreme values: the Karlin-Altschul rate
``lam`` makes a clean text's chance of a segment above S about
``1 - exp(-K n exp(-lam S))``, with K from clean training texts.  Segments beyond
that are the toxic passages, and a logistic curve over the calibrated best score
and the sum of the significant ones gives the text's score.

Defined cases: a null text counts as empty; an empty text has no segment and gets
the score of one; without labels of both kinds the score is 0 for every text;
labels whose id or value is null are not learnt from; of labels for one id the
greatest counts; very long texts are scanned whole; repeated rows score alike; an
empty table gives none; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexlake.llm.common import cut, fit_logistic, hash_sample, on_workers, sigmoid, texts_of, tidy

_STRIP = string.punctuation + "«»„“”‘’¿¡…–—"
PREFIXES = (4, 5, 6)
FOLDS = 3


def word_of(token: str) -> str:
    return token.lower().strip(_STRIP)


def features(token: str) -> list[str]:
    """The word in lower case, and its beginnings marked by ``*``."""
    word = word_of(token)
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)] if word else []


def segments(scores: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first, last + 1, score), by one scan.

    ``scores`` are the positions with a positive score, in order; each token
    between them scores ``-drift``.  Candidates stand on a stack with the running
    totals before and after them; a new one merges into the last candidate that
    begins lower, as long as that one ends no higher.
    """
    stack: list[list] = []  # first, end, total before, total after, index of the last candidate that begins lower
    total, at = 0.0, 0
    for position, score in scores:
        before = total - drift * (position - at)
        total = before + score
        at = position + 1
        new = [position, at, before, total, -1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= new[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= new[3]:
                new[4] = j
                stack.append(new)
                break
            new = [stack[j][0], new[1], stack[j][2], new[3], -1]
            del stack[j:]
    return [(first, end, after - before) for first, end, before, after, _ in stack]


class _Scores(dict):
    """Token -> score, kept for a bounded number of tokens."""

    def __init__(self, lexicon: dict[str, float], memory: int = 200_000):
        self.lexicon, self.memory = lexicon, memory

    def __missing__(self, token: str) -> float:
        score = max((self.lexicon.get(f, 0.0) for f in features(token)), default=0.0)
        if len(self) < self.memory:
            self[token] = score
        return score


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    drift: float = 0.01
    lam: float = 1.0
    log_k: float = 0.0
    weights: list[float] = field(default_factory=lambda: [0.0, 0.0, -30.0])
    cutoff: float = 0.05

    def find(self, tokens: list[str], scores: _Scores) -> list[tuple[int, int, float]]:
        values = list(map(scores.__getitem__, tokens))
        return segments([(i, v) for i, v in enumerate(values) if v], self.drift) if any(values) else []

    def calibrated(self, score: float, n: int) -> float:
        """lam S - ln(K n); the chance of as much in clean text is 1 - exp(-exp(-x))."""
        return self.lam * score - self.log_k - math.log(max(n, 1))

    def summary(self, scores: list[float], n: int) -> tuple[float, float, list[bool]]:
        """Best calibrated score, sum of the significant ones, and which those are."""
        x = [self.calibrated(s, n) for s in scores or [0.0]]
        significant = [-math.expm1(-math.exp(min(-v, 50.0))) <= self.cutoff for v in x]
        return min(max(*x, -12.0), 12.0), math.log1p(sum(v for v, ok in zip(x, significant, strict=True) if ok)), significant

    def rate(self, text: str, scores: _Scores) -> tuple[float, list[tuple[int, int, float]]]:
        """The text's score and its significant passages."""
        tokens = text.split()
        found = self.find(tokens, scores)
        best, more, significant = self.summary([s for *_, s in found], len(tokens))
        logit = best * self.weights[0] + more * self.weights[1] + self.weights[2]
        return float(sigmoid(np.array(logit))), [f for f, ok in zip(found, significant, strict=False) if ok]


def _training(docs: DataFrame, labelled: DataFrame, id_col: str, text_col: str, max_train: int) -> DataFrame:
    """(text, label, part): at most ``max_train`` labelled texts, the same each time.

    Copies count once: what only many copies of one text hold is no sign of anything.
    """
    few = hash_sample(labelled.where("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label")), ["id"], max_train)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(few), "id").groupBy("text").agg(F.max("label").alias("label")).withColumn("part", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int"))


def _fit(counts: DataFrame, fold: int | None, max_lexicon: int, prior: float, min_z: float) -> ToxicityModel:
    """Lexicon, drift and rate from the counts of all folds but one."""
    folds = [k for k in range(FOLDS) if k != fold]
    of = lambda side: sum((F.col(f"{side}{k}") for k in folds[1:]), F.col(f"{side}{folds[0]}"))
    words = counts.where("token != ''").select("token", of("clean").alias("clean"), of("toxic").alias("toxic"))
    # A beginning counts without its most toxic word: one such word makes no toxic beginning.
    cuts = F.filter(F.array(*(F.lit(k) for k in PREFIXES)), lambda k: k < F.length("token"))
    starts = words.select(F.explode(F.transform(cuts, lambda k: F.concat(F.substring(F.col("token"), F.lit(1), k), F.lit("*")))).alias("token"), "clean", "toxic")
    total = words.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).first()
    n0, n1 = float(total["clean"] or 0), float(total["toxic"] or 0)
    if not n0 or not n1:
        return ToxicityModel({})
    best = []
    for side in (words, starts.groupBy("token").agg(F.sum("clean").alias("clean"), (F.sum("toxic") - F.max("toxic")).alias("toxic"))):
        a, mass = prior * (F.col("clean") + F.col("toxic")), prior * (n0 + n1)
        y0, y1 = F.col("clean") + a, F.col("toxic") + a
        odds = F.log(y1 / (n1 + mass - y1)) - F.log(y0 / (n0 + mass - y0))
        rated = side.where("toxic > 1").withColumn("s", odds).withColumn("z", F.col("s") / F.sqrt(1 / y0 + 1 / y1)).where(F.col("z") >= min_z)
        best += rated.orderBy(F.desc("z"), "token").limit(max_lexicon // 2).select("token", "s", ((F.col("clean") + 0.5) / n0).alias("p0"), (F.col("toxic") / n1).alias("p1")).collect()
    model = ToxicityModel({r["token"]: float(r["s"]) for r in best})
    if not best:
        return model
    p0, s = np.array([r["p0"] for r in best]), np.array([r["s"] for r in best])
    hit0, hit1 = p0.sum(), sum(r["p1"] for r in best)
    model.drift = max(1e-4, math.log((1 - min(hit0, 0.9)) / (1 - min(hit1, 0.95))))
    low, high = 1e-3, 5.0
    for _ in range(60):  # lam: the positive root of E[exp(lam s)] = 1 in clean text
        mid = (low + high) / 2
        value = (p0 * np.exp(np.minimum(mid * s, 300))).sum() + (1 - min(hit0, 0.9)) * math.exp(-mid * model.drift)
        low, high = (mid, high) if value < 1 else (low, mid)
    model.lam = low
    return model


def train(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = 20_000, max_lexicon: int = 50_000, prior: float = 0.1, min_z: float = 3.3) -> ToxicityModel:
    """Fit on ``labelled`` (id, label).

    ``max_train`` bounds the labelled texts, ``max_lexicon`` what reaches the driver.
    ``prior`` is the weight of the pooled frequencies, as a part of all counts; it
    has to carry a word that no clean text holds, whose own count says nothing.
    The calibration scores each text by a lexicon made without that text's fold.
    """
    texts = cut(_training(docs, labelled, id_col, text_col, max_train), "toxicity-texts")  # read by both passes below
    columns = [f"{side}{k}" for side in ("clean", "toxic") for k in range(FOLDS)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = [Counter() for _ in columns]
        for batch in batches:
            for text, label, part in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                present = set(text.split())  # once a text, so that one text's habits don't weigh
                sides[(FOLDS if label == 1 else 0) + part].update({"", *(w for t in present if (w := word_of(t)))})
            if sum(map(len, sides)) > 400_000:
                yield spill(sides)
        yield spill(sides)

    def spill(sides: list[Counter]) -> pa.RecordBatch:
        names = list(set().union(*sides))
        out = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([s[n] for n in names], pa.int64()) for s in sides)], ["token", *columns])
        for s in sides:
            s.clear()
        return out

    schema = "token string, " + ", ".join(f"{c} long" for c in columns)
    counts = cut(on_workers(texts).mapInArrow(count, schema).groupBy("token").agg(*(F.sum(c).alias(c) for c in columns)), "toxicity-counts")
    model = _fit(counts, None, max_lexicon, prior, min_z)
    if not model.lexicon:
        return model
    without = [_fit(counts, k, max_lexicon, prior, min_z) for k in range(FOLDS)]
    rows = cut(on_workers(texts).mapInArrow(_segment_scores(without), "label int, n long, scores array<double>"), "toxicity-segments")
    best = F.coalesce(F.array_max("scores"), F.lit(0.0))
    size = F.log(F.greatest("n", F.lit(1)).cast("double"))
    mean = rows.where("label = 0").agg(F.avg(model.lam * best - size).alias("m")).first()["m"]
    if mean is not None:  # K from the mean of clean maxima: E[lam S] = ln(K n) + Euler's constant
        model.log_k = float(mean) - 0.5772
    # The summary of each text, as ``summary`` has it: two numbers a text leave their tasks.
    values = F.transform(F.when(F.size("scores") > 0, F.col("scores")).otherwise(F.array(F.lit(0.0))), lambda s: model.lam * s - F.lit(model.log_k) - size)
    bound = -math.log(-math.log1p(-model.cutoff))
    more = F.log1p(F.aggregate(values, F.lit(0.0), lambda total, v: total + F.when(v >= bound, v).otherwise(0.0)))
    found = rows.select("label", F.least(F.greatest(F.array_max(values), F.lit(-12.0)), F.lit(12.0)).alias("best"), more.alias("more")).collect()
    found.sort()
    y = np.array([float(r["label"]) for r in found])
    if 0 < y.sum() < len(y):
        model.weights = fit_logistic(np.array([[r["best"], r["more"]] for r in found]), y, 1e-4).tolist()
    return model


def _segment_scores(models: list[ToxicityModel]):
    """(label, n, scores) of (text, label, part), each by its part's model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [_Scores(m.lexicon, 100_000) for m in models]
        for batch in batches:
            labels = pa.array([int(y == 1) for y in batch.column(1).to_pylist()], pa.int32())
            sizes, found = [], []
            for text, k in zip(texts_of(batch.column(0)), batch.column(2).to_pylist(), strict=True):
                tokens = text.split()
                sizes.append(len(tokens))
                found.append([s for *_, s in models[k].find(tokens, known[k])])
            yield pa.RecordBatch.from_arrays([labels, pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.float64()))], ["label", "n", "scores"])

    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """(id, score, predicted, n_passages, passages): passages in token positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Scores(model.lexicon)
        for batch in batches:
            rated = [model.rate(t, known) for t in texts_of(batch.column(1))]
            score = np.array([r[0] for r in rated], float)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            passages = [[{"start": f, "end": e, "score": s} for f, e, s in r[1]] for r in rated]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(list(map(len, passages)), pa.int32()), pa.array(passages, kind)],
                ["id", "score", "predicted", "n_passages", "passages"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    out = on_workers(docs).select(id_col, text_col).mapInArrow(run, f"id {kind}, score double, predicted int, n_passages int, passages array<struct<start:long,end:long,score:double>>")
    return out.withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold."""
    on_workers(docs)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = _Scores(model.lexicon)
        for texts in parts:
            yield pd.Series([model.rate(t or "", known)[0] for t in texts], dtype=float)
        known.clear()
        tidy()

    return docs.where(score(F.col(text_col)) < threshold)
