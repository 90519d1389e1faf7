import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from codexlake.llm import queries, toxicity
from tests.llm.helpers import ODD, none, odd


def maximal(scores):
    """Ruzzo and Tompa's definition: take the best segment, recurse on both sides."""

    def go(low, high):
        best = None
        for i in range(low, high):
            total = 0
            for j in range(i, high):
                total += scores[j]
                if total > 1e-9 and (best is None or total > best[2] + 1e-9 or (abs(total - best[2]) <= 1e-9 and j + 1 - i < best[1] - best[0])):
                    best = (i, j + 1, total)
        return [] if best is None else go(low, best[0]) + [best] + go(best[1], high)

    return go(0, len(scores))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([0, 0, 0, 0.75, 2.25, 1.625, 3.125]), max_size=14))
def test_segments_against_the_definition(values):
    drift = 0.8125
    found = toxicity.segments([(i, v) for i, v in enumerate(values) if v], drift)
    want = maximal([v or -drift for v in values])
    assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in want] or np.isclose(sum(s for *_, s in found), sum(s for *_, s in want))
    assert np.allclose(sorted(s for *_, s in found), sorted(s for *_, s in want))


def quality_of(rows, labels, column):
    m = rows.merge(labels, on="doc_id")
    m = m[m.held_out]
    y, s = m[column].to_numpy(), m.score.rank().to_numpy()
    n1, n0 = y.sum(), (1 - y).sum()
    return (s[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0), (m.predicted == y).mean()


def test_held_out_accuracy(spark, small):
    rows = queries.op5_toxic_segments(spark, small).toPandas()
    labels = pd.read_parquet(f"{small}/labels.parquet")
    auc, accuracy = quality_of(rows, labels, "toxic")
    assert len(rows) == 1000 and rows.score.between(0, 1).all() and auc > 0.9 and accuracy > 0.9


def trained(spark):
    texts = [(i, "you are an awful fool and a crook " * 2 if i % 3 == 0 else f"the weather in a town and an hour {i} is fine and you are well " * 3) for i in range(120)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)] + [(None, 1), (3, None)], "id long, label int")
    docs = docs.selectExpr("doc_id", "text || ' ' || doc_id as text")
    return toxicity.train(docs, labels)


def test_odd_rows_and_no_labels(spark):
    model = trained(spark)
    assert "fool" in model.lexicon and "weather" not in model.lexicon
    rows = toxicity.score_toxicity(odd(spark), model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 and r["n_passages"] == 0 for r in rows)
    assert toxicity.score_toxicity(none(spark), model).count() == 0
    labels = spark.createDataFrame([], "id long, label int")
    empty = toxicity.train(odd(spark), labels)
    assert all(r["predicted"] == 0 for r in toxicity.score_toxicity(odd(spark), empty).collect())


def test_passages_and_filter(spark):
    model = trained(spark)
    docs = spark.createDataFrame([(1, "the weather is fine but you are an awful FOOL, a crook! so it is"), (2, "the weather is fine today")], "doc_id long, text string")
    by = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, model).collect()}
    assert by[1]["predicted"] == 1 and by[2]["predicted"] == 0
    (passage,) = by[1]["passages"]
    assert docs.first()["text"].split()[passage["start"] : passage["end"]][-1] == "crook!"
    assert [r["doc_id"] for r in toxicity.drop_toxic(docs, model).collect()] == [2]


def test_query_rows_against_the_definition(spark, tiny):
    """Every text's score from its maximal segments by definition, and the calibration written out."""
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    model = toxicity.train(queries.documents(spark, tiny), queries.labels(spark, tiny, "toxic", 4, 2))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    checked = 0
    for r in queries.op5_toxic_segments(spark, tiny).collect():
        tokens = texts[r["doc_id"]].split()
        if len(tokens) > 300:
            continue
        values = [max((model.lexicon.get(f, 0.0) for f in toxicity.features(t)), default=0.0) or -model.drift for t in tokens]
        found = maximal(values) if any(v > 0 for v in values) else []
        x = [model.lam * s - model.log_k - np.log(max(len(tokens), 1)) for s in [s for *_, s in found] or [0.0]]
        chance = [1 - np.exp(-np.exp(min(-v, 50.0))) for v in x]
        best, more = min(max(*x, -12.0), 12.0), np.log1p(sum(v for v, p in zip(x, chance, strict=True) if p <= model.cutoff))
        want = 1 / (1 + np.exp(-(best * model.weights[0] + more * model.weights[1] + model.weights[2])))
        assert np.isclose(r["score"], want, atol=1e-9) and r["predicted"] == (want >= 0.3)
        checked += 1
    assert checked > 100
