import itertools

import numpy as np
import pandas as pd

from codexlake.llm import quality, queries
from tests.llm.helpers import ODD, none, odd
from tests.llm.test_toxicity import quality_of


def test_marginals_against_enumeration():
    rng = np.random.default_rng(2)
    counts = np.array([3, 1, 4, 2])
    score, move, start = rng.normal(size=10), rng.normal(size=(2, 2)), rng.normal(size=2)
    good, moves, starts, z = quality.marginals(score, counts, move, start)
    at, want_moves, want_starts, want_good, want_z = 0, np.zeros((2, 2)), np.zeros(2), [], []
    for n in counts:
        weights = {}
        for path in itertools.product((0, 1), repeat=n):
            weights[path] = np.exp(start[path[0]] + sum(score[at + t] * s for t, s in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:], strict=False)))
        total = sum(weights.values())
        want_z.append(np.log(total))
        for t in range(n):
            want_good.append(sum(w for p, w in weights.items() if p[t]) / total)
        for p, w in weights.items():
            want_starts[p[0]] += w / total
            for a, b in zip(p, p[1:], strict=False):
                want_moves[a, b] += w / total
        at += n
    assert np.allclose(good, want_good) and np.allclose(moves, want_moves) and np.allclose(starts, want_starts) and np.allclose(z, want_z)


def test_line_features_by_hand():
    features, length, counts = quality.line_features([b"AB cd\nAB cd\n\n$$$ x", b""])
    assert counts.tolist() == [4, 1] and length.tolist() == [5, 5, 0, 5, 0]
    assert np.isclose(features[0, 1], 2 / 5) and np.isclose(features[3, 2], 3 / 6) and np.isclose(features[0, 12], np.log(2)) and features[2, 12] == 0


def test_emissions_use_neighbours_of_the_same_text_only():
    m = quality.QualityModel([np.array([0.5])] * quality.N_FEATURES, np.zeros((3, quality.N_FEATURES, quality.BINS)), np.zeros((2, 2)), np.zeros(2), np.zeros(4))
    m.emit[0, 0, 1], m.emit[1, 0, 1], m.emit[2, 0, 1] = 1.0, 10.0, 100.0
    bins = np.zeros((4, quality.N_FEATURES), int)
    bins[:, 0] = [1, 0, 1, 1]
    assert m.emissions(bins, np.array([2, 2])).tolist() == [1.0, 10.0, 101.0, 11.0]


def test_held_out_accuracy(spark, small):
    rows = queries.op6_quality_crf(spark, small).toPandas()
    auc, accuracy = quality_of(rows, pd.read_parquet(f"{small}/labels.parquet"), "quality")
    assert len(rows) == 1000 and rows.score.between(0, 1).all() and auc > 0.9 and accuracy > 0.9


def test_odd_rows_and_no_labels(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{small}/labels.parquet").selectExpr("doc_id as id", "quality as label"), rounds=20)
    rows = quality.score_quality(odd(spark), model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score_quality(none(spark), model).count() == 0
    assert quality.keep_good(odd(spark), model).columns == odd(spark).columns
    kept = quality.keep_good(odd(spark), model, threshold=0.0)
    assert kept.count() == len(ODD)
    assert quality.train(odd(spark), spark.createDataFrame([(1, 1), (None, 0)], "id long, label int")) is None
    assert {r["score"] for r in quality.score_quality(odd(spark), None).collect()} == {1.0}


def test_chunks_of_texts_change_nothing(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{small}/labels.parquet").selectExpr("doc_id as id", "quality as label"), rounds=5)
    texts = [r["text"].encode() for r in docs.limit(40).collect()]
    assert np.allclose(model.rate(texts, 1000)[0], model.rate(texts)[0])


def test_what_is_bad_after_many_lines_is_learnt(spark):
    line = lambda i, bad: f"$$$ {i:03} ### BUY!!! @@@ ~~~ %%% 0000 {{}} [[ ]]" if bad else f"These are plain words of a sentence, written {i:03}."
    texts = [(k, "\n".join(line(i, k % 2 and i >= 320) for i in range(400))) for k in range(20)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    model = quality.train(docs, docs.selectExpr("doc_id as id", "1 - doc_id % 2 as label"), rounds=20)
    score = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, model).collect()}
    assert min(score[k] for k in score if k % 2 == 0) > max(score[k] for k in score if k % 2) + 0.2


def test_fewer_whole_texts_within_the_bound(spark):
    docs = spark.createDataFrame([(k, "a\n" * 9) for k in range(20)] + [(99, None)], "doc_id long, text string")
    few = docs.where("doc_id < 99").selectExpr("doc_id as id", "1 as label")
    assert [quality.whole_texts(docs, few, "doc_id", "text", most).count() for most in (1, 10, 11, 200, 1000)] == [1, 1, 2, 20, 20]


def test_query_rows_against_a_chain_by_hand(spark, tiny):
    """Every text's score from its lines, one after another, with the sums written out."""
    model = quality.train(queries.documents(spark, tiny), queries.labels(spark, tiny, "quality", 5, 0))
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    for r in queries.op6_quality_crf(spark, tiny).collect():
        features, length, counts = quality.line_features([texts[r["doc_id"]]])
        bins, n = model.bins(features), int(counts[0])
        emit = [sum(model.emit[0][k, bins[t, k]] + (model.emit[1][k, bins[t - 1, k]] if t else 0) + (model.emit[2][k, bins[t + 1, k]] if t + 1 < n else 0) for k in range(quality.N_FEATURES)) for t in range(n)]
        add = lambda *xs: max(xs) + np.log(sum(np.exp(x - max(xs)) for x in xs))
        ahead = [(model.start[0], model.start[1] + emit[0])]
        for t in range(1, n):
            ahead.append(tuple(add(*(ahead[-1][a] + model.move[a, b] for a in (0, 1))) + b * emit[t] for b in (0, 1)))
        behind = [(0.0, 0.0)]
        for t in range(n - 1, 0, -1):
            behind.insert(0, tuple(add(*(model.move[a, b] + b * emit[t] + behind[0][b] for b in (0, 1))) for a in (0, 1)))
        z = add(*ahead[-1])
        good = np.array([np.exp(min(f[1] + b[1] - z, 0)) for f, b in zip(ahead, behind, strict=True)])
        weight = length + 1
        mean = np.clip((weight * good).sum() / weight.sum(), 1e-4, 1 - 1e-4)
        summary = np.array([np.log(mean / (1 - mean)), np.log1p(weight.sum()), np.log1p((weight * (1 - good)).sum())])
        want = 1 / (1 + np.exp(-(summary @ model.curve[:-1] + model.curve[-1])))
        assert np.isclose(r["score"], want, atol=1e-6) and r["n_lines"] == n
