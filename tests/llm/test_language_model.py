import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from codexlake.llm import language_model as lm
from codexlake.llm import queries
from tests.llm.helpers import ODD, none, odd

WORDS = [b"the", b"a", b"of", b"to", b"in", lm.END]


@pytest.fixture(scope="module")
def model():
    m = lm.GruModel.new(WORDS, 5, 3, 1)
    for k in m.p:
        m.p[k] = m.p[k].astype(np.float64) * 4
    return m


def documents(seed=1, n=9):
    rng = np.random.default_rng(seed)
    return [rng.integers(0, 7, rng.integers(1, 30)).astype(np.int32) for _ in range(n)]


def slow_score(m, symbols):
    """One document, step by step, with the whole distribution written out."""
    h, state, before, total = m.hidden, np.zeros(m.hidden), len(m.classes), 0.0
    for s in symbols:
        x = m.p["x"][before]
        gates = 1 / (1 + np.exp(-(x[: 2 * h] + state @ m.p["u"][:, : 2 * h])))
        candidate = np.tanh(x[2 * h :] + (gates[:h] * state) @ m.p["u"][:, 2 * h :])
        state = (1 - gates[h:]) * candidate + gates[h:] * state
        classes = np.exp(state @ m.p["c"] + m.p["cb"])
        classes /= classes.sum()
        words = np.exp(state @ m.p["w"] + m.p["wb"])
        probability = np.empty(len(words))
        for k in range(len(classes)):
            own = m.classes == k
            probability[own] = classes[k] * words[own] / words[own].sum()
        assert np.isclose(probability.sum(), 1)
        total += math.log(probability[s])
        before = s
    return total


def test_scores_carry_state_across_windows_and_lanes(model):
    docs = documents()
    want = [slow_score(model, d) for d in docs]
    for lanes, window in ((1, 1), (2, 4), (64, 7), (3, 64)):
        assert np.allclose(model.score(docs, lanes, window), want, atol=1e-4)


def test_gradients(model):
    docs = documents(2, 4)
    plan = lm.lane_plan([len(d) for d in docs], 2)
    inputs, fresh, targets, mask = next(lm.windows(docs, plan, 64, len(model.classes)))
    start = np.zeros((inputs.shape[1], model.hidden))

    def loss():
        states, _, _ = model.forward(inputs, fresh, start)
        live = mask.ravel()
        return -model.log_probabilities(states.reshape(-1, model.hidden).astype(float)[live], targets.ravel()[live]).sum() / live.sum()

    states, _, saved = model.forward(inputs, fresh, start, keep=True)
    gradients, value = model._backward(inputs, fresh, targets, mask, states, saved)
    assert np.isclose(value, loss(), atol=1e-5)
    for k, (rows, part) in gradients.items():
        g = np.zeros(model.p[k].shape)
        g[rows] = part
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        model.p[k][i] += 1e-3
        above = loss()
        model.p[k][i] -= 2e-3
        below = loss()
        model.p[k][i] += 1e-3
        assert np.isclose(g[i], (above - below) / 2e-3, rtol=0.02, atol=1e-4)


def test_training_beats_counting():
    rng = np.random.default_rng(3)
    docs = [np.array([1 + (k + s) % 4 for k in range(n)] + [6], np.int32) for n, s in zip(rng.integers(5, 40, 150), rng.integers(0, 4, 150), strict=True)]
    m = lm.GruModel.new(WORDS, 12, 3, 7)
    m.train(docs, lanes=8, window=16, epochs=6)
    n = sum(map(len, docs))
    counts = Counter(x for d in docs for x in d.tolist())
    unigram = sum(math.log(counts[x] / n) for d in docs for x in d.tolist())
    assert m.score(docs).sum() > 0.5 * unigram


def test_classes_grow_with_rank_and_hold_every_symbol():
    for size in (1, 2, 5, 300, 9000):
        m = lm.GruModel.new([b"%d" % k for k in range(size)], 4, lm.classes_for(size), 1)
        widths = np.diff(m.starts)
        assert m.starts[0] == 0 and m.starts[-1] == size + 1 == len(m.classes) and (widths > 0).all()
        assert size < 300 or widths[-1] > 4 * widths[0]


def test_start_sample_is_bounded_and_fixed(spark):
    rows = [(f"w{k} " * (1 + k % 50),) for k in range(400)]
    one, two = (lm.start_texts(spark.createDataFrame(rows, "text string").repartition(n), "text", 100, 6000) for n in (2, 5))
    assert one == two and 0 < len(one) <= 100 and sum(map(len, one)) <= 6000 and max(map(len, one)) <= 300
    assert lm.start_texts(spark.createDataFrame([], "text string"), "text", 100, 6000) == []


def test_head_threshold(spark):
    counts = spark.createDataFrame([(bytes([65 + i]), c) for i, c in enumerate([100, 50, 50, 20, 3, 3, 1])], "token binary, c long")
    for limit in range(9):
        assert counts.where(f"c >= {lm.head_threshold(counts, limit)}").count() <= limit
    assert lm.head_threshold(counts, 7) == 1


def base_of(texts, train):
    tok = lambda t: [*(t or "").encode().lower().split(), None]
    c = Counter(w for t in train for w in tok(t))
    n, v = sum(c.values()), len(c)
    return [(len(k := tok(t)), sum(c[w] > 0 for w in k), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in k)) for t in texts]


@pytest.mark.parametrize("head", [10, 200_000])
def test_base_against_brute_force(spark, tiny, head):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    rows = docs.collect()
    train = [r["text"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 10]
    out = lm.score_documents(docs, docs.where(~queries.held_out("doc_id", 10, 0)), max_head=head, vocabulary=min(head, 300), max_train=50)
    got = {r["doc_id"]: r for r in out.collect()}
    for r, want in zip(rows, base_of([r["text"] for r in rows], train), strict=True):
        g = got[r["doc_id"]]
        assert (g["n_tokens"], g["n_known"], g["train_tokens"]) == want[:3] and math.isclose(g["base_score"], want[3], rel_tol=1e-9) and g["score"] < 0


def test_query_scores_against_the_whole_distribution(spark, tiny, monkeypatch):
    """The query's score of short texts, word by word, with the model that it has trained."""
    models = []
    train = lm.train_everywhere
    monkeypatch.setattr(lm, "train_everywhere", lambda *a, **k: models.append(train(*a, **k)) or models[-1])
    rows = queries.op8_gru_likelihood(spark, tiny).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    tok = lambda t: [*t.encode().lower().split(), lm.END]
    c = Counter(w for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10 for w in tok(t))
    n, v = sum(c.values()), len(c)
    share = lambda w: (c[w] + 0.1) / (n + 0.1 * (v + 1))
    model = models[0]
    rare = 1 - sum(map(share, model.words))
    short = [r for r in rows if len(tok(texts[r["doc_id"]])) <= 60]
    assert len(short) >= 10
    for r in short:
        words = tok(texts[r["doc_id"]])
        want = slow_score(model, [model.words.get(w, 0) for w in words]) / math.log(10) + sum(math.log10(share(w) / rare) for w in words if w not in model.words)
        assert math.isclose(r["score"], want, rel_tol=1e-4)


def test_query_learns(spark, small):
    rows = queries.op8_gru_likelihood(spark, small).where("held_out").toPandas()
    assert rows.score.sum() > rows.base_score.sum()


def test_odd_rows(spark):
    docs = odd(spark)
    rows = lm.score_documents(docs, docs, max_head=5, vocabulary=3).collect()
    texts = [t for _, t in ODD]
    want = sorted(base_of(texts, texts))
    got = sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows)
    assert np.allclose(got, want) and {r["n_tokens"] for r in rows if r["doc_id"] in (2, 3, 8)} == {1}
    assert lm.score_documents(none(spark), none(spark)).count() == 0
    alone = lm.score_documents(docs, none(spark).select("doc_id", "text")).collect()
    assert len(alone) == len(ODD) and all(r["base_score"] == 0 and r["n_known"] == 0 for r in alone)


CYCLE = " ".join(["red", "green", "blue", "grey", "pink", "gold", "black", "white"] * 6000)


@pytest.mark.parametrize("texts", [[CYCLE], [CYCLE[:3000]] * 100])
def test_rows_outside_the_first_sample_are_learnt(spark, texts):
    """No text is short enough for the sample; all the learning is the tasks' own."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = lm.score_documents(docs, docs, max_train_chars=20).collect()
    assert all(r["score"] > 0.7 * r["base_score"] for r in rows)


def test_vocabulary_grows_with_the_counts(spark, monkeypatch):
    sizes = []
    new = lm.GruModel.new
    monkeypatch.setattr(lm.GruModel, "new", lambda words, *a: sizes.append(len(words)) or new(words, *a))
    for n in (100, 10_000):
        docs = spark.createDataFrame([(1, " ".join(f"w{k % 300}" for k in range(n)))], "doc_id long, text string")
        lm.score_documents(docs, docs, vocabulary=3).collect()
    assert sizes == [10, 100]


def test_pieces_of_long_documents():
    docs = [np.arange(10, dtype=np.int32), np.arange(3, dtype=np.int32)]
    parts, context = lm.pieces_of(docs, 99, 4)
    assert [p.tolist() for p in parts] == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9], [0, 1, 2]] and context == [99, 3, 7, 99]
    first = [next(lm.windows(parts, [[k]], 8, 99, context))[0][0, 0] for k in range(4)]
    assert first == context


def backward_of(size, rows, lanes, classes):
    m = lm.GruModel.new([b"%d" % k for k in range(size)], 24, classes, 5)
    rng = np.random.default_rng(5)
    inputs, targets = rng.integers(0, size, (2, rows, lanes))
    fresh, mask = rng.random((rows, lanes)) < 0.02, np.ones((rows, lanes), bool)
    states, _, saved = m.forward(inputs, fresh, np.zeros((lanes, 24), np.float32), keep=True)
    return m, (inputs, fresh, targets, mask, states, saved)


def test_a_training_step_takes_its_softmax_in_blocks():
    """No array holds all classes for all symbols of a step, which falls out of a core's cache."""
    import tracemalloc

    m, step = backward_of(400, 32, 512, 300)
    tracemalloc.start()
    m._backward(*step)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6, peak


def test_large_weights_do_not_overflow(monkeypatch):
    """Logits are shifted by their largest only where they can overflow; that changes nothing else."""
    m, step = backward_of(50, 4, 16, 6)
    flat, targets = step[4].reshape(-1, 24), step[2].ravel()
    small = m._backward(*step)[1], m.log_probabilities(flat, targets)
    with monkeypatch.context() as patch:
        patch.setattr(lm, "_bounded", lambda w, b: False)
        assert m._backward(*step)[1] == pytest.approx(small[0], rel=1e-5)
        assert np.allclose(m.log_probabilities(flat, targets), small[1], atol=1e-4)
    m.p["c"] *= 10_000
    m.p["w"] *= 10_000
    assert np.isfinite(m._backward(*step)[1]) and np.isfinite(m.log_probabilities(flat, targets)).all()


def test_words_are_those_of_splitting_bytes():
    texts = ["", None, " \t", "A b\x0bÄÖ \x85   x\x1cy\x00 ", "\n\na\r\n", "Ab ab AB", "é"]
    words, counts = lm.words_of(pa.array(texts))
    want = [lm.tokens((t or "").encode())[:-1] for t in texts]
    assert words.to_pylist() == [w for own in want for w in own] and counts.tolist() == list(map(len, want))
    for known in ([b"ab", lm.END, b"a"], [b"ab"], []):
        places, ends, tail = lm.places_of(pa.array(texts), pa.array(known, pa.binary()))
        tokens = [w for own in want for w in [*own, lm.END]]
        assert places.tolist() == [known.index(w) if w in known else -1 for w in tokens]
        assert ends.tolist() == np.cumsum([len(own) + 1 for own in want]).tolist() and tail.to_pylist() == [w for w in tokens if w not in known]


def test_slices_hold_every_text_once():
    texts = pa.array(["ab", None, "c" * 50, "", "de", "f"])
    for most in (1, 4, 5, 60, 100):
        parts = list(lm.slices_of(texts, most))
        assert pa.concat_arrays(parts).equals(texts) and all(len(p) == 1 or sum(len(t or "") for t in p.to_pylist()) <= most for p in parts)
    assert list(lm.slices_of(texts[:0])) == []


def test_counts_in_bounded_tables(spark):
    texts = [None, "", *(f"w{k % 40} W{k % 7} the" for k in range(500))]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    want = Counter(w for t in texts for w in lm.tokens((t or "").encode()))
    for limit in (1, 20, 300_000):
        assert {bytes(r["token"]): r["c"] for r in lm.count_tokens(docs, "text", limit).collect()} == want


def test_sums_by_key():
    rng = np.random.default_rng(4)
    keys = np.minimum(rng.geometric(0.02, 3000), 200)
    rows = rng.standard_normal((3, 3000, 5))
    found, sums = lm._sum_by(rows, keys)
    assert sorted(found.tolist()) == np.unique(keys).tolist()
    for k, own in zip(found, sums.transpose(1, 0, 2), strict=True):
        assert np.allclose(own, rows[:, keys == k].sum(1))


def calls_of(work):
    """How many functions in C are called from Python."""
    import sys

    calls = [0]

    def count(frame, event, arg):
        calls[0] += event == "c_call"

    sys.setprofile(count)
    try:
        work()
    finally:
        sys.setprofile(None)
    return calls[0]


def test_windows_and_words_take_no_call_each():
    docs = [np.arange(64, dtype=np.int32)] * 512
    plan = lm.lane_plan([64] * 512, 512)
    first = lm.windows(docs, plan, 32, 99)
    next(first)
    assert calls_of(lambda: next(first)) < 50
    texts, known = pa.array(["a b c d e " * 1000] * 3), pa.array([b"a", lm.END], pa.binary())
    lm.places_of(texts, known)  # imports what it needs
    assert calls_of(lambda: lm.places_of(texts, known)) < 100
