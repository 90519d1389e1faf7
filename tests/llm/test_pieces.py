import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from codexlake.llm import pieces, queries
from tests.llm.helpers import ODD, none, odd

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return pieces.model(PATH)


def all_paths(model, text):
    """Every segmentation of the whole text, best first, without cutting it."""
    whole = pieces.SPACE + text.replace(" ", pieces.SPACE)
    _, into = model.lattice(whole)
    out = []

    def walk(at, score, ids):
        if not at:
            out.append((score, ids))
        for start, own, value in into[at]:
            walk(start, score + value, own + ids)

    walk(len(whole), 0, b"")
    return sorted(out, key=lambda p: -p[0])


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abhelo ,.\n☃é", min_size=1, max_size=9), st.integers(1, 7))
def test_n_best_against_all_paths(text, n):
    model = pieces.model(PATH)
    best, found = all_paths(model, text), model.encode(text, n)
    assert [s for s, _ in found] == [s for s, _ in best[:n]]
    assert len({i for _, i in found}) == len(found)
    assert all((s, i) in set(best) for s, i in found)


def test_search_leaves_in_order_of_score(model):
    scores = [s for s, _ in model.search("▁hellothere", 50)]
    assert scores == sorted(scores, reverse=True) and len(scores) == 50


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=40).filter(lambda t: "▁" not in t))
def test_round_trip(text):
    model = pieces.model(PATH)
    ids = np.frombuffer(model.encode(text)[0][1], "<i4").tolist()
    assert model.decode(ids) == text
    assert SentencePieceProcessor(model_file=PATH).decode(ids) == text


def test_small_memory_changes_nothing(model):
    text = "some words, and some other words. and some words"
    assert pieces.PieceModel(PATH, memory=2).encode(text, 4) == model.encode(text, 4)


def test_odd_rows_and_frames(spark):
    out = pieces.encode(odd(spark), PATH, n=2)
    best = out.where("rank = 1")
    assert best.count() == len(ODD)
    back = {r["doc_id"]: r["text"] for r in pieces.decode(best, PATH).collect()}
    assert all(back[i] == (t or "") for i, t in ODD)
    assert {len(r["ids"]) for r in best.where("doc_id in (2, 3)").collect()} == {0}
    assert pieces.encode(none(spark), PATH).count() == 0
    assert pieces.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), PATH).first()["text"] is None


def test_query_restores_every_text(spark, tiny):
    rows = queries.op2_sentencepiece_nbest(spark, tiny).collect()
    assert len(rows) == 200 and all(r["restored"] and r["n_best"] == 3 for r in rows)


@pytest.mark.parametrize("unit", ["1", "1234567890", "日本", "ก", "😀", "☃a1", "日本ab"])
def test_long_runs_without_spaces(unit):
    model, text = pieces.PieceModel(PATH), (unit * 100_000)[:100_000]
    whole = pieces.SPACE + text
    score, ids = model.encode(text)[0]
    assert (ids, score) == model.first_two(whole)[:2]
    assert model.decode(np.frombuffer(ids, "<i4").tolist()) == text
    assert sum(map(len, model.known)) < 10_000
    assert model.encode(text, 3)[0] == (score, ids)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab1é日☃,", min_size=1, max_size=30))
def test_parts_of_a_chunk_join_to_the_whole(text):
    model = pieces.PieceModel(PATH)
    assert model._learn(pieces.SPACE + text) == model.first_two(pieces.SPACE + text)


def best_scores(model, text, n):
    """Scores of the n best segmentations of a whole text: n-best lists at every place, no cutting, no search."""
    whole = pieces.SPACE + text.replace(" ", pieces.SPACE) if text else ""
    into = model.lattice(whole)[1] if whole else []
    lists = [[0]] + [[] for _ in whole]
    for at in range(1, len(whole) + 1):
        lists[at] = sorted((s + value for start, _, value in into[at] for s in lists[start]), reverse=True)[:n]
    return lists[len(whole)]


def test_query_rows_against_n_best_lists(spark, tiny):
    model = pieces.model(PATH)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    sp = SentencePieceProcessor(model_file=PATH)
    checked = 0
    for r in queries.op2_sentencepiece_nbest(spark, tiny).collect():
        text = texts[r["doc_id"]]
        if len(text) > 2500:
            continue
        paths = [tuple(map(int, p.split(":"))) for p in r["best"].split(",")]
        assert [p[0] for p in paths] == best_scores(model, text, 3)
        assert (r["score"], r["n_pieces"], r["ids_crc32"]) == paths[0] and r["n_best"] == len(paths)
        # The library's own best path may be another of the same score.
        own = sp.encode(text)
        assert sum(int(sp.get_score(k)) if not sp.is_byte(k) else 0 for k in own) <= r["score"] + 10**7
        checked += 1
    assert checked > 100
