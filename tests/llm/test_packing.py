import json
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from codexlake.llm import packing, queries
from tests.llm.helpers import ODD, none, odd

PATH = public_tokenizers.path("byte_bpe_50k.json")


def one_by_one(lengths, capacities, weights):
    """Best fit decreasing, bin by bin; returns the residuals."""
    bins = []
    for n in sorted(lengths, reverse=True):
        d = np.array([n, 1, n * n])
        fit = [b for b in bins if (b >= d).all()]
        if fit:
            best = min(fit, key=lambda b: ((((b - d) / capacities) ** 2) * weights).sum())
            best -= d
        else:
            bins.append(np.array(capacities) - d)
    return sorted(tuple(b.tolist()) for b in bins)


def unrolled(runs, capacities):
    residuals = {}
    for n, own in runs.items():
        rank = 0
        for r in own:
            assert r.first == rank
            rank += r.count
            for k in range(r.count):
                b = r.bin + k // r.per_bin
                d = residuals.setdefault(b, [[], list(capacities)])
                d[0].append((r.offset + k % r.per_bin * n, n))
                for i, x in enumerate((n, 1, n * n)):
                    d[1][i] -= x
    assert sorted(residuals) == list(range(len(residuals)))
    for places, left in residuals.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert min(left) >= 0
    return sorted(tuple(left) for _, left in residuals.values())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120), st.integers(1, 12), st.integers(1600, 2500))
def test_plan_equals_one_by_one(lengths, documents, attention):
    capacities, weights = (40, documents, attention), (1.0, 0.5, 0.25)
    runs = packing.plan(Counter(lengths), capacities, weights)
    assert unrolled(runs, capacities) == one_by_one(lengths, capacities, weights)


def test_dot_rule_keeps_every_capacity():
    rng = random.Random(1)
    lengths = [rng.randint(1, 64) for _ in range(500)]
    capacities = (64, 5, 4096)
    left = unrolled(packing.plan(Counter(lengths), capacities, (1.0, 1.0, 1.0), "dot"), capacities)
    assert len(left) >= sum(lengths) / 64


def test_a_piece_beyond_a_capacity_is_refused():
    with pytest.raises(ValueError):
        packing.plan({10: 1}, (20, 5, 50), (1, 1, 1))


def test_cut_points():
    assert packing.cut_points(5, 10) == [(0, 5)]
    assert packing.cut_points(10, 10) == [(0, 10)]
    assert packing.cut_points(25, 10) == [(0, 5), (5, 10), (15, 10)]


def plain(text):
    """The contract's ids: the tokenizer as its file gives it."""
    return np.array(Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


TOKENIZER = Tokenizer.from_file(PATH)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([*"ab ,.\n\t1é漢!'\u00a0\u2003", " the", "n't", "<|endoftext|>", "<|endof"]) | st.characters(exclude_categories=["Cs"]), max_size=60).map("".join))
def test_ranks_give_the_tokenizers_ids(text):
    assert packing.encoder_of(PATH, True).encode(text) == np.array(TOKENIZER.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("text", ["a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|><|endoftext|> y", "\n" * 300_000, " " * 999 + "a", "^" * 200_000, "漢" * 100_000, "e\u0301" * 50_000, "1" * 100_000])
def test_added_tokens_and_long_runs(text):
    assert packing.encoder_of(PATH, True).encode(text) == packing.encoder_of(PATH, False).encode(text) == plain(text)


def test_every_code_point_splits_alike():
    texts = [f"a{c}b 1{c}2 !{c}? {c} {c}{c}a \n{c}\n\n" for n in range(0x30000) if not 0xD800 <= n < 0xE000 for c in (chr(n),)]
    encode = packing.encoder_of(PATH, True).ranked.encode_ordinary
    assert all(e.ids == encode(t) for e, t in zip(TOKENIZER.encode_batch_fast(texts, add_special_tokens=False), texts, strict=True))


def test_ranks_are_used_only_where_they_suffice(tmp_path):
    assert packing.ranks_suffice(PATH)
    assert not packing.ranks_suffice(public_tokenizers.path("word_bpe_49k.json"))
    with open(PATH, encoding="utf-8") as f:
        file = json.load(f)
    file["model"]["merges"] = file["model"]["merges"][::-1]
    (other := tmp_path / "other.json").write_text(json.dumps(file), encoding="utf-8")
    assert not packing.ranks_suffice(str(other))


def check(rows, texts, max_tokens):
    """Every piece's ids, and gapless sequences."""
    t = Tokenizer.from_file(PATH)
    ids = {i: [*t.encode(x or "", add_special_tokens=False).ids, 2] for i, x in texts.items()}
    pieces, bins = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == set(ids)
    for i, own in pieces.items():
        own.sort(key=lambda r: r["piece"])
        at = 0
        for k, r in enumerate(own):
            assert (r["piece"], r["start"]) == (k, at)
            assert len(ids[i]) > max_tokens or len(own) == 1
            assert k == 0 or r["length"] == max_tokens
            part = np.array(ids[i][at : at + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part)
            at += r["length"]
        assert at == len(ids[i])
    for own in bins.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= max_tokens
    return len(bins)


def test_query_packs_all_documents(spark, tiny):
    rows = queries.op1_best_fit_packing(spark, tiny).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    n = check(rows, texts, 1024)
    assert n <= 1.02 * sum(r["length"] for r in rows) / 1024 + 1


def test_odd_rows(spark):
    rows = packing.pack(odd(spark), PATH, max_tokens=64, max_documents=3).collect()
    assert sum(r["doc_id"] == 7 for r in rows) == 2
    assert [(r["length"]) for r in rows if r["doc_id"] in (2, 3)] == [1, 1]
    assert any(r["doc_id"] is None for r in rows)
    unique = [r for r in rows if r["doc_id"] not in (None, 7)]
    n = Counter(r["sequence_id"] for r in rows)
    assert max(n.values()) <= 3
    texts = {i: x for i, x in ODD if i not in (None, 7)}
    assert {r["doc_id"] for r in unique} == set(texts)
    assert packing.pack(none(spark), PATH).count() == 0


def test_added_tokens_in_documents(spark):
    texts = {1: "a<|endoftext|>b", 2: "<|endoftext|>", 3: "plain"}
    assert check(packing.pack(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), PATH).collect(), texts, 1024) == 1
