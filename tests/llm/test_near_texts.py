import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from codexlake.llm import near_texts
from tests.llm.helpers import none, odd


def shingles(text, words=5):
    w = (text or "").lower().split()
    return {" ".join(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {" ".join(w)}


def survivors(rows, similarity=0.8):
    """The least id of each component over all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if len(a & b) >= similarity * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {find(i) for i in root}


def edited(rng, words, edits, vocabulary):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = rng.choice(vocabulary)
    return out


def corpus(seed, groups, most, share=None):
    """Groups of edited copies, some of them around one long passage; and strangers."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(share or 0)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 150))]
        for _ in range(rng.randint(1, most)):
            rows.append(" ".join(passage + edited(rng, base, rng.choice([0, 0, 1, 1, 2, 4]), vocabulary)))
    rng.shuffle(rows)
    return list(enumerate(rows))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize(("groups", "most", "share"), [(120, 6, None), (3, 120, None), (60, 5, 60)])
def test_survivors_against_all_pairs(spark, groups, most, share):
    rows = corpus(groups, groups, most, share)
    kept = {r["doc_id"] for r in near_texts.keep_one(frame(spark, rows)).collect()}
    assert kept == survivors(rows)


def test_a_chain_is_one_group(spark):
    """Each text is like its neighbours and unlike the rest: components, not leaders, decide."""
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(words[4 * k : 4 * k + 100])) for k in range(70)]
    assert survivors(rows) == {0}
    assert [r["doc_id"] for r in near_texts.keep_one(frame(spark, rows)).collect()] == [0]


def test_no_row_is_lost_by_a_shared_passage(spark):
    """Many texts around one passage, less alike than asked: all stay."""
    rng = random.Random(4)
    passage = " ".join(f"p{k}" for k in range(80))
    rows = [(k, f"{passage} " + " ".join(f"x{rng.random()}" for _ in range(40))) for k in range(200)]
    assert near_texts.keep_one(frame(spark, rows)).count() == 200


def test_blocks_of_a_crowded_band(spark):
    """Small blocks give the links that large ones give."""
    rows = corpus(9, 4, 90, 40)
    texts = frame(spark, rows).selectExpr("doc_id AS id", "xxhash64(doc_id, text) AS h", "text")
    classes = near_texts.sketches(texts, 5).dropDuplicates(["class"]).cache()
    found = [{(r["node"], r["component"]) for r in near_texts.components_of(classes, texts, 5, 0.8, block).collect()} for block in (3, 1000)]
    assert found[0] == found[1] and found[0]


def test_tiny_corpus_against_all_pairs(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert {r["doc_id"] for r in near_texts.keep_one(docs).collect()} == survivors(rows)


def test_bands_miss_few_linked_pairs():
    rng = np.random.default_rng(2)
    missed = 0
    for _ in range(2000):
        common, own = rng.integers(0, 1 << 63, 160, dtype=np.uint64), rng.integers(0, 1 << 63, (2, 20), dtype=np.uint64)
        a, b = (near_texts.bands(np.concatenate([common, x])) for x in own)
        missed += not (a == b).any()
    assert missed <= 20


def test_fingerprints_of_linked_pairs_are_within_the_bits():
    rng = np.random.default_rng(3)
    beyond = 0
    for _ in range(500):
        common, own = rng.integers(0, 1 << 63, 160, dtype=np.uint64), rng.integers(0, 1 << 63, (2, 20), dtype=np.uint64)
        a, b = (near_texts.wide_fingerprint(np.concatenate([common, x])) for x in own)
        beyond += np.bitwise_count(a ^ b).sum() > near_texts.BITS
    assert beyond <= 10


def test_odd_rows(spark):
    kept = near_texts.keep_one(odd(spark))
    assert kept.columns == odd(spark).columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 5, 6, 9, 10]
    assert near_texts.keep_one(none(spark)).count() == 0
    assert near_texts.keep_one(odd(spark).withColumn("_id", F.lit(1)).withColumn("h", F.lit(2))).count() == 7


def test_one_id_with_different_texts_loses_none(spark):
    rows = [(7, "one two three four five six"), (7, "quite another text of some words"), (7, "one two three four five six"), (8, "One two three four five six")]
    kept = near_texts.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(7, "one two three four five six"), (7, "quite another text of some words")]


def test_cells_are_segment_counts_of_the_simhash():
    """Candidates hang on the fingerprint's popcounts alone: where a set bit lies in its segment changes no cell."""
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 1 << 63, (20, near_texts.WORDS), dtype=np.uint64)
    low = np.uint64(0x5555555555555555)
    swapped = ((prints & low) << np.uint64(1)) | ((prints >> np.uint64(1)) & low)
    assert (near_texts.cells(prints) == near_texts.cells(swapped)).all()
    other = prints ^ np.uint64(1)
    changed = (near_texts.cells(prints) != near_texts.cells(other)).mean()
    assert 0 < changed < 0.5 and near_texts.cells(prints, 9).shape == (20, near_texts.tables_of(9))


def test_a_crowded_cell_gives_leaders_and_its_near_rows():
    rng = np.random.default_rng(6)
    prints = np.r_[np.repeat(rng.integers(0, 1 << 63, (1, 4), dtype=np.uint64), 300, 0), rng.integers(0, 1 << 63, (50, 4), dtype=np.uint64)]
    node = np.arange(350)
    pairs, many = near_texts.near_in_cell(node, prints)
    assert pairs == [(0, k) for k in range(1, 300)] and many.tolist() == list(range(300))
    pairs, many = near_texts.near_in_cell(node[298:], prints[298:])
    assert pairs == [(298, 299)] and not len(many)


def test_bitmaps_rule_out_no_similar_pair():
    rng = np.random.default_rng(8)
    ruled_out = 0
    for n in (1, 4, 5, 40, 150, 900, 5000):
        for share in (0.5, 0.8, 0.889, 0.9, 1.0):
            common = rng.integers(0, 1 << 64, int(n * share), dtype=np.uint64)
            a, b = (np.unique(np.r_[common, rng.integers(0, 1 << 64, n - len(common), dtype=np.uint64)]) for _ in range(2))
            maps = [np.frombuffer(near_texts.bitmap_of(x), np.uint64) for x in (a, b)]
            maybe = near_texts.maybe_similar(len(a), maps[0], np.array([len(b)]), maps[1][None], 0.8)[0]
            assert maybe or not near_texts.similar(a, b, 0.8)
            ruled_out += not maybe
    assert ruled_out >= 5


def test_a_large_group_is_not_written_once_a_table(spark, monkeypatch):
    """Near copies, and texts around one passage, share many cells; what is kept of them stays by class."""
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(3000)]
    base, passage = ([rng.choice(vocabulary) for _ in range(n)] for n in (120, 100))
    texts = [edited(rng, base, 1, vocabulary) for _ in range(250)] + [passage + [rng.choice(vocabulary) for _ in range(25)] for _ in range(250)]
    counts, cut = {}, near_texts.cut

    def counted(df, label):
        out = cut(df, label)
        counts[label] = out.count()
        return out

    monkeypatch.setattr(near_texts, "cut", counted)
    rows = [(k, " ".join(x)) for k, x in enumerate(texts)]
    assert {r["doc_id"] for r in near_texts.keep_one(frame(spark, rows)).collect()} == survivors(rows)
    assert max(counts.values()) <= 20 * len(rows), counts
