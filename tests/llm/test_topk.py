import random

import numpy as np
import pytest

from codexlake.llm import queries, topk


def brute(items, asked, k):
    return {q: sorted((bin((c ^ x) & (1 << 64) - 1).count("1"), i) for i, c in items if c is not None)[:k] for q, x in asked if x is not None}


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def run(spark, items, asked, k, **sizes):
    a = spark.createDataFrame([(i, None if c is None else signed(c)) for i, c in items], "id long, code long")
    b = spark.createDataFrame([(i, None if c is None else signed(c)) for i, c in asked], "query_id long, code long")
    out = {}
    for r in topk.exact_topk(a, b, k, **sizes).collect():
        out.setdefault(r["query_id"], {})[r["rank"]] = (r["distance"], r["id"])
    return {q: [own[n] for n in sorted(own)] for q, own in out.items()}


@pytest.mark.parametrize("block", [65_536, 40, 3])
def test_against_brute_force(spark, block):
    rng = random.Random(4)
    centres = [rng.getrandbits(64) for _ in range(5)]
    items = []
    for i in range(300):
        c = rng.choice(centres) if i % 3 else rng.getrandbits(64)
        for b in rng.sample(range(64), rng.choice([0, 0, 1, 5])):
            c ^= 1 << b
        items.append((i, c))
    items += [(1000 + i, centres[0]) for i in range(50)] + [(999, None)]
    asked = [(i, c) for i, c in items if i % 20 == 0] + [(7001, rng.getrandbits(64)), (7002, None), (7003, items[0][1])]
    assert run(spark, items, asked, 10, block=block) == brute(items, asked, 10)


def test_few_rows_and_none(spark):
    assert run(spark, [(1, 5), (1, 5), (2, 4)], [(9, 5)], 10) == {9: [(0, 1), (0, 1), (1, 2)]}
    assert run(spark, [], [(9, 5)], 3) == {} and run(spark, [(1, 5)], [], 3) == {}


def test_a_probe_finds_exactly_its_radius():
    rng = np.random.default_rng(0)
    codes, asked = rng.integers(0, 1 << 63, 800, dtype=np.uint64), rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    for low, width, prefix in ((0, 9, 3), (20, 16, 2), (32, 32, 5), (10, 12, 0)):
        value = lambda x: (x >> np.uint64(low)) & np.uint64((1 << width) - 1)  # noqa: B023, E731
        head = value(codes[0]) >> np.uint64(width - prefix)
        own = codes[(value(codes) >> np.uint64(width - prefix)) == head]
        table = topk.SegmentTable(own, np.arange(len(own)), np.ones(len(own), np.int64), low, width, prefix)
        for radius in range(width + 1):
            q, row = table.probe(asked, radius)
            got = sorted(zip(q.tolist(), table.codes[row].tolist(), strict=True))
            assert got == sorted((i, int(c)) for i, x in enumerate(asked) for c in own if int(value(c) ^ value(x)).bit_count() == radius)


def test_copies_of_codes_and_queries_are_bounded(spark):
    """A code is written once a segment, a query once for each head within the radius."""
    rng = random.Random(1)
    codes = [signed(rng.getrandbits(64)) for _ in range(600)]
    entries = spark.createDataFrame([(c, [i]) for i, c in enumerate(codes)], "code long, ids array<long>")
    own = topk.segments_of(600)
    table, crowded = topk.segment_rows(entries, own, 4, 50)
    assert table.count() == 600 * len(own) and table.select("seg", "head").distinct().count() == 16 * len(own)
    active = spark.createDataFrame([(c, 64) for c in codes[:30]], "code long, bound long")
    for radius, heads in ((0, 1), (1, 5), (2, 11), (4, 16)):
        assert topk.visits(active, own, 4, radius, crowded).count() == 30 * len(own) * heads


def test_crowded_heads_and_clashing_names(spark):
    """A third of all codes with one segment value, and columns of every used name."""
    rng = random.Random(2)
    items = [(i, (rng.getrandbits(48) << 16) | (7 if i % 3 == 0 else rng.getrandbits(16))) for i in range(400)]
    asked = [r for r in items if r[0] % 20 == 0]
    assert run(spark, items, asked, 5, block=16) == brute(items, asked, 5)
    frame = lambda rows, name: spark.createDataFrame([(i, signed(c)) for i, c in rows], f"{name} long, code long").selectExpr("*", *(f"'x' AS {c}" for c in ("n", "seg", "head", "salt", "bound", "rank", "q", "ids")))
    assert topk.exact_topk(frame(items, "id"), frame(asked, "query_id"), 5).count() == 5 * len(asked)


def test_sign_codes(spark):
    rows = [(1, [0.0, -1.0, 2.0]), (2, None), (3, [-1.0, None, float("nan")]), (4, [float(i - 50) for i in range(100)])]
    got = {r["vec_id"]: r["code"] for r in topk.sign_codes(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding").collect()}
    assert got[1] == 0b101 and got[2] is None and got[3] == 0 and got[4] is not None


def test_query_against_brute_force(spark, tiny):
    rows = [(r["vec_id"], sum(1 << i for i, x in enumerate(r["embedding"]) if x >= 0)) for r in spark.read.parquet(f"{tiny}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 20 == 0], 10)
    out = {}
    for r in queries.op10_multi_index_topk(spark, tiny).collect():
        out.setdefault(r["query_id"], {})[r["rank"]] = (r["distance"], r["vec_id"])
    assert {q: [own[n] for n in sorted(own)] for q, own in out.items()} == want
