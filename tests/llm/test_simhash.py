import random

import numpy as np
import xxhash

from codexlake.llm import queries, simhash
from codexlake.llm.components import connected_components
from tests.llm.helpers import ODD, none, odd


def slow_fingerprint(text):
    """Bit by bit, as stated."""
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, bits=3):
    """Smallest id reachable over all pairs of (id, fingerprint)."""
    root = {i: i for i, _ in values}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(values):
        for j, b in values[:n]:
            if (a ^ b).bit_count() <= bits:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in root}


def test_fingerprints_against_bit_by_bit():
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 4, 300, 700):
        text = " ".join(rng.choice(["Aa", "bß", "C\tc", "d\n", "é", " x"]) for _ in range(n))
        assert simhash.fingerprint(text.encode()) == slow_fingerprint(text)


def test_manhattan_of_segment_counts_is_a_lower_bound():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 63, (2, 500), dtype=np.uint64)
    spread = lambda x: (simhash.segment_counts(x)[:, None] >> (np.arange(32, dtype=np.uint64) * np.uint64(2))) & np.uint64(3)
    assert (np.abs(spread(a).astype(int) - spread(b).astype(int)).sum(1) <= np.bitwise_count(a ^ b)).all()


def near_codes(rng, n):
    """Clusters of codes a few bits apart, and strangers."""
    out = set()
    while len(out) < n:
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, 40)):
            out.add(base)
            for b in rng.sample(range(64), rng.randint(0, 4)):
                base ^= 1 << b
    return sorted(out)[:n]


def linked(spark, codes, block):
    rows = [(int(np.uint64(c).view(np.int64)), i) for i, c in enumerate(codes)]
    edges = simhash.link_fingerprints(spark.createDataFrame(rows, "fp long, rep long"), 3, block)
    found = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    return {i: found.get(i, i) for i in range(len(codes))}


def test_links_against_all_pairs(spark):
    codes = near_codes(random.Random(5), 500)
    assert linked(spark, codes, 4096) == groups(list(enumerate(codes)))


def test_hot_cells_in_blocks(spark):
    rng = random.Random(6)
    base = rng.getrandbits(64)
    codes = sorted({base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(400)})
    assert linked(spark, codes, 8) == groups(list(enumerate(codes)))


def test_components_of_a_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(7, i) for i in range(200, 400)] + [(7, 3), (9, 9)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(chain + hub, "a long, b long")).collect()}
    assert all(found[i] == 100 for i in range(101, 161)) and all(found[i] == 3 for i in [7, *range(200, 400)]) and 9 not in found
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_against_brute_force(spark, tiny):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]
    prints = [(i, slow_fingerprint(t)) for i, t in texts]
    want = groups(prints)
    rows = queries.op4_simhash_popcount(spark, tiny).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {i: (f"{p:016x}", want[i]) for i, p in prints}


def test_odd_rows(spark):
    rows = simhash.near_duplicates(odd(spark)).collect()
    assert len(rows) == len(ODD)
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["fingerprint"] == by[3]["fingerprint"] == by[8]["fingerprint"] == "0" * 16
    assert by[2]["component_id"] == by[3]["component_id"] == by[8]["component_id"] == 2
    assert by[1]["component_id"] == by[7]["component_id"] == 1 and by[None]["component_id"] is None
    assert simhash.near_duplicates(none(spark)).count() == 0
