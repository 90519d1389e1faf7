import random

import numpy as np
import xxhash

from codexlake.llm import queries, url_filter

URLS = ["http://www.Example.com/en/x?y#z", "https://a.b.net/es/", "ftp://net/fr/1", "https://example.com", "no scheme", None, "", "http://", "http://.com/", "http://xnet/fr/", "http://a.net/e", "//x.com/", "http://EXAMPLE.COM/en/é", "https://u@h.com:80/a/b"]


def judge(url, rules):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fit = [(len(h + p), len(h), h + p, v) for v, h, p in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fit)[2] if fit else None, max(fit)[3] if fit else "allow"


def rules_and_urls(seed):
    rng = random.Random(seed)
    name = lambda: ".".join(rng.choice(["a", "b", "com", "net"]) for _ in range(rng.randint(1, 3)))
    path = lambda: "".join(rng.choice(["/", "x", "yy", "/en"]) for _ in range(rng.randint(0, 3)))
    rules = {(h := name(), p := ("/" + path()) if rng.random() < 0.8 else ""): (rng.choice(["allow", "block"]), h, p) for _ in range(30)}
    return list(rules.values()), URLS + [f"http://{name()}/{path()}" for _ in range(200)]


def test_against_brute_force(spark):
    for seed in range(3):
        rules, urls = rules_and_urls(seed)
        df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'x' as id", "'y' as host", "'z' as rule")
        want = {i: judge(u, rules) for i, u in enumerate(urls)}
        for out in (url_filter.filter_urls(df, rules), url_filter.filter_urls_joined(df, spark.createDataFrame(rules, "verdict string, host string, path string"), [len(p) for _, _, p in rules])):
            assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()} == want


def test_collisions_are_confirmed(tmp_path, monkeypatch):
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda key, seed=0: len(key) % 3)
    rules, urls = rules_and_urls(9)
    (tmp_path / "i").write_bytes(url_filter.build_index(rules))
    index = url_filter.DigestIndex(str(tmp_path / "i"))
    parts = [url_filter.split_url(u) for u in urls]
    assert [(*p, *j) for p, j in zip(parts, index.judge(parts), strict=True)] == [judge(u, rules) for u in urls]


def test_index_is_sorted_and_mapped(tmp_path):
    (tmp_path / "i").write_bytes(url_filter.build_index(queries.URL_RULES))
    index = url_filter.DigestIndex(str(tmp_path / "i"))
    assert isinstance(index.blob, np.memmap) and (np.diff(index.digests.astype(object)) > 0).all() and len(index.digests) == 5


def test_query_and_empty_tables(spark, tiny):
    want = {r["page_id"]: judge(r["url"], queries.URL_RULES) for r in spark.read.parquet(f"{tiny}/pages.parquet").collect()}
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in queries.op7_url_digest_array(spark, tiny).collect()}
    assert got == want
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.filter_urls(none, queries.URL_RULES).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/"), (1, "http://a.com/"), (None, "http://a.net/es/")], "page_id long, url string")
    assert {(r["page_id"], r["verdict"]) for r in url_filter.filter_urls(one, queries.URL_RULES).collect()} == {(1, "allow"), (None, "block")}
    assert {r["verdict"] for r in url_filter.filter_urls(one, []).collect()} == {"allow"}
