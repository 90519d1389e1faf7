"""URL rules from a sorted array of 64-bit digests.

A rule is a host and the start of a path.  Its key is host + path; the xxh64
digests of all keys lie sorted in one file, beside the keys themselves.  Workers
memory-map the file, probe every (host suffix, path prefix) of a batch of URLs by
one vectorised binary search, and compare the stored key with each hit, so that a
digest collision cannot decide.

Defined cases: a null URL, or one without ``://``, has an empty host and path and
meets no rule; of several rules that fit, the longest key wins, then the longer
host; of equal rules the last stated verdict holds; no rule at all: ``allow``;
repeated rows are judged alike; an empty table gives none; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexlake.llm.common import on_workers
from codexlake.session import passing_folder

_HOST, _PATH = re.compile(r"[^/?#]*"), re.compile(r"[^?#]*")
_MAGIC = b"CXURLIX1"
#: Digest files that an application's file service has already.
_SENT: set[tuple[str, str]] = set()


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null or no ``://``."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    m = _HOST.match(url, at + 3)
    host = m[0].encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    return host, _PATH.match(url, m.end())[0]


def build_index(rules: Sequence[tuple[str, str, str]]) -> bytes:
    """The digest file of (verdict, host, path) rules."""
    keys = {f"{host}{path}": verdict for verdict, host, path in rules}
    entries = sorted((xxhash.xxh64_intdigest(k.encode()), k.encode(), v) for k, v in keys.items())
    blob = b"".join(k for _, k, _ in entries)
    ends = np.cumsum([0, *(len(k) for _, k, _ in entries)], dtype=np.int64)
    lengths = np.unique(np.array([len(path) for _, _, path in rules], np.int64))
    head = _MAGIC + struct.pack("<QQ", len(entries), len(lengths))
    return (
        head
        + lengths.tobytes()
        + np.array([d for d, _, _ in entries], np.uint64).tobytes()
        + ends.tobytes()
        + np.array([v == "block" for *_, v in entries], np.uint8).tobytes()
        + blob
    )


class DigestIndex:
    """A mapped digest file."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        if raw[:8].tobytes() != _MAGIC:
            raise ValueError(f"{path} is no digest index")
        n, m = struct.unpack("<QQ", raw[8:24].tobytes())
        at = 24
        self.path_lengths = raw[at : at + 8 * m].view(np.int64).tolist()
        at += 8 * m
        self.digests = raw[at : at + 8 * n].view(np.uint64)
        at += 8 * n
        self.ends = raw[at : at + 8 * (n + 1)].view(np.int64)
        at += 8 * (n + 1)
        self.block = raw[at : at + n]
        self.blob = raw[at + n :]

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The entry of each key, or -1."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.digests) or not keys:
            return out
        want = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        at = np.searchsorted(self.digests, want)
        hits = np.flatnonzero((at < len(self.digests)) & (self.digests[np.minimum(at, len(self.digests) - 1)] == want))
        for i in hits.tolist():
            j = int(at[i])
            while j < len(self.digests) and self.digests[j] == want[i]:
                if self.blob[self.ends[j] : self.ends[j + 1]].tobytes() == keys[i]:
                    out[i] = j
                    break
                j += 1
        return out

    def judge(self, parts: list[tuple[str, str]]) -> list[tuple[str | None, str]]:
        """Rule and verdict of each (host, path)."""
        keys, owner, size = [], [], []
        for n, (host, path) in enumerate(parts):
            for suffix in suffixes(host):
                for k in self.path_lengths:
                    if k <= len(path):
                        keys.append(f"{suffix}{path[:k]}".encode("utf-8", "surrogatepass"))
                        owner.append(n)
                        size.append((len(suffix) + k, len(suffix)))
        best: dict[int, tuple] = {}
        found = self.find(keys)
        for i in np.flatnonzero(found >= 0).tolist():
            best[owner[i]] = max(best.get(owner[i], ((-1, -1),)), (size[i], keys[i].decode("utf-8", "surrogatepass"), bool(self.block[found[i]])))
        return [(best[n][1], "block" if best[n][2] else "allow") if n in best else (None, "allow") for n in range(len(parts))]


def suffixes(host: str) -> list[str]:
    """The host and every domain above it."""
    out = [host] if host else []
    at = host.find(".")
    while at >= 0:
        if host[at + 1 :]:
            out.append(host[at + 1 :])
        at = host.find(".", at + 1)
    return out


def filter_urls(df: DataFrame, rules: Sequence[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", max_index_bytes: int = 1 << 30) -> DataFrame:
    """Judge every URL by a rule list small enough to send to each executor.

    The digest file goes out through Spark's own file service, once to an
    executor, and is mapped there.  Above ``max_index_bytes`` this refuses; use
    ``filter_urls_joined``, which shuffles a rule table of any size.
    """
    data = build_index(rules)
    if len(data) > max_index_bytes:
        raise ValueError(f"the digest index has {len(data)} bytes, more than {max_index_bytes}; use filter_urls_joined")
    name = f"url-rules-{hashlib.sha256(data).hexdigest()[:24]}.idx"
    context = df.sparkSession.sparkContext
    if (context.applicationId, name) not in _SENT:
        local = os.path.join(passing_folder(), name)
        with open(local, "wb") as out:
            out.write(data)
        context.addFile(local)
        _SENT.add((context.applicationId, name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = DigestIndex(SparkFiles.get(name))
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            judged = index.judge(parts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), pa.string()) for c in (zip(*((*p, *j) for p, j in zip(parts, judged, strict=True)), strict=True) if parts else [()] * 4))],
                ["id", "host", "path", "rule", "verdict"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    return on_workers(df).select(id_col, url_col).mapInArrow(run, f"id {kind}, host string, path string, rule string, verdict string").withColumnRenamed("id", id_col)


def filter_urls_joined(df: DataFrame, rules: DataFrame, path_lengths: Sequence[int], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The same verdicts from a rule *table* (verdict, host, path) of any size.

    Each URL's candidate keys are joined with the rules on digest and key; hot
    keys are left to adaptive skew handling, and nothing is broadcast by force.
    Rows of ``df`` are told apart by an added number, so repeated ids stay apart.
    """
    lengths = sorted(set(path_lengths))
    at = F.instr(url_col, "://")
    rest = F.when(at > 0, F.substring(F.col(url_col), at + 3, F.length(url_col)))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    pages = df.select(
        F.col(id_col),
        F.translate(F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)", 1), F.lit("")), upper, lower).alias("host"),
        F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit("")).alias("path"),
        F.monotonically_increasing_id().alias("_row"),
    )
    labels = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    cuts = F.filter(F.array(*(F.lit(int(n)) for n in lengths)), lambda n: n <= F.length("path"))
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(cuts, lambda n: F.struct(F.concat(h, F.substring(F.col("path"), F.lit(1), n)).alias("key"), F.length(h).alias("host_len")))))
    probes = pages.where("host != ''").select("_row", F.inline(keys)).withColumn("digest", F.xxhash64("key"))
    stated = rules.select(F.concat("host", "path").alias("key"), F.xxhash64(F.concat("host", "path")).alias("digest"), "verdict")
    best = probes.join(stated, ["digest", "key"]).groupBy("_row").agg(F.max(F.struct(F.length("key"), "host_len", "key", "verdict")).alias("b"))
    return pages.join(best, "_row", "left").select(id_col, "host", "path", F.col("b.key").alias("rule"), F.coalesce("b.verdict", F.lit("allow")).alias("verdict"))
