"""URL filters: a sorted digest array of rules, probed by binary search.

A rule is a host and a path prefix; it fits its host and every subdomain where the
url's path starts with its path, and the longest fitting rule decides.  The index
holds one 64-bit xxhash key for each rule string (host + path), sorted, beside the
stored strings.  It is written to files that Spark ships to every executor
(``addFile``; an executor that joins later fetches them again) and memory-mapped
there, so all Python workers of a machine share its pages.  For a batch of urls all
pairs of host suffix and path prefix whose lengths occur among the rules are hashed
and probed at once with ``searchsorted``; a hit counts only if the full string is
equal, so a colliding digest is never taken for a rule.

Size: the index is ``len(rules)`` strings, built on the driver and bounded by
``MAX_RULE_BYTES``; urls never pass through the driver.

Defined cases: a NULL url, or one without ``://``, has empty host and path and fits
no rule.  Where no rule fits, the verdict is ``allow``: an exact list says nothing
against it.  Equal rules count once; of equal-length fitting rules the one with the
longer host decides; of two equal rules with both verdicts ``block`` decides.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from pricebars.llm.words import extended

MAX_RULE_BYTES = 1 << 30
DEFAULT_VERDICT = "allow"

# The rules of the registered query (fixed values): (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

_URL = regex.compile(r"://(?P<host>[^/?#]*)(?P<path>[^?#]*)", regex.DOTALL)
_UPPER = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url; both empty where there is no ``://``."""
    found = _URL.search(url) if url else None
    return (found["host"].translate(_UPPER), found["path"]) if found else ("", "")


class DigestIndex:
    """The memory-mapped arrays of one index, as an executor opens them."""

    def __init__(self, stem: str):
        self.keys = np.load(f"{stem}.keys.npy", mmap_mode="r")
        self.offsets = np.load(f"{stem}.offsets.npy", mmap_mode="r")
        self.text = np.load(f"{stem}.text.npy", mmap_mode="r")
        self.meta = np.load(f"{stem}.meta.npy", mmap_mode="r")  # length of the host, verdict
        hosts = self.meta[:, 0]
        self.path_lengths = sorted({int(x) for x in np.unique(self.path_chars())})
        self.most_labels = int(self.meta[:, 2].max(initial=0)) if len(hosts) else 0

    def path_chars(self) -> np.ndarray:
        return self.meta[:, 3]

    def string(self, k: int) -> bytes:
        return self.text[self.offsets[k]:self.offsets[k + 1]].tobytes()

    def probe(self, strings: list[bytes]) -> np.ndarray:
        """Row of each string among the rules, or -1."""
        keys = np.fromiter(map(xxhash.xxh64_intdigest, strings), np.uint64, len(strings))
        row = np.searchsorted(self.keys, keys)
        found = np.full(len(strings), -1)
        for i in np.flatnonzero(self.keys[np.minimum(row, len(self.keys) - 1)] == keys) if len(self.keys) else ():
            k = int(row[i])
            while k < len(self.keys) and self.keys[k] == keys[i]:  # equal digests lie side by side
                if self.string(k) == strings[i]:
                    found[i] = k
                    break
                k += 1
        return found


def rule_bytes(host: str, path: str) -> bytes:
    """What is hashed and compared: the host, a byte no text has, and the path."""
    return host.encode() + b"\xff" + path.encode()


def build_index(rules: Iterable[tuple[str, str, str]], folder: str) -> str:
    """Write the arrays of ``rules`` to ``folder``; returns the files' common stem."""
    held: dict[bytes, tuple[int, int, int, int]] = {}
    for verdict, host, path in rules:
        host = host.translate(_UPPER)
        key, block = rule_bytes(host, path), int(verdict == "block")
        held[key] = (len(host), max(block, held[key][1]) if key in held else block, host.count(".") + 1, len(path))
    if sum(map(len, held)) > MAX_RULE_BYTES:
        raise ValueError(f"the rules hold more than {MAX_RULE_BYTES} bytes")
    order = sorted(held, key=lambda s: (xxhash.xxh64_intdigest(s), s))
    arrays = {
        "keys": np.array([xxhash.xxh64_intdigest(s) for s in order], np.uint64),
        "offsets": np.cumsum([0, *map(len, order)], dtype=np.int64),
        "text": np.frombuffer(b"".join(order), np.uint8),
        "meta": np.array([held[s] for s in order], np.int64).reshape(-1, 4),
    }
    stem = os.path.join(folder, "rules-" + hashlib.sha256(b"\n".join(order) + arrays["meta"].tobytes()).hexdigest()[:16])
    for name, array in arrays.items():
        np.save(f"{stem}.{name}.npy", array)
    return stem


PARTS = ("keys", "offsets", "text", "meta")
_OPEN: dict[str, DigestIndex] = {}


def share_index(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> str:
    """Build the index and let Spark ship it; returns the name to open it by.  The
    files lie in Spark's own folder for shipped files and end with the application."""
    folder = os.path.join(SparkFiles.getRootDirectory(), "digest-index")
    os.makedirs(folder, exist_ok=True)
    stem = build_index(rules, folder)
    for part in PARTS:
        spark.sparkContext.addFile(f"{stem}.{part}.npy")
    return os.path.basename(stem)


def opened(name: str) -> DigestIndex:
    if name not in _OPEN:
        _OPEN[name] = DigestIndex(SparkFiles.get(name))
    return _OPEN[name]


def judge(index: DigestIndex, urls: list[str | None]) -> tuple[list[str], list[str], list[str | None], list[str]]:
    """Host, path, deciding rule and verdict of each url."""
    parts = [split_url(u) for u in urls]
    strings, owner, weight = [], [], []
    for i, (host, path) in enumerate(parts):
        labels = host.split(".")
        for n in range(min(len(labels), index.most_labels)):
            suffix = ".".join(labels[len(labels) - 1 - n:])
            for length in index.path_lengths:
                if length <= len(path):
                    strings.append(rule_bytes(suffix, path[:length]))
                    owner.append(i)
                    weight.append((len(suffix) + length, len(suffix)))
    row = index.probe(strings)
    best: dict[int, tuple[tuple[int, int], int, bytes]] = {}
    for j in np.flatnonzero(row >= 0):
        if owner[j] not in best or weight[j] > best[owner[j]][0]:
            best[owner[j]] = (weight[j], int(row[j]), strings[j])
    rule: list[str | None] = [None] * len(urls)
    verdict = [DEFAULT_VERDICT] * len(urls)
    for i, (_, k, text) in best.items():
        rule[i] = text.replace(b"\xff", b"").decode()
        verdict[i] = "block" if index.meta[k, 1] else "allow"
    return [h for h, _ in parts], [p for _, p in parts], rule, verdict


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` of each url.  The
    four names replace columns of the same names."""
    name = share_index(pages.sparkSession, rules)
    pages = pages.drop("host", "path", "rule", "verdict")
    kept = pages.columns
    out = extended(pages.schema, host="string", path="string", rule="string", verdict="string")

    def run(batches):
        index = opened(name)
        for batch in batches:
            told = judge(index, batch.column(kept.index(url)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x, pa.string()) for x in told)], names=out.names)

    return pages.mapInArrow(run, out)


def op4_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages, RULES).drop("url")


SQL = """
WITH p AS (
  SELECT page_id, coalesce(position('://' IN url), 0) AS mark, url FROM pages),
q AS (
  SELECT page_id,
         CASE WHEN mark > 0 THEN translate(regexp_extract(substr(url, mark + 3), '^[^/?#]*'),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN mark > 0 THEN regexp_extract(substr(url, mark + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM p),
rules(verdict, rhost, rpath) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (
  SELECT q.page_id, q.host, q.path, r.rhost || r.rpath AS rule, r.verdict
  FROM q LEFT JOIN rules r
    ON (q.host = r.rhost OR ends_with(q.host, '.' || r.rhost)) AND starts_with(q.path, r.rpath)),
best AS (
  SELECT page_id, host, path, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM fit GROUP BY page_id, host, path)
SELECT q.page_id, q.host, q.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM q LEFT JOIN best b ON q.page_id = b.page_id AND q.host = b.host AND q.path = b.path
"""
