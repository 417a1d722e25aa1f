"""Benchmark decontamination: a prefix-filtered set join, in DataFrame functions only.

A window is ``WINDOW`` consecutive words of an item (an item of fewer words, but not
none, is one window).  A document contains a window where the same words stand in a
row.  Each window is a set of shingles of ``SHINGLE`` words; the shingles are ordered by
how rare they are among all windows.  Containment must be whole, so the necessary
prefix of a window is its one rarest shingle: the index holds that shingle, its place in
the window, and the window's words.  Documents are scanned once: the shingle at every
position probes the index, the positional and length bounds place the window in the
document (it must start and end inside), and the words there are compared one by one.

The documents are never shuffled: only verified windows leave the scan, as numbers.
The index of the benchmark is broadcast in slices of at most ``SLICE_ROWS`` rows and
``SLICE_BYTES`` bytes of words (checked by aggregation before); a benchmark beyond that is joined slice by slice, so
any size is exact and no broadcast is larger.  Equal windows are one index row, however
many items share them.  Documents are keyed by a digest of their text, so copies of a
text share one result and a hot text needs one row per task.

Defined cases: a NULL text has no words; a document without words is never
contaminated; items without words have no window; repeated items and documents count
as they stand; NULL item ids are left out of the digest and of ``n_items``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebars.llm.settle import spread_join

WINDOW = 13
SHINGLE = 3
SLICE_ROWS = 100_000
SLICE_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text, lower-cased (A-Z only)."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SPLIT)
    # only the first and the last part can be empty
    return F.filter(parts, lambda w: w != "")


def _windows(benchmark: DataFrame, text: str, item: str) -> DataFrame:
    """``(window, item_id)``: the words of each window of each item."""
    w = benchmark.select(F.col(item).cast("string").alias("item_id"), words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    start = F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - WINDOW, F.lit(0))))
    return w.select("item_id", "w", start.alias("s")).select("item_id", F.slice("w", F.col("s") + 1, WINDOW).alias("window"))


def _index(windows: DataFrame) -> DataFrame:
    """One row per window: its rarest shingle and that shingle's place."""
    distinct = windows.select("window").distinct().withColumn("window_id", F.xxhash64(F.concat_ws(" ", "window")))
    width = F.least(F.size("window"), F.lit(SHINGLE))
    each = distinct.select("window_id", "window", width.alias("width"), F.posexplode(
        F.transform(F.sequence(F.lit(1), F.size("window") - width + 1), lambda i: F.xxhash64(F.slice("window", i, width)))).alias("place", "shingle"))
    rarity = each.groupBy("width", "shingle").agg(F.count(F.lit(1)).alias("often"))
    first = F.min(F.struct("often", "shingle", "place")).alias("first")
    prefix = each.join(rarity, ["width", "shingle"]).groupBy("window").agg(first, F.first("width").alias("width"), F.first("window_id").alias("window_id"))
    return prefix.select("window_id", "window", "width", F.col("first.shingle").alias("shingle"), F.col("first.place").alias("place"))


def _probe(docs: DataFrame, index: DataFrame, width: int) -> DataFrame:
    """Verified windows ``(key, start, length, window_id)`` of one slice of the index."""
    shingle = F.transform(F.sequence(F.lit(1), F.size("w") - width + 1),
                          lambda i: F.xxhash64(*(F.get("w", i + (j - 1)) for j in range(width))))
    at = docs.filter(F.size("w") >= width).select("key", "w", F.posexplode(shingle).alias("at", "shingle"))
    start = F.col("at") - F.col("place")
    size = F.size("window")
    hits = (at.join(F.broadcast(index), "shingle")
            .filter((start >= 0) & (start + size <= F.size("w")))
            .filter(F.slice("w", F.greatest(start, F.lit(0)) + 1, size) == F.col("window")))
    return hits.select("key", start.alias("start"), size.alias("length"), "window_id")


def slices_of(index: DataFrame) -> list[DataFrame]:
    """The index in parts whose size is bounded, one width in each."""
    size = F.sum(F.octet_length(F.concat_ws(" ", "window")) + 16 * F.size("window") + 64)
    out = []
    for row in index.groupBy("width").agg(F.count(F.lit(1)).alias("n"), size.alias("bytes")).collect():
        parts = max(-(-row["n"] // SLICE_ROWS), -(-row["bytes"] // SLICE_BYTES))
        # by window, so one shingle in many windows does not fill a slice
        out += [(row["width"], index.filter((F.col("width") == row["width"]) & (F.pmod("window_id", F.lit(parts)) == i))) for i in range(parts)]
    return out


def text_key(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item: str = "item_id") -> DataFrame:
    """Per contaminated text: ``key``, ``n_hit``, ``n_items``, ``items``, ``spans``."""
    windows = _windows(benchmark, item_text, item).checkpoint()
    index = _index(windows).drop("items").checkpoint()
    source = docs.select(text_key(text).alias("key"), words(F.col(text)).alias("w"))
    found = [_probe(source, part, width) for width, part in slices_of(index)]
    if not found:
        none = docs.sparkSession.createDataFrame([], "key binary, start int, length int, window_id long")
        found = [none]
    # copies of a text give the same rows: one of each is kept in the task already
    found = reduce(DataFrame.unionByName, found).distinct().checkpoint()
    # intervals in order; a fold counts the positions they cover
    spans = F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end"))))
    covered = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda acc, s: F.struct(
        (acc["n"] + F.greatest(s["end"] - F.greatest(s["start"], acc["end"]), F.lit(0))).alias("n"),
        F.greatest(acc["end"], s["end"]).alias("end")))["n"]
    words_hit = found.groupBy("key").agg(spans.alias("spans")).withColumn("n_hit", covered.cast("long"))
    members = windows.select(F.xxhash64(F.concat_ws(" ", "window")).alias("window_id"), "item_id").filter("item_id IS NOT NULL").distinct()
    items = (found.select("key", "window_id").distinct().join(members, "window_id").groupBy("key")
             .agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    return words_hit.join(items, "key", "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))


def judged(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` (all columns) with ``_n_words``, ``_n_hit``, ``_items`` and ``_contaminated``.
    Many copies of a text are dealt by ``doc_id``."""
    known = hits(docs, benchmark, text).select(F.col("key").alias("_key"), F.col("n_hit").alias("_n_hit"), F.col("items").alias("_items"))
    counted = docs.withColumn("_key", text_key(text)).withColumn("_n_words", F.size(words(F.col(text))).cast("long"))
    out = spread_join(counted, known, "_key", doc_id, "left").drop("_key").withColumn("_n_hit", F.coalesce("_n_hit", F.lit(0).cast("long")))
    return out.withColumn("_contaminated", (F.col("_n_hit") > 0) & (20 * F.col("_n_hit") >= F.col("_n_words")))


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    items = F.coalesce("_items", F.array().cast("array<string>"))
    return judged(docs, benchmark).select(
        "doc_id", F.col("_n_words").alias("n_words"), F.col("_n_hit").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), F.col("_contaminated").alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pipeline stage: contaminated documents go."""
    return judged(docs, benchmark).filter(~F.col("_contaminated")).select(*(F.col(f"`{c}`") for c in docs.columns))


SQL = r"""
WITH tok AS (
  SELECT 'd' AS kind, row_number() OVER () AS rid, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), item_id, text FROM benchmark),
w AS (
  SELECT kind, rid, id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM tok),
win AS (
  SELECT DISTINCT id AS item_id, len(w) >= 13 AS long, least(len(w), 13) AS n, array_to_string(w[s + 1 : s + 13], ' ') AS words
  FROM w, unnest(range(0, greatest(len(w) - 13, 0) + 1)) u(s) WHERE kind = 'b' AND len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (
  SELECT w.rid, s, z.n, array_to_string(w.w[s + 1 : s + z.n], ' ') AS words
  FROM w, sizes z, unnest(range(0, len(w.w) - z.n + 1)) u(s) WHERE kind = 'd'),
hit AS (SELECT o.rid, o.s, o.n, x.item_id FROM occ o JOIN win x USING (words, n)),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM hit, unnest(range(s, s + n)) u(p) GROUP BY rid),
its AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT w.id AS doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w.w) AS contaminated
FROM w LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid) WHERE kind = 'd'
"""
