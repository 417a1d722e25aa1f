"""Exact removal of repeated passages with suffix arrays built by induced sorting.

A window is ``WINDOW`` bytes of a text (UTF-8); a byte goes if a window that covers it also
starts anywhere else, in the same text or another.  Suffixes are dealt to shards by content,
so that windows that are equal meet: the anchor of a window is its smallest ``GRAM``-byte
hash (the leftmost of equals), which equal windows have at the same place.  The windows of
one anchor stand in a row and make a region.  Anchors whose hash occurs once in the whole
corpus cannot hold a repeated window; regions that are equal are one region that repeats
as a whole.  The different regions of one hash go to one shard, whose suffix array is built
by induced sorting: suffixes are classified, the leftmost-smaller substrings are sorted and
named, their order comes from the same procedure on the names, and it induces the order
of all suffixes, one bucket at a time.  Permuted common prefixes then tell which neighbours
share a window.  While an alphabet of names is above ``BUCKETS``, names are sorted by doubling ranks.

Texts never leave their row but for those whose bytes a shard must see, and for the last join
with the spans to cut.  Regions of one hash above ``HOT_BYTES`` in all do not make a shard:
their windows are counted by a 128-bit digest each, which no key can make hot.  Texts, regions
and windows that are equal are told by digests of 128 bits (regions: two of 64).

Defined cases: a NULL text is empty; texts below ``WINDOW`` bytes keep all bytes; every copy of a
text that occurs twice loses all bytes (if it has a window); ids play no part; repeated rows are
copies; an empty table gives no rows; texts of any length are scanned in overlapping
segments.  What is left may end within a character, so it is given as bytes.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebars.llm.settle import BROADCAST_ROWS, beside, rows_of, settled, spread_join
from pricebars.llm.words import mix, utf8
from pricebars.session import bounded_batches

WINDOW = 200
GRAM = 32
SEGMENT = 1 << 20
SHARD_BYTES = 1 << 20
HOT_BYTES = 8 << 20
BUCKETS = 4096
HALF = (WINDOW - GRAM) // 2
PLACE = np.uint64((1 << 22) - 1)
SPANS = "array<struct<first:int,last:int>>"


# ------------------------------------------------------------ suffix arrays


def is_s_type(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last is larger than the empty one."""
    n = len(t)
    rises, same = np.zeros(n, bool), np.zeros(n, bool)
    rises[:-1], same[:-1] = t[1:] > t[:-1], t[1:] == t[:-1]
    decided = np.where(same, n - 1, np.arange(n))
    return rises[np.minimum.accumulate(decided[::-1])[::-1]]


def _grouped(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by char; of the ordered chars: places within a run, runs, their lengths."""
    order = np.argsort(chars, kind="stable")
    c = chars[order]
    heads = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
    sizes = np.diff(np.append(heads, len(c)))
    return order, np.arange(len(c)) - np.repeat(heads, sizes), c[heads], sizes


def induce(t: np.ndarray, s: np.ndarray, edge: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The suffix array that an order of the leftmost S-type suffixes induces: larger suffixes
    from left to right, then smaller ones from right to left, a bucket at a time."""
    n, buckets = len(t), len(edge) - 1
    sa = np.zeros(n, np.int32)
    head, tail = edge[:-1].copy(), edge[1:].copy()
    order, within, chars, sizes = _grouped(t[lms]) if len(lms) else (np.zeros(0, np.int64),) * 4
    count = np.zeros(buckets, np.int64)
    count[chars] = sizes
    lms = lms[order]
    sa[(tail - count)[t[lms]] + within] = lms
    used = np.flatnonzero(edge[1:] > edge[:-1])

    def left(p: np.ndarray) -> None:
        if len(p):
            order, within, chars, sizes = _grouped(t[p])
            p = p[order]
            sa[head[t[p]] + within] = p
            head[chars] += sizes

    def right(p: np.ndarray) -> None:
        if len(p):
            order, within, chars, sizes = _grouped(t[p])
            p = p[order]
            sa[tail[t[p]] - 1 - within] = p
            tail[chars] -= sizes

    left(np.array([n - 1], np.int32))
    for c in used:
        done = edge[c]
        while done < head[c]:
            j = sa[done:head[c]]
            done = head[c]
            p = j[j > 0] - 1
            left(p[~s[p]])
        left(sa[edge[c + 1] - count[c]:edge[c + 1]] - 1)
    for c in used[::-1]:
        done = edge[c + 1]
        while done > tail[c]:
            j = sa[tail[c]:done][::-1]
            done = tail[c]
            p = j[j > 0] - 1
            right(p[s[p]])
        j = sa[edge[c]:head[c]][::-1]
        p = j[j > 0] - 1
        right(p[s[p]])
    return sa


def doubled(t: np.ndarray) -> np.ndarray:
    """A suffix array by doubling ranks, for alphabets of very many names."""
    n = len(t)
    rank, step = t.astype(np.int64), 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-step or None] = rank[step:] + 1 if step < n else 0
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        rank = np.zeros(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[False], key[order][1:] != key[order][:-1]]))
        if rank[order[-1]] == n - 1 or step >= n:
            return order.astype(np.int32)
        step *= 2


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``t`` (small whole numbers from 0) in their order."""
    n = len(t)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    top = int(t.max()) + 1
    if top > BUCKETS:
        return doubled(t)
    t = t.astype(np.uint16)
    s = is_s_type(t)
    edge = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=top))])
    leftmost = np.zeros(n, bool)
    leftmost[1:] = s[1:] & ~s[:-1]
    lms = np.flatnonzero(leftmost).astype(np.int32)
    if len(lms) < 2:
        return induce(t, s, edge, lms)
    first = induce(t, s, edge, lms)
    first = first[leftmost[first]]
    # names of the substrings from one leftmost S-type place to the next
    place = np.zeros(n, np.int64)
    place[lms] = np.arange(len(lms))
    length = np.append(np.diff(lms) + 1, 0)
    a, b = first[:-1].astype(np.int64), first[1:].astype(np.int64)
    size = length[place[a]]
    differs = (size != length[place[b]]) | (size == 0)
    todo, k = np.flatnonzero(~differs), 0
    while len(todo):
        off = t[a[todo] + k] != t[b[todo] + k]
        differs[todo[off]] = True
        k += 1
        todo = todo[~off & (size[todo] > k)]
    names = np.concatenate([[0], np.cumsum(differs)])
    if names[-1] + 1 < len(lms):
        reduced = np.zeros(len(lms), np.int64)
        reduced[place[first]] = names
        first = lms[suffix_array(reduced)]
    return induce(t, s, edge, first)


def common_prefixes(data: np.ndarray, sa: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each place of ``data`` the bytes that its suffix shares with the one before it in
    ``sa``, at most up to ``end`` of either.  Permuted: a place whose predecessor is preceded by
    the same byte has one less than the place before it, the others are compared."""
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    i = np.arange(n)
    inner = (i > 0) & (before > 0) & (end > i)
    follows = np.zeros(n, bool)
    j = np.flatnonzero(inner)
    follows[j] = (data[j - 1] == data[before[j] - 1]) & (end[j - 1] == end[j]) & (end[before[j] - 1] == end[before[j]])
    alone = np.flatnonzero(~follows)
    other = before[alone]
    limit = np.where(other >= 0, np.minimum(end[alone] - alone, end[other] - other), 0)
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    word = np.ndarray((n + 8,), "<u8", buffer=padded.data, strides=(1,))
    shared = limit.copy()
    todo, k = np.flatnonzero(limit > 0), 0
    while len(todo):
        x = word[alone[todo] + k] ^ word[other[todo] + k]
        off = x != 0
        low = x[off] & (~x[off] + np.uint64(1))
        at = todo[off]
        shared[at] = np.minimum(limit[at], k + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3))
        k += 8
        todo = todo[~off & (limit[todo] > k)]
    at = np.maximum.accumulate(np.where(follows, 0, i))
    out = np.zeros(n, np.int64)
    out[alone] = shared
    return np.where(follows, out[at] - (i - at), out)


def repeated_windows(regions: list[bytes], window: int = WINDOW) -> list[np.ndarray]:
    """For each region whether the window at each of its starts occurs elsewhere in ``regions``."""
    sizes = np.array([len(r) for r in regions], np.int64)
    if not len(sizes):
        return []
    data = np.frombuffer(b"\0".join(regions) + b"\0", np.uint8)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    ends = begins + sizes
    end = np.repeat(ends, sizes + 1)
    t = data.astype(np.int32) + 1
    t[ends] = 0
    sa = suffix_array(t)
    shared = common_prefixes(data, sa, end)[sa]
    group = np.cumsum(shared < window)
    active = (end[sa] - sa) >= window
    counts = np.bincount(group[active], minlength=int(group[-1]) + 1 if len(group) else 1)
    repeats = np.zeros(len(data), bool)
    repeats[sa] = active & (counts[group] > 1)
    return [repeats[b:b + max(n - window + 1, 0)] for b, n in zip(begins, sizes)]


def spans_of(flags: np.ndarray) -> list[dict]:
    """Runs of true flags, as first and last place."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edge[::2], edge[1::2])]


# ------------------------------------------------------------ anchors


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(first, last, key, pin)``: the runs of window starts of one text that share an anchor, its
    hash, and how far it is from the first start."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    word = np.ndarray((n + 1,), "<u8", buffer=padded.data, strides=(1,))
    grams = n - GRAM + 1
    h = np.zeros(grams, np.uint64)
    for k, odd in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)):
        h += mix(word[8 * k:8 * k + grams] * np.uint64(odd) + np.uint64(k + 1))
    h = mix(h)
    wide = WINDOW - GRAM + 1
    size = -(-grams // wide) * wide
    v = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    v[:grams] = (h & ~PLACE) | np.arange(grams, dtype=np.uint64)
    v = v.reshape(-1, wide)
    ahead = np.minimum.accumulate(v, axis=1).reshape(-1)
    behind = np.minimum.accumulate(v[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    starts = n - WINDOW + 1
    at = (np.minimum(behind[:starts], ahead[wide - 1:wide - 1 + starts]) & PLACE).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.append(first[1:], starts) - 1
    return first, last, h[at[first]], at[first] - first


def _anchor_rows(batches):
    seen: set[bytes] = set()
    for batch in batches:
        ids, (raw, offsets) = batch.column(0).to_pylist(), utf8(batch.column(1))
        out = []
        for row, tid in enumerate(ids):
            data = raw[offsets[row]:offsets[row + 1]]
            if tid in seen or len(data) < WINDOW:  # copies in one task
                continue
            if len(seen) < 100_000:
                seen.add(tid)
            for begin in range(0, len(data) - WINDOW + 1, SEGMENT):
                part = np.ascontiguousarray(data[begin:begin + SEGMENT + WINDOW - 1])
                first, last, key, pin = anchors(part)
                view = memoryview(part)
                ends = last + WINDOW
                region = np.array([xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(first.tolist(), ends.tolist())], np.uint64)
                out.append((tid, first + begin, ends - first, pin, key, region))
            if sum(len(o[1]) for o in out) > 50_000 or row == len(ids) - 1:
                yield _packed(out)
                out = []
        if out:
            yield _packed(out)


def _packed(out) -> pa.RecordBatch:
    count = [len(o[1]) for o in out]
    cat = lambda k, kind: pa.array(np.concatenate([o[k] for o in out]).astype(kind) if out else np.zeros(0, kind))
    tid = pa.array([o[0] for o in out], pa.binary()).take(pa.array(np.repeat(np.arange(len(out)), count)))
    signed = lambda k: pa.array(np.concatenate([o[k] for o in out]).view(np.int64) if out else np.zeros(0, np.int64))
    return pa.RecordBatch.from_arrays([tid, cat(1, np.int64), cat(2, np.int32), cat(3, np.int32), signed(4), signed(5)],
                                      names=["tid", "at", "size", "pin", "key", "region"])


ANCHORS = "tid binary, at long, size int, pin int, key long, region long"


# ------------------------------------------------------------ the operator


def _region_bytes(batches):
    """Bytes of the regions that are listed beside each text."""
    for batch in batches:
        texts, lists = batch.column(0), batch.column(1).to_pylist()
        out, size = [], 0
        for row, places in enumerate(lists):
            raw = memoryview(texts[row].as_buffer())
            for p in places:
                out.append((p["key"], p["region"], p["often"], p["pin"], bytes(raw[p["at"]:p["at"] + p["size"]])))
                size += p["size"]
                if size > SHARD_BYTES:
                    yield _rows(out)
                    out, size = [], 0
        if out:
            yield _rows(out)


def _rows(out) -> pa.RecordBatch:
    key, region, often, pin, data = zip(*out)
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(region, pa.int64()), pa.array(often, pa.bool_()),
                                       pa.array(pin, pa.int32()), pa.array(data, pa.binary())], names=["key", "region", "often", "pin", "data"])


def may_repeat(keys: list[int], pins: list[int], regions: list[bytes]) -> np.ndarray:
    """Regions that another one of their key meets in the ``HALF`` bytes before or after the
    anchor.  A window has that much on one side, so others hold no repeated window."""
    sides = []
    for key, pin, raw in zip(keys, pins, regions):
        after = pin + GRAM
        sides.append(((key, raw[pin - HALF:pin]) if pin >= HALF else None,
                      (key, raw[after:after + HALF], True) if len(raw) >= after + HALF else None))
    met = Counter(side for pair in sides for side in pair if side)
    return np.array([any(side and met[side] > 1 for side in pair) for pair in sides], bool)


def _shard(rows: pd.DataFrame) -> pd.DataFrame:
    regions = rows["data"].to_list()
    some = may_repeat(rows["key"].to_list(), rows["pin"].to_list(), regions)
    flags = [np.zeros(len(r) - WINDOW + 1, bool) for r in regions]
    for i, found in zip(np.flatnonzero(some), repeated_windows([regions[i] for i in np.flatnonzero(some)])):
        flags[i] = found
    spans = [spans_of(f | often) for f, often in zip(flags, rows["often"])]
    out = pd.DataFrame({"key": rows["key"], "region": rows["region"], "spans": spans})
    return out[[len(s) > 0 for s in spans]]


def _window_digests(batches):
    """A digest of every window of each region."""
    for batch in batches:
        key, region, often, data = (batch.column(k).to_pylist() for k in (0, 1, 2, 4))
        for row, raw in enumerate(data):
            view, starts = memoryview(raw), len(raw) - WINDOW + 1
            digest = [xxhash.xxh3_128_digest(view[o:o + WINDOW]) for o in range(starts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest, pa.binary()), pa.array([key[row]] * starts, pa.int64()), pa.array([region[row]] * starts, pa.int64()),
                 pa.array([often[row]] * starts, pa.bool_()), pa.array(range(starts), pa.int32())],
                names=["digest", "key", "region", "often", "place"])


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    places = np.zeros(WINDOW, bool)
    places[rows["place"].to_numpy()] = True
    return pd.DataFrame({"key": rows["key"].iloc[:1], "region": rows["region"].iloc[:1], "spans": [spans_of(places)]})


def _hot_spans(regions: DataFrame) -> DataFrame:
    """Spans of the regions of hot keys, by counts of their windows' digests."""
    windows = settled(regions.select("key", "region", "often", "pin", "data").mapInArrow(
        _window_digests, "digest binary, key long, region long, often boolean, place int"))
    counts = windows.groupBy("digest").agg(F.count(F.lit(1)).alias("_n"))
    twice = spread_join(windows, counts, "digest", "place").filter("_n > 1 or often")
    return twice.groupBy("key", "region").applyInPandas(_merged, f"key long, region long, spans {SPANS}")


def _spans(texts: DataFrame) -> DataFrame:
    """``(tid, begin, end)``: bytes under repeated windows, region by region."""
    found = settled(texts.filter(F.octet_length("data") >= WINDOW).select("tid", "data").mapInArrow(_anchor_rows, ANCHORS))
    place = F.xxhash64("tid", "at")
    keys = (found.groupBy("key").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).filter("lo <> hi").select("key"))
    keys = settled(keys)
    often = (found.join(F.broadcast(keys), "key", "left_semi") if keys.count() <= BROADCAST_ROWS
             else spread_join(found, keys, "key", "region"))
    often = settled(often)
    each = ["tid", "at", "size", "pin"]
    regions = often.groupBy("key", "region").agg(
        (F.min(place) != F.max(place)).alias("often"), *[F.first(c).alias(c) for c in each])
    regions = settled(regions)
    kinds = settled(beside(regions, "key", lambda part: part.groupBy("key").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum("size").alias("weight"))))
    whole = (kinds.filter("kinds = 1 and often").select("key", "region", F.array(F.struct(
        F.lit(0).alias("first"), (F.col("size") - WINDOW).alias("last"))).alias("spans")))
    mixed = kinds.filter("kinds > 1")
    lists = mixed.groupBy("tid").agg(F.collect_list(F.struct("key", "region", "often", "at", "size", "pin")).alias("places"))
    needed = rows_of(texts.select("tid", "data"), mixed, "tid").dropDuplicates(["tid"])
    data = settled(needed.join(lists, "tid").select("data", "places").mapInArrow(
        _region_bytes, "key long, region long, often boolean, pin int, data binary"))
    weights = mixed.groupBy("key").agg(F.first("weight").alias("weight"))
    hot = weights.filter(F.col("weight") > HOT_BYTES).select("key").checkpoint()
    total = mixed.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    # a hot key has over HOT_BYTES, so there are at most total / HOT_BYTES of them
    cold = data.join(hot, "key", "left_anti").withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    verdicts = whole.unionByName(cold.groupBy("shard").applyInPandas(_shard, f"key long, region long, spans {SPANS}"))
    if not hot.isEmpty():
        verdicts = verdicts.unionByName(_hot_spans(data.join(hot, "key", "left_semi")))
    verdicts = settled(verdicts.withColumnRenamed("key", "_key"))
    return spread_join(often, verdicts, "region", "tid").filter("key = _key").select("tid", "at", F.explode("spans").alias("s")).select(
        "tid", (F.col("at") + F.col("s.first")).alias("begin"), (F.col("at") + F.col("s.last") + WINDOW).alias("end"))


def _cut(batches):
    """The bytes that are left of each text and the spans taken from it."""
    for batch in batches:
        texts, lists = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
        begins, ends = (lists.values.field(k).to_numpy(zero_copy_only=False) for k in range(2))
        edges = lists.offsets.to_numpy()
        kept, taken = [], []
        for row in range(len(texts)):
            a, b = edges[row], edges[row + 1]
            raw = texts[row].as_py()
            if a == b:
                kept.append(raw)
                taken.append([])
                continue
            order = np.argsort(begins[a:b], kind="stable")
            begin, end = begins[a:b][order], np.maximum.accumulate(ends[a:b][order])
            heads = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]]))
            runs = list(zip(begin[heads].tolist(), end[np.append(heads[1:], len(end)) - 1].tolist()))
            kept.append(b"".join(raw[x:y] for x, y in zip([0, *(e for _, e in runs)], [*(s for s, _ in runs), len(raw)])))
            taken.append([{"begin": x, "end": y} for x, y in runs])
        spans = pa.array(taken, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(kept, pa.binary()), spans],
                                         names=[*batch.schema.names[:-2], "kept", "spans"])


def without_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``kept``, the bytes of the text that no repeated window covers, and ``spans``,
    the removed runs ``(begin, end)`` of bytes.  Columns of those names give way."""
    bounded_batches(docs.sparkSession)
    out = [c for c in docs.columns if c not in ("kept", "spans")]
    data = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    plain = docs.select(*[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(out)], data.alias("data"), F.unhex(F.md5(data)).alias("tid"))
    texts = plain.select("tid", "data")
    copies = (texts.select("tid", F.octet_length("data").alias("end")).filter(F.col("end") >= WINDOW)
              .groupBy("tid").agg(F.count(F.lit(1)).alias("n"), F.max("end").cast("long").alias("end")).filter("n > 1")
              .select("tid", F.lit(0).cast("long").alias("begin"), "end"))
    places = settled(_spans(texts).unionByName(copies).groupBy("tid").agg(F.collect_list(F.struct("begin", "end")).alias("places")))
    carried = [f"_c{k}" for k in range(len(out))]
    joined = spread_join(plain, places, "tid", "tid", "left").select(*carried, "data", "places")
    schema = ", ".join([f"{c} {joined.schema[c].dataType.simpleString()}" for c in carried]
                       + ["kept binary", "spans array<struct<begin:long,end:long>>"])
    cut = joined.mapInArrow(_cut, schema)
    return cut.select(*[F.col(f"_c{k}").alias(c) for k, c in enumerate(out)], "kept", "spans")


def op13_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cut = without_repeats(docs)
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return cut.select("doc_id", n_bytes.alias("n_bytes"), (n_bytes - F.octet_length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
