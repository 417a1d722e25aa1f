"""Sharding by a k-d tree over metadata: weighted medians until leaves are small enough.

A node of the tree holds rows; it is split along its widest dimension (the standard
deviation by weight against that of all rows) at the weighted median, so that both
sides get their share of the bytes, until the leaves reach the target bytes or the
asked number of shards.  Medians are found on the cluster: each level runs a few small
aggregations that count the weight of all its nodes in ``BINS`` bins, take the bin that
holds the median and cut that bin again, until what is left is ``TOLERANCE`` of the
node.  Only bins come to the driver (nodes x ``BINS`` rows).

Rows are ordered by ``(dimension, hash of the group, hash of the row)``.  So rows of one
group (equal texts, with equal dimensions) lie together and share a shard: a cut that falls
into a group moves to its nearer end.  Only a group of over ``GROUP_SHARE`` of a shard's bytes is
split by row, so one hot text can hold a third of all rows without unbalancing the shards.

Slots number the rows of a shard without a gap: rows are dealt by hash into parts, parts
are counted, and a row's slot is its place in its part after all rows of the parts before.

Defined cases: a NULL text has size 1, crc32 0 and dimension 0; rows that are equal in
all columns may change places, which no result shows; an empty table gives no rows; NULL
ids are ordinary values.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 2048
TOLERANCE = 0.003
GROUP_SHARE = 0.01
PART_ROWS = 4096


@dataclass
class Cut:
    """Rows below ``(value, group, row)`` of dimension ``dim`` go left."""

    dim: int
    key: tuple[int, int, int]


def _below(cut: Cut) -> Column:
    """The lexicographic comparison with a cut."""
    value, group, row = F.col(f"_d{cut.dim}"), F.col("_group"), F.col("_row")
    v, g, r = (F.lit(k) for k in cut.key)
    return (value < v) | (value == v) & ((group < g) | (group == g) & (row < r))


def _node(cuts: dict[int, Cut]) -> Column:
    """The leaf of a row: nodes are numbered like a heap, 1 is the root."""

    def go(k: int) -> Column:
        return F.when(_below(cuts[k]), go(2 * k)).otherwise(go(2 * k + 1)) if k in cuts else F.lit(k)

    return go(1)


def _placed(batch: pa.RecordBatch, cuts: dict[int, Cut], dims: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Leaf of each row of a batch, and its columns: dimensions, group, row, weight."""
    columns = [c.to_numpy() for c in batch.columns]
    node = np.ones(batch.num_rows, np.int64)
    for k in sorted(cuts):
        value, group, row = columns[cuts[k].dim], columns[dims], columns[dims + 1]
        v, g, r = cuts[k].key
        left = (value < v) | (value == v) & ((group < g) | (group == g) & (row < r))
        here = node == k
        node[here] = 2 * k + ~left[here]
    return node, columns


def _spread(points: DataFrame, cuts: dict[int, Cut], dims: int) -> dict[int, dict]:
    """Weight and, of each dimension, extent and deviation, by node."""
    names = ["node", "weight", *(f"{x}{d}" for d in range(dims) for x in ("min", "max", "s", "q"))]
    kinds = ["long", "long", *(t for _ in range(dims) for t in ("long", "long", "double", "double"))]

    def count(batches):
        for batch in batches:
            node, columns = _placed(batch, cuts, dims)
            rows = []
            for k in np.unique(node):
                at = node == k
                w = columns[-1][at]
                row = [int(k), int(w.sum())]
                for d in range(dims):
                    x = columns[d][at]
                    row += [int(x.min()), int(x.max()), float((w * x.astype(float)).sum()), float((w * x.astype(float) ** 2).sum())]
                rows.append(row)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)

    aggs = [(F.min if n.startswith("min") else F.max if n.startswith("max") else F.sum)(n).alias(n) for n in names[1:]]
    out = {}
    for r in points.mapInArrow(count, ", ".join(map(" ".join, zip(names, kinds)))).groupBy("node").agg(*aggs).collect():
        total = float(r["weight"])
        var = [max(0.0, r[f"q{d}"] / total - (r[f"s{d}"] / total) ** 2) for d in range(dims)]
        out[r["node"]] = {"weight": int(r["weight"]), "var": var, "ends": [(r[f"min{d}"], r[f"max{d}"]) for d in range(dims)]}
    return out


def _binned(points: DataFrame, cuts: dict[int, Cut], dims: int, search: dict[int, dict]) -> dict[int, dict[int, int]]:
    """Weight by bin of the range that each node's search has come to."""

    def count(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            node, columns = _placed(batch, cuts, dims)
            for k, s in search.items():
                inside = node == k
                parts = [columns[s["dim"]], columns[dims], columns[dims + 1]]
                for part, value in zip(parts, s["fixed"]):
                    inside &= part == value
                x = parts[len(s["fixed"])]
                lo, hi = s["range"]
                inside &= (x >= lo) & (x <= hi)
                # offsets of a range of 64 bits fit where the subtraction wraps
                at = (x[inside].astype(np.uint64) - np.uint64(lo % (1 << 64))) // np.uint64(s["width"])
                held[k] = held.get(k, 0) + np.bincount(at.astype(np.int64), weights=columns[-1][inside], minlength=BINS)
        for k, w in held.items():
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k)), pa.array(at), pa.array(w[at].astype(np.int64))], names=["node", "bin", "w"])

    bins: dict[int, dict[int, int]] = {}
    for r in points.mapInArrow(count, "node long, bin long, w long").groupBy("node", "bin").agg(F.sum("w").alias("w")).collect():
        bins.setdefault(r["node"], {})[r["bin"]] = r["w"]
    return bins


def _medians(points: DataFrame, cuts: dict[int, Cut], dims: int, wanted: dict[int, dict]) -> dict[int, Cut]:
    """The cut of each wanted node.  A search holds the prefix of the key that is
    fixed so far, the range of the key's next part, and the weight below the range."""
    least, most = -(1 << 63), (1 << 63) - 1
    search = {k: {"fixed": [], "range": w["ends"][w["dim"]], "below": 0, "dim": w["dim"], "weight": w["weight"], "goal": w["goal"],
                  "whole": GROUP_SHARE * w["weight"] / w["shards"]} for k, w in wanted.items()}
    done: dict[int, Cut] = {}
    while search:  # each round takes 11 bits off a key of three 64-bit parts
        for s in search.values():
            s["width"] = max(1, -(-(s["range"][1] - s["range"][0] + 1) // BINS))
        bins = _binned(points, cuts, dims, search)
        for k in list(search):
            s = search[k]
            below, (lo, hi) = s["below"], s["range"]
            b = w = 0
            for b, w in sorted(bins.get(k, {0: 0}).items()):
                if below + w >= s["goal"]:
                    break
                below += w
            first, last = lo + b * s["width"], min(hi, lo + (b + 1) * s["width"] - 1)
            if w <= TOLERANCE * s["weight"] or first == last and len(s["fixed"]) == 2:
                # cut at the nearer end of the bin
                key = [*s["fixed"], first if s["goal"] - below <= below + w - s["goal"] else last + 1]
                done[k] = Cut(s["dim"], tuple(min(x, most) for x in key + [least] * (3 - len(key))))
                del search[k]
            elif first == last and len(s["fixed"]) == 1 and w <= s["whole"]:  # one group
                after = s["goal"] - below > below + w - s["goal"]
                done[k] = Cut(s["dim"], (s["fixed"][0], first, most if after else least))
                del search[k]
            elif first == last:
                s |= {"fixed": [*s["fixed"], first], "range": (least, most), "below": below}
            else:
                s |= {"range": (first, last), "below": below}
    return done


def grow_tree(points: DataFrame, dims: int, shards: int) -> tuple[dict[int, Cut], dict[int, int]]:
    """Cuts of the tree, and the shard of each leaf.  A node of m shards gives the
    half of them, and that share of its weight, to each side."""
    cuts: dict[int, Cut] = {}
    share = {1: shards}
    scale: list[float] | None = None
    while any(n > 1 for n in share.values()):
        spread = _spread(points, cuts, dims)
        scale = scale or [max(v, 1e-12) for v in (spread[1]["var"] if 1 in spread else [1.0] * dims)]
        wanted = {}
        for k, n in list(share.items()):
            if n > 1:
                at = spread.get(k, {"weight": 0, "var": [0.0] * dims, "ends": [(0, 0)] * dims})
                wide = max(range(dims), key=lambda d: (at["var"][d] / scale[d], -d))
                wanted[k] = at | {"dim": wide, "goal": at["weight"] * (n // 2) / n, "shards": n}
        found = _medians(points, cuts, dims, wanted)
        for k in wanted:
            cuts[k] = found[k]
            n = share.pop(k)
            share[2 * k], share[2 * k + 1] = n // 2, n - n // 2
    return cuts, {leaf: i for i, leaf in enumerate(sorted(share, key=lambda k: bin(k)[3:]))}


def kd_shards(rows: DataFrame, dims: list[Column], weight: Column, group: Column, row: Column,
              shards: int | None = None, target_bytes: int | None = None, shard_col: str = "shard") -> DataFrame:
    """``rows`` with the shard of each.  ``dims`` are whole numbers, ``group`` and
    ``row`` 64-bit hashes.  Give the number of shards, or the bytes that a shard should
    reach (the number is then a power of two)."""
    keys = {f"_d{i}": F.coalesce(d.cast("long"), F.lit(0)) for i, d in enumerate(dims)}
    keyed = rows.withColumns(keys | {"_group": group, "_row": row, "_weight": weight.cast("long")})
    points = keyed.select(*keys, "_group", "_row", "_weight").checkpoint()
    if shards is None:
        total = points.agg(F.sum("_weight")).first()[0] or 0
        shards = 1
        while total / shards > target_bytes:
            shards *= 2
    cuts, leaves = grow_tree(points, len(dims), shards)
    shard = F.element_at(F.create_map(*(F.lit(x) for k, i in leaves.items() for x in (k, i))), _node(cuts))
    return keyed.withColumn(shard_col, shard.cast("int")).drop(*keys, "_group", "_row", "_weight")


def with_slots(rows: DataFrame, shard: str, order: list[str], deal: Column, parts: int, slot: str = "slot") -> DataFrame:
    """``rows`` numbered from 0 in each shard, without a gap.  Each shard is cut by
    ``deal`` into ``parts``, so no task numbers a whole shard."""
    dealt = rows.withColumn("_part", F.pmod(deal, F.lit(parts)).cast("int"))
    counts = dealt.groupBy(shard, "_part").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy(shard).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
    place = Window.partitionBy(shard, "_part").orderBy(*order)
    numbered = dealt.withColumn("_place", F.row_number().over(place))
    return numbered.join(starts, [shard, "_part"]).withColumn(slot, F.col("_start") + F.col("_place") - 1).drop("_part", "_place", "_start")


SHARDS = 16


def op5_kdtree_shards(spark, sf_dir: str) -> DataFrame:
    """Dimensions are metadata of the text itself (bytes, bytes beyond ASCII, lines), so
    copies of a text have the same place in the tree."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       F.char_length(text).alias("_chars"), F.xxhash64(text).alias("_text"),
                       (F.octet_length(text) - F.octet_length(F.translate(text, "\n", ""))).alias("_lines"))
    rows = rows.checkpoint()  # figures only, no text: read by every round
    sharded = kd_shards(rows, [F.col("size"), F.col("size") - F.col("_chars"), F.col("_lines")], F.col("size"),
                        F.col("_text"), F.xxhash64("doc_id", "text_crc32"), shards=SHARDS)
    parts = max(64, -(-rows.count() // (SHARDS * PART_ROWS)))
    slots = with_slots(sharded, "shard", ["doc_id", "text_crc32", "size"], F.xxhash64("doc_id", "text_crc32"), parts)
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                        F.lit(None).cast("int").alias("grown_shard"))
