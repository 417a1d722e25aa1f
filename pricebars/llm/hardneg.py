"""Hard-negative mining by inner product over STR-packed R-trees.

Vectors are turned into integers, ``floor(256 * x)``.  Rows that are equal in label and vector
are one point that keeps the few smallest ids any result can need.  Points are dealt to
shards by sort-tile-recursive packing on the cluster: slabs of equal size by the first
coordinate, tiles by the second.  Inside a shard the packing goes on over the label and the
widest coordinates, until runs of ``LEAF_ROWS`` points are leaves; every ``FAN`` neighbours
have a parent, up to one root.  A node's minimum bounding box gives the interval of the inner
products that its points can have, a sum of intervals by coordinate.

A query visits nodes best first (highest upper end).  A node is passed over if its interval
lies outside the score window, if its labels cannot fit, or if its upper end is strictly
below the kth score so far.  Each query is first searched in the shard that holds its own
point, where its neighbours are; the kth score found there bounds the search of all shards.

A packed shard is one row of a table, so passes over it are plain scans without a shuffle.
Queries meet it in broadcast slices of at most ``SLICE_ROWS`` rows, dealt by hash, a job for each slice: any
number of queries is exact and no broadcast is larger.  Anchors that are equal are one query.

Defined cases: rows whose label or vector is NULL, or whose vector holds NULL or a
non-finite component, and rows without an id take no part; shorter vectors count as padded
with zeros; rows equal in id, label and vector count once; an anchor's positives have other
ids than its own; ties go to the smaller id; an empty table gives no rows; other columns are
ignored.  Scores are exact; beyond 64 bits they stop at its ends.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricebars.llm.settle import settled, spread_join

SCALE = 256
SHARD_ROWS = 8192
LEAF_ROWS = 64
FAN = 8
SLICE_ROWS = 65_536
POSITIVES = 5
NEGATIVES = 10
LOW_PERCENT, BASE_PERCENT, HIGH_PERCENT = 30, 100, 90
EXACT = 2.0**53
ROW = 1 << 24          # a query's number is its shard times this, plus its place


# ------------------------------------------------------------ the tree of a shard


def packed_order(labels: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Sort-tile-recursive order: sort by one coordinate, cut into slabs, go on in each."""
    spread = points.max(axis=0) - points.min(axis=0) if points.size else np.zeros(0)
    columns = [labels, *(points[:, k] for k in np.argsort(-spread, kind="stable")[:3])]

    def tile(rows: np.ndarray, depth: int) -> list[np.ndarray]:
        leaves = -(-len(rows) // LEAF_ROWS)
        if leaves < 2 or depth == len(columns):
            return [rows]
        rows = rows[np.argsort(columns[depth][rows], kind="stable")]
        slabs = math.ceil(leaves ** (1 / (len(columns) - depth)))
        size = LEAF_ROWS * -(-leaves // slabs)
        return [t for at in range(0, len(rows), size) for t in tile(rows[at:at + size], depth + 1)]

    return np.concatenate(tile(np.arange(len(labels)), 0)) if len(labels) else np.zeros(0, np.int64)


class Tree:
    """Boxes over points in packed order; nodes are numbered level by level, leaves first."""

    def __init__(self, labels: np.ndarray, points: np.ndarray, ids: list[list[int]]):
        self.labels, self.points, self.ids = labels, points, ids
        low, high = [], []
        least, most = [], []
        a, b = np.arange(0, len(points), LEAF_ROWS), len(points)
        lo, hi, l0, l1 = points, points, labels, labels
        self.first, self.levels = [], []
        while True:
            lo, hi = np.minimum.reduceat(lo, a, axis=0), np.maximum.reduceat(hi, a, axis=0)
            l0, l1 = np.minimum.reduceat(l0, a), np.maximum.reduceat(l1, a)
            base = sum(self.levels)
            self.first += [(int(x), int(min(x + (FAN if self.levels else LEAF_ROWS), b))) for x in a]
            self.levels.append(len(a))
            low.append(lo), high.append(hi), least.append(l0), most.append(l1)
            if len(a) == 1:
                break
            a, b = np.arange(0, self.levels[-1], FAN), self.levels[-1]
        self.low, self.high = np.concatenate(low), np.concatenate(high)
        self.least, self.most = np.concatenate(least).tolist(), np.concatenate(most).tolist()
        self.below = [0] * self.levels[0]  # where the children of a node's level begin
        for k in range(1, len(self.levels)):
            self.below += [sum(self.levels[:k - 1])] * self.levels[k]
        self.root = base

    def intervals(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest inner product of each query with each box."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T

    def search(self, query: np.ndarray, lower, upper, label: int, same: bool, window: tuple, k: int, known: dict):
        """The ``k`` best ``(-score, id)`` in the window, best first.  ``known`` keeps the scores of
        leaves between searches of one query."""
        low, high = window
        best: list[tuple[int, int]] = []
        todo = [(-upper[self.root], self.root)]
        while todo:
            reach, node = heapq.heappop(todo)
            if -reach < low or len(best) == k and -reach < -best[-1][0]:
                break
            if lower[node] > high or (self.least[node] > label or self.most[node] < label if same
                                      else self.least[node] == label == self.most[node]):
                continue
            a, b = self.first[node]
            if node >= self.levels[0]:
                for child in range(self.below[node] + a, self.below[node] + b):
                    heapq.heappush(todo, (-upper[child], child))
                continue
            if node not in known:
                known[node] = self.points[a:b] @ query
            score = known[node]
            floor = max(low, -best[-1][0]) if len(best) == k else low
            fits = (score >= floor) & (score <= high) & ((self.labels[a:b] == label) == same)
            found = [(-int(score[i]), v) for i in np.flatnonzero(fits) for v in self.ids[a + i]]
            if found:
                best = sorted(best + found)[:k]
        return best


def grid(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def exact(tree_points: np.ndarray, queries: np.ndarray) -> type:
    """Double precision where it holds every product and sum, whole numbers of any size beyond."""
    size = lambda x: float(np.abs(x.astype(np.float64)).max(initial=1))
    return np.float64 if size(tree_points) * size(queries) * max(tree_points.shape[1], 1) < EXACT else object


def trees(batch: pa.RecordBatch):
    """``(shard, labels, points, ids, asked)`` of the packed shards of a batch."""
    for row in batch.to_pylist():
        labels = np.frombuffer(row["labels"], np.int64)
        points = np.frombuffer(row["points"], np.int64).reshape(len(labels), -1)
        yield row["shard"], labels, points, row["ids"], np.frombuffer(row["asked"], bool)


def capped(score: int) -> int:
    return max(-2**63, min(2**63 - 1, score))


def _found(shard_rows, queries: list[dict], k: int, home_only: bool):
    """Search results of ``queries`` (``qid, label, vector, same, windows``) in some shards:
    ``(qid, window, id, score)``, windows by their place."""
    for shard, labels, points, ids, _ in shard_rows:
        mine = [q for q in queries if q["qid"] // ROW == shard] if home_only else queries
        for at in range(0, len(mine), 1024):
            block = mine[at:at + 1024]
            width = max(points.shape[1], max(len(q["vector"]) for q in block))
            wide = np.zeros((len(points), width), np.int64)
            wide[:, :points.shape[1]] = points
            asked = grid([q["vector"] for q in block], width)
            kind = exact(wide, asked)
            tree, asked = Tree(labels, wide.astype(kind), ids), asked.astype(kind)
            lower, upper = tree.intervals(asked)
            for i, q in enumerate(block):
                known: dict = {}
                for w, window in enumerate(q["windows"]):
                    for score, v in tree.search(asked[i], lower[i], upper[i], q["label"], q["same"], window, k, known):
                        yield q["qid"], w, v, capped(-score)


# ------------------------------------------------------------ the operator


def usable(table: DataFrame, id_col: str, vector: str, label: str) -> DataFrame:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (table.filter(F.col(id_col).isNotNull() & F.col(vector).isNotNull() & F.col(label).isNotNull() & whole)
            .select(F.col(id_col).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                    _short(F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))).alias("vector")))


def _short(vector: Column) -> Column:
    """A vector without its last zeros: one form for vectors that are equal when padded."""
    used = F.array_max(F.transform(vector, lambda x, i: F.when(x != 0, i + 1).otherwise(0)))
    return F.slice(vector, 1, F.coalesce(used, F.lit(0)))


def points_of(rows: DataFrame, asked: DataFrame, keep: int) -> DataFrame:
    """``(label, vector, ids, asked)``: different points with their ``keep`` smallest ids."""
    first = Window.partitionBy("label", "vector").orderBy("vec_id")
    few = rows.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") <= keep)
    queries = asked.select("label", "vector").distinct()
    both = few.select("label", "vector", "vec_id", F.lit(False).alias("asked")).unionByName(
        queries.select("label", "vector", F.lit(None).cast("long").alias("vec_id"), F.lit(True).alias("asked")))
    return both.groupBy("label", "vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"), F.max("asked").alias("asked"))


def _key(place: int) -> Column:
    """Order by a coordinate, ties by a hash, so that slabs have equal sizes."""
    value = F.coalesce(F.get("vector", F.lit(place)), F.lit(0))
    bound = 1 << 41
    return F.least(F.greatest(value, F.lit(-bound)), F.lit(bound)) * (1 << 21) + F.pmod(F.xxhash64("vector", "label"), F.lit(1 << 21))


def _cuts(parts: int) -> list[float]:
    return [k / parts for k in range(1, parts)]


def packed(points: DataFrame) -> DataFrame:
    """One row per shard: its points in packed order."""
    points = settled(points)
    shards = max(1, -(-points.count() // SHARD_ROWS))
    slabs = math.ceil(math.sqrt(shards))
    tiles = -(-shards // slabs)
    below = lambda cuts, key: F.size(F.filter(cuts, lambda x: x < key))
    if slabs > 1:
        cuts = points.agg(F.percentile_approx(_key(0), _cuts(slabs), 10_000)).first()[0] or []
        points = points.withColumn("slab", below(F.array(*[F.lit(c) for c in cuts]), _key(0)))
    else:
        points = points.withColumn("slab", F.lit(0))
    if tiles > 1:
        inner = points.groupBy("slab").agg(F.percentile_approx(_key(1), _cuts(tiles), 10_000).alias("_cuts"))
        points = points.join(inner, "slab").withColumn("tile", below(F.col("_cuts"), _key(1))).drop("_cuts")
    else:
        points = points.withColumn("tile", F.lit(0))
    points = points.withColumn("shard", (F.col("slab") * tiles + F.col("tile")).cast("long")).drop("slab", "tile")

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        labels = rows["label"].to_numpy(np.int64)
        vectors = grid(list(rows["vector"]), max(1, *(len(v) for v in rows["vector"])))
        order = packed_order(labels, vectors)
        ids = rows["ids"].to_list()
        return pd.DataFrame({"shard": rows["shard"].iloc[:1], "labels": [labels[order].tobytes()],
                             "points": [np.ascontiguousarray(vectors[order]).tobytes()],
                             "ids": [[list(ids[i]) for i in order]], "asked": [rows["asked"].to_numpy(bool)[order].tobytes()]})

    return settled(points.groupBy("shard").applyInPandas(
        pack, "shard long, labels binary, points binary, ids array<array<long>>, asked binary"))


def _slices(asked: DataFrame) -> list[DataFrame]:
    parts = max(1, -(-asked.count() // (SLICE_ROWS // 2)))
    return [asked.filter(F.pmod(F.xxhash64("qid"), F.lit(parts)) == k) for k in range(parts)]


FOUND = "qid long, win int, vec_id long, score long"


def _pass(shards: DataFrame, queries: list[dict], k: int, home_only: bool = False) -> DataFrame:
    shared = shards.sparkSession.sparkContext.broadcast(queries)

    def run(batches):
        for batch in batches:
            rows = list(_found(trees(batch), shared.value, k, home_only))
            yield pa.RecordBatch.from_pylist([dict(zip(("qid", "win", "vec_id", "score"), r)) for r in rows],
                                             schema=pa.schema([("qid", pa.int64()), ("win", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())]))

    found = settled(shards.mapInArrow(run, FOUND))
    shared.destroy()
    return found


def _asked(shards: DataFrame, k: int) -> DataFrame:
    """The queries, with the kth score that their own shard has for their own label."""

    def run(batches):
        for batch in batches:
            for shard, labels, points, ids, asked in trees(batch):
                mine = [{"qid": shard * ROW + int(i), "label": int(labels[i]), "vector": points[i].tolist(), "same": True,
                         "windows": [(-math.inf, math.inf)]} for i in np.flatnonzero(asked)]
                floors: dict[int, list[int]] = {}
                for qid, _, _, score in _found([(shard, labels, points, ids, asked)], mine, k, False):
                    floors.setdefault(qid, []).append(score)
                rows = [{"qid": q["qid"], "label": q["label"], "vector": q["vector"],
                         "floor": min(floors[q["qid"]]) if len(floors.get(q["qid"], ())) == k else None} for q in mine]
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                    ("qid", pa.int64()), ("label", pa.int64()), ("vector", pa.list_(pa.int64())), ("floor", pa.int64())]))

    return settled(shards.mapInArrow(run, "qid long, label long, vector array<long>, floor long"))


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """One row per key with its ``k`` best ``(score, vec_id)`` in order."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= k)
    best = F.array_sort(F.collect_list(F.struct("_rn", "score", "vec_id")))
    return top.groupBy(*keys).agg(best.alias("best"))


def window_of(score: int) -> tuple[int, int]:
    """Scores ``n`` with ``LOW * score <= BASE * n <= HIGH * score``."""
    return -((-LOW_PERCENT * score) // BASE_PERCENT), (HIGH_PERCENT * score) // BASE_PERCENT


def hard_negatives(table: DataFrame, anchors: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``: for each
    anchor (rows where ``anchors`` over ``vec_id`` holds; all, if None) and each of its ``positives``
    best rows of the same label, the ``negatives`` best rows of other labels in the score window."""
    rows = settled(usable(table, id_col, vector, label).distinct())
    chosen = rows if anchors is None else rows.filter(anchors)
    shards = packed(points_of(rows, chosen, max(positives, negatives) + 1))
    asked = _asked(shards, positives + 1)
    near, far = None, None
    for part in _slices(asked):
        queries = [{"qid": r["qid"], "label": r["label"], "vector": list(r["vector"]), "same": True,
                    "windows": [(-math.inf if r["floor"] is None else r["floor"], math.inf)]} for r in part.collect()]
        found = _pass(shards, queries, positives + 1)
        near = found if near is None else near.unionByName(found)
    near = settled(_ranked(near, ["qid"], positives + 1))
    scored = near.join(asked.drop("floor"), "qid").select("qid", "label", "vector", F.array_sort(F.array_distinct(
        F.transform("best", lambda b: b["score"]))).alias("scores"))
    for part in _slices(settled(scored)):
        queries = [{"qid": r["qid"], "label": r["label"], "vector": list(r["vector"]), "same": False, "scores": list(r["scores"]),
                    "windows": [window_of(s) for s in r["scores"]]} for r in part.collect()]
        kth = _ranked(_pass(shards, queries, negatives, True), ["qid", "win"], negatives).filter(F.size("best") == negatives)
        floors = {(r["qid"], r["win"]): r["kth"] for r in kth.select("qid", "win", F.col("best")[negatives - 1]["score"].alias("kth")).collect()}
        for q in queries:
            q["windows"] = [(max(low, floors.get((q["qid"], w), low)), high) for w, (low, high) in enumerate(q["windows"])]
        places = spark_rows(shards, [(q["qid"], w, s) for q in queries for w, s in enumerate(q["scores"])])
        found = _pass(shards, queries, negatives).join(places, ["qid", "win"])
        far = found if far is None else far.unionByName(found)
    far = _ranked(far, ["qid", "positive_score"], negatives)
    # a point's results go to all anchors that lie on it
    name = F.md5(F.concat_ws(",", F.col("label").cast("string"), F.transform("vector", lambda x: x.cast("string"))))
    per_point = asked.select("qid", "label", _short(F.col("vector")).alias("vector")).select("qid", name.alias("point")).join(near, "qid")
    per_anchor = spread_join(chosen.select("vec_id", name.alias("point")), per_point, "point", "vec_id")
    other = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("anchor_id")), 1, positives)
    pairs = (per_anchor.withColumnRenamed("vec_id", "anchor_id").select("anchor_id", "qid", F.explode(other).alias("p"))
             .select("anchor_id", "qid", F.col("p.vec_id").alias("positive_id"), F.col("p.score").alias("positive_score")))
    place = F.concat_ws(":", "qid", "positive_score")
    full = spread_join(pairs.withColumn("place", place), far.select(place.alias("place"), "best"), "place", "anchor_id")
    return (full.select("anchor_id", "positive_id", "positive_score", F.explode("best").alias("n"))
            .select("anchor_id", "positive_id", F.col("n._rn").alias("rank"), F.col("n.vec_id").alias("negative_id"),
                    "positive_score", F.col("n.score").alias("negative_score")))


def spark_rows(like: DataFrame, rows: list) -> DataFrame:
    """The scores of the windows of one slice of queries, as a table."""
    return like.sparkSession.createDataFrame(rows, "qid long, win int, positive_score long")


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table.withColumn("label", moved), F.col("vec_id") % 100 == 0)


SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS anchor_id, q.label AS anchor_label, c.vec_id, c.label,
         CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda x: x[1] * x[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id OR q.label <> c.label WHERE q.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score FROM s
  WHERE label = anchor_label AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id, anchor_label ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.anchor_label, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.anchor_label = p.anchor_label AND s.label <> p.anchor_label
    AND 30 * CAST(positive_score AS HUGEINT) <= 100 * CAST(s.score AS HUGEINT)
    AND 100 * CAST(s.score AS HUGEINT) <= 90 * CAST(positive_score AS HUGEINT))
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
