"""Exact top-k search by inner product: one KD-tree per shard.

Every vector is turned into integers, ``floor(1024 * x)``.  Candidate rows are dealt
by hash to shards of about ``SHARD_ROWS`` rows and queries to blocks of ``BLOCK_ROWS``
rows; one task joins one block with one shard, so no task holds more than that and
the work is spread over shards x blocks.  In a shard the tree splits at the median of
its widest dimension until a leaf holds ``LEAF_ROWS`` rows, and each node keeps its
tight bounding box.  A query visits nodes best first: the largest inner product that
a point in the box could have is the node's bound, and nodes whose bound is below the
query's kth best score are never opened.

The kth score is propagated: a first pass searches only one shard of each query and
its kth score is the starting bound in all shards of the second pass.  The result is
exact: a node is left out only if no row in it can enter the top k, equal scores
included (a node of the same bound is opened only if it holds a smaller id).

Defined cases: vectors that are NULL, or hold NULL or a non-finite component, and
rows without an id take no part; shorter vectors count as padded with zeros; rows that
are equal in id and vector count once; a query's own id is never among its results;
ties go to the smaller id.  Scores are exact; they leave the range of 64 bits only
for components beyond any embedding, and stop at its ends.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 1024
SHARD_ROWS = 8192
BLOCK_ROWS = 1024
LEAF_ROWS = 64
EXACT = 2.0**53


class Node:
    __slots__ = ("low", "high", "rows", "left", "right", "least")


def build(points: np.ndarray, ids: np.ndarray, rows: np.ndarray, nodes: list[Node]) -> int:
    """Add the subtree of ``rows`` to ``nodes``; returns its place.  Rows are halved
    by position around the median, so equal points never make a tree deeper."""
    node, here = Node(), points[rows]
    place = len(nodes)
    nodes.append(node)
    node.low, node.high, node.least = here.min(axis=0), here.max(axis=0), ids[rows].min()
    node.rows, node.left, node.right = rows, -1, -1
    if len(rows) > LEAF_ROWS and (wide := node.high - node.low).max(initial=0) > 0:
        half = len(rows) // 2
        order = np.argpartition(here[:, int(wide.argmax())], half)
        node.rows = None
        node.left = build(points, ids, rows[order[:half]], nodes)
        node.right = build(points, ids, rows[order[half:]], nodes)
    return place


def padded(vectors: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = np.floor(np.asarray(v, np.float64) * SCALE)
    return out


def search(points: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, k: int):
    """``(query row, id, score)`` of the ``k`` best rows of each query that reach its floor."""
    exact = max(np.abs(points).max(initial=0), 1) * max(np.abs(queries).max(initial=0), 1) * max(points.shape[1], 1) < EXACT
    if not exact:  # beyond double precision: whole numbers of any size
        points, queries = (np.vectorize(int, otypes=[object])(x) if x.size else x.astype(object) for x in (points, queries))
    nodes: list[Node] = []
    build(points, ids, np.arange(len(points)), nodes)
    high, low = np.stack([n.high for n in nodes]), np.stack([n.low for n in nodes])
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T  # query x node
    out = []
    for q in range(len(queries)):
        bound, best = bounds[q], []  # heap of (score, -id): the worst of the k on top
        floor = floors[q]
        todo = [(-bound[0], 0)]
        while todo:
            at = heapq.heappop(todo)
            node, reach = nodes[at[1]], -at[0]
            if reach < floor or len(best) == k and reach < best[0][0]:
                break
            if len(best) == k and reach == best[0][0] and node.least >= -best[0][1]:
                continue
            if node.rows is None:
                for child in (node.left, node.right):
                    heapq.heappush(todo, (-bound[child], child))
                continue
            score = points[node.rows] @ queries[q]
            near = ids[node.rows]
            keep = (score >= (max(floor, best[0][0]) if len(best) == k else floor)) & (near != query_ids[q])
            for s, i in sorted(zip(score[keep].tolist(), (-near[keep]).tolist()), reverse=True)[:k]:
                if len(best) < k:
                    heapq.heappush(best, (s, i))
                elif (s, i) > best[0]:
                    heapq.heapreplace(best, (s, i))
        out += [(q, -i, s) for s, i in best]
    return out


def _pass(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Scores of each (shard, block) pair that occurs in ``queries``: ``(query_id,
    query_row, vec_id, score)``."""

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        width = max((len(v) for v in (*left["vector"], *right["vector"])), default=0)
        ids, query_ids = left["vec_id"].to_numpy(np.int64), right["query_id"].to_numpy(np.int64)
        found = search(padded(left["vector"], width), ids, padded(right["vector"], width), query_ids,
                       right["floor"].to_numpy(np.float64), k) if len(left) and len(right) else []
        lim = np.iinfo(np.int64)
        return pd.DataFrame({"query_id": [int(query_ids[q]) for q, _, _ in found], "query_row": [int(right["query_row"].iloc[q]) for q, _, _ in found],
                             "vec_id": [int(i) for _, i, _ in found], "score": [max(lim.min, min(lim.max, int(s))) for _, _, s in found]})

    return rows.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")).applyInPandas(
        run, "query_id long, query_row long, vec_id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def usable(table: DataFrame, id_col: str, vector: str) -> DataFrame:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (table.filter(F.col(id_col).isNotNull() & F.col(vector).isNotNull() & whole)
            .select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
            .dropDuplicates())


def top_k(table: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of ``table`` of the highest
    inner product with each row of ``queries`` (same columns), but for its own id."""
    rows = usable(table, id_col, vector).checkpoint()
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    asked = usable(queries, id_col, vector).withColumn("query_row", F.xxhash64("vector"))
    blocks = max(1, -(-asked.count() // BLOCK_ROWS))
    deal = lambda c, n, seed: F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(n))
    asked = asked.select(F.col("vec_id").alias("query_id"), "query_row", "vector", deal("vec_id", blocks, 7).alias("block"))
    rows = rows.withColumn("shard", deal("vec_id", shards, 3)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))
    home = asked.withColumn("shard", F.pmod(F.col("block"), F.lit(shards))).withColumn("floor", F.lit(float("-inf")))
    first = _pass(rows, home, k)
    # a floor stands only where the home shard gave k rows
    floors = _top(first, k).filter(F.col("rank") == k).select("query_id", "query_row", F.col("score").cast("double").alias("kth"))
    other = (asked.join(floors, ["query_id", "query_row"], "left")
             .withColumn("floor", F.coalesce("kth", F.lit(float("-inf")))).drop("kth")
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<long>"))))
    second = _pass(rows, other, k)
    return _top(second, k).select("query_id", "rank", "vec_id", "score")


def op2_kdtree_topk(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(table, table.filter(F.col("vec_id") % 100 == 0))


SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda x: x[1] * x[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
