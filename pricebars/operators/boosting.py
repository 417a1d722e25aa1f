"""Gradient-boosted trees, one model per series, all series of a table in one job.

A series (the rows of one group key, such as coin and horizon) is one row per calendar
day at most, so a group is bounded by the calendar, as the windows of the features are;
a table grows by series.  Spark deals the series over the cluster (``applyInPandas``), fits
each in its own task and gives the models back as a table, one row per tree; scoring joins
that table with the rows again, and importances are aggregates over it.

Trees grow level by level on second-order statistics: a split's gain is
``s(left) + s(right) - s(node)`` with ``s = max(|G| - alpha, 0)^2 / (H + lambda)`` over sums of
gradients and hessians; every boundary between two different values of a feature is tried.
Squared error starts from the label mean; softmax has one margin and one tree per class and
round, starting from equal probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_GAIN = 1e-6
TREES = ("round int, cls int, base double, feature array<int>, threshold array<double>, value array<double>, "
         "gain array<double>, cover array<double>")


@dataclass(frozen=True)
class Params:
    rounds: int
    depth: int
    rate: float = 0.05
    alpha: float = 0.0
    lam: float = 1.0
    least: float = 3.0       # least hessian sum of a child
    rows: float = 0.8        # share of rows and of columns drawn for each round
    columns: float = 0.8
    classes: int = 0         # 0: squared error, else softmax
    seed: int = 42


def _score(g, h, p: Params):
    return np.maximum(np.abs(g) - p.alpha, 0.0) ** 2 / (h + p.lam)


def grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, order: np.ndarray, columns: np.ndarray, p: Params) -> dict:
    """One tree over the rows in ``order`` (row numbers by each of ``columns``, ascending).
    Nodes are numbered as in a heap; rows below a node's threshold go left."""
    size = 2 ** (p.depth + 1) - 1
    tree = {"feature": np.full(size, -1, np.int32), **{k: np.zeros(size) for k in ("threshold", "value", "gain", "cover")}}
    nodes, starts = np.array([0]), np.array([0, order.shape[1]])
    place = np.zeros(len(x), np.int16)
    for level in range(p.depth + 1):
        rows = order[0]
        G, H = (np.add.reduceat(v[rows], starts[:-1]) for v in (g, h))
        tree["value"][nodes] = -p.rate * np.sign(G) * np.maximum(np.abs(G) - p.alpha, 0.0) / (H + p.lam)
        tree["cover"][nodes] = H
        if level == p.depth:
            break
        sizes = np.diff(starts)
        value = x[order, columns[:, None]]
        left_g, left_h = np.cumsum(g[order], axis=1), np.cumsum(h[order], axis=1)
        for v in (left_g, left_h):  # sums within each node
            v -= np.repeat(np.concatenate([np.zeros((len(v), 1)), v[:, starts[1:-1] - 1]], axis=1), sizes, axis=1)
        right_g, right_h = np.repeat(G, sizes) - left_g, np.repeat(H, sizes) - left_h
        gain = _score(left_g, left_h, p) + _score(right_g, right_h, p) - np.repeat(_score(G, H, p), sizes)
        can = (left_h >= p.least) & (right_h >= p.least)
        can[:, :-1] &= value[:, 1:] > value[:, :-1]
        can[:, starts[1:] - 1] = False
        gain[~can] = -np.inf
        place[rows] = -1
        grown = []
        for k, node in enumerate(nodes):
            a, b = starts[k], starts[k + 1]
            f, at = divmod(int(gain[:, a:b].argmax()), b - a)
            if gain[f, a + at] > LEAST_GAIN:
                tree["feature"][node], tree["threshold"][node] = columns[f], value[f, a + at + 1]
                tree["gain"][node] = gain[f, a + at]
                place[order[f, a:a + at + 1]], place[order[f, a + at + 1:b]] = len(grown), len(grown) + 1
                grown += [2 * node + 1, 2 * node + 2]
        if not grown:
            break
        side = place[order]
        order = np.take_along_axis(order, np.argsort(side, axis=1, kind="stable"), axis=1)[:, int((side[0] < 0).sum()):]
        nodes = np.array(grown)
        starts = np.concatenate([[0], np.cumsum(np.bincount(place[order[0]], minlength=len(grown)))])
    return tree


def margins(x: np.ndarray, trees: list[dict]) -> np.ndarray:
    """The sum of the leaf values that each row reaches."""
    out, rows = np.zeros(len(x)), np.arange(len(x))
    for tree in trees:
        node = np.zeros(len(x), np.int64)
        for _ in range(int(np.log2(len(tree["feature"]) + 1)) - 1):
            feature = tree["feature"][node]
            child = 2 * node + 1 + ~(x[rows, feature] < tree["threshold"][node])
            node = np.where(feature < 0, node, child)
        out += tree["value"][node]
    return out


def softmax(m: np.ndarray) -> np.ndarray:
    e = np.exp(m - m.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def boost(x: np.ndarray, y: np.ndarray, p: Params) -> list[dict]:
    """The trees of one series."""
    rng = np.random.default_rng(p.seed)
    base = 0.0 if p.classes else float(y.mean())
    m = np.full((len(x), max(p.classes, 1)), base)
    sorted_rows = np.argsort(x, axis=0, kind="stable").T
    hot = np.eye(p.classes)[y.astype(int)] if p.classes else None
    out = []
    for r in range(p.rounds):
        if p.classes:
            prob = softmax(m)
            grad, hess = prob - hot, np.maximum(2 * prob * (1 - prob), 1e-16)
        else:
            grad, hess = m - y[:, None], np.ones((len(x), 1))
        drawn = rng.random(len(x)) < p.rows if p.rows < 1 else np.ones(len(x), bool)
        columns = np.sort(rng.permutation(x.shape[1])[:max(1, int(p.columns * x.shape[1]))])
        order = sorted_rows[columns]
        order = order[drawn[order]].reshape(len(columns), -1)
        if not order.size:
            continue
        for c in range(m.shape[1]):
            tree = grow(x, grad[:, c], hess[:, c], order, columns, p)
            m[:, c] += margins(x, [tree])
            out.append({"round": r, "cls": c, "base": base, **tree})
    return out


# ------------------------------------------------------------ on Spark


def _ddl(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)


def fit(train: DataFrame, keys: list[str], params: Params) -> DataFrame:
    """Model table ``(keys..., TREES)`` of the series in ``train`` (``keys..., event_date, features, label``)."""
    p = params

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("event_date")
        trees = boost(np.stack(rows["features"].to_list()), rows["label"].to_numpy(np.float64), p)
        out = pd.DataFrame([{**{k: rows[k].iloc[0] for k in keys}, **{c: v if np.isscalar(v) else v.tolist() for c, v in t.items()}} for t in trees])
        return out[[*keys, *(c.split()[0] for c in TREES.split(", "))]]

    # dealt by count, not by bytes: the rows are few but each series is long work
    parts = max(int(train.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8 * train.sparkSession.sparkContext.defaultParallelism)
    return train.repartition(parts, *keys).groupBy(*keys).applyInPandas(one, f"{_ddl(train, keys)}, {TREES}")


def predict(rows: DataFrame, trees: DataFrame, keys: list[str], params: Params) -> DataFrame:
    """``rows`` (with ``features``) and ``margins``, one per class (one for squared error)."""
    classes, carried = max(params.classes, 1), [c for c in rows.columns if c != "features"]

    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({**{c: left[c].iloc[:0] for c in carried}, "margins": []})
        x = np.stack(left["features"].to_list())
        m = np.stack([margins(x, right[right["cls"] == c].to_dict("records")) for c in range(classes)], axis=1) + right["base"].iloc[0]
        return left[carried].assign(margins=m.tolist())

    schema = f"{_ddl(rows, carried)}, margins array<double>"
    return rows.groupBy(*keys).cogroup(trees.groupBy(*keys)).applyInPandas(one, schema)


def importance(trees: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``(keys..., feature, importance)``: each feature's mean gain per split as a share of the sum over
    all features of the model; 0 for a feature that no tree uses."""
    splits = (trees.select(*keys, F.explode(F.arrays_zip("feature", "gain")).alias("s"))
              .select(*keys, F.col("s.feature").alias("place"), F.col("s.gain").alias("gain")).filter("place >= 0"))
    means = splits.groupBy(*keys, "place").agg(F.avg("gain").alias("mean"))
    by_place = F.map_from_entries(F.collect_list(F.struct("place", "mean")))
    models = trees.select(*keys).distinct().join(means.groupBy(*keys).agg(by_place.alias("m"), F.sum("mean").alias("total")), keys, "left")
    names = F.posexplode(F.array(*[F.lit(c) for c in columns])).alias("place", "feature")
    share = F.coalesce(F.try_divide(F.col("m")[F.col("place")], F.col("total")), F.lit(0.0))
    return models.select(*keys, "m", "total", names).select(*keys, "feature", share.alias("importance"))


def roots(trees: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys..., cls, cover, gain, left_cover)`` of the root of each first tree; no split: gain 0."""
    split = F.col("feature")[0] >= 0
    return trees.filter("round = 0").select(*keys, "cls", F.col("cover")[0].alias("cover"), F.col("gain")[0].alias("gain"),
                                            F.when(split, F.col("cover")[1]).alias("left_cover"))
