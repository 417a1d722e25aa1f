"""Hard negatives against brute force."""

import numpy as np
import pytest

from pricebars.llm import hardneg as H
from pricebars.session import ensure_checkpoint_dir


def brute(rows, anchor, positives=5, negatives=10):
    rows = {(i, lab, tuple(int(np.floor(256 * float(x))) for x in v)) for i, lab, v in rows
            if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = set()
    for i, lab, v in rows:
        if not anchor(i):
            continue
        mine = sorted((-dot(v, u), j) for j, m, u in rows if m == lab and j != i)[:positives]
        for p, j in mine:
            p = -p
            found = sorted((-dot(v, u), k) for k, m, u in rows if m != lab and 30 * p <= 100 * dot(v, u) <= 90 * p)[:negatives]
            out |= {(i, j, r + 1, k, p, -s) for r, (s, k) in enumerate(found)}
    return out


def mined(spark, rows, anchors, vector="array<float>"):
    ensure_checkpoint_dir(spark)
    table = spark.createDataFrame(rows, f"vec_id long, label int, embedding {vector}")
    got = H.hard_negatives(table, anchors).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    out = [tuple(r) for r in got.collect()]
    assert len(out) == len(set(out))
    return set(out)


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(H, "SHARD_ROWS", 60)
    monkeypatch.setattr(H, "LEAF_ROWS", 8)
    monkeypatch.setattr(H, "SLICE_ROWS", 10)
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(4, 6))
    rows = [(i, int(rng.integers(0, 4)), None) for i in range(400)]
    rows = [(i, lab, (centre[lab] + rng.normal(size=6) * 0.8).astype(np.float32).tolist()) for i, lab, _ in rows]
    rows += [(1000 + i, i % 3, rows[0][2]) for i in range(40)]      # many rows of one vector
    rows += [rows[5], rows[5]]                                       # repeated rows
    assert mined(spark, rows, H.F.col("vec_id") % 10 == 0) == brute(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    ok = [(i, i % 2, [float(i % 5), 1.0, float(i % 3)]) for i in range(30)]
    odd = [(None, 1, [1.0, 1.0, 1.0]), (100, None, [1.0, 1.0, 1.0]), (101, 1, None), (102, 1, [1.0, None, 1.0]),
           (103, 0, [float("nan"), 1.0, 1.0]), (104, 0, [float("inf"), 0.0, 0.0]), (105, 0, []), (106, 1, [2.0]), (107, 1, [2.0, 0.0]),
           (108, 0, [-1.0, -1.0, -1.0]), (109, 1, [0.0, 0.0, 0.0])]
    rows = ok + odd
    assert mined(spark, rows, None) == brute(rows, lambda i: True)


@pytest.mark.parametrize("size", [1.0, 3e8])
def test_scores_are_exact(spark, size):
    rng = np.random.default_rng(1)
    rows = [(i, i % 3, (rng.normal(size=4) * size).tolist()) for i in range(60)]  # beyond double precision, too
    if size > 1:
        assert max(abs(int(np.floor(256 * x))) for _, _, v in rows for x in v) ** 2 > 2**53
    got, want = mined(spark, rows, None, "array<double>"), brute(rows, lambda i: True)
    lim = 2**63 - 1
    assert got == {r for r in want if abs(r[4]) <= lim and abs(r[5]) <= lim} or got == want


def test_empty_table_and_one_label(spark):
    assert mined(spark, [], None) == set()
    assert mined(spark, [(i, 1, [1.0, float(i)]) for i in range(20)], None) == set()


def test_packed_order_and_boxes_hold_their_points():
    rng = np.random.default_rng(0)
    points, labels = rng.integers(-50, 50, (1000, 5)), rng.integers(0, 6, 1000)
    order = H.packed_order(labels, points)
    assert sorted(order.tolist()) == list(range(1000))
    tree = H.Tree(labels[order], points[order].astype(float), [[i] for i in order.tolist()])
    q = rng.integers(-50, 50, (20, 5)).astype(float)
    lower, upper = tree.intervals(q)
    scores = q @ tree.points.T
    for leaf in range(tree.levels[0]):
        a, b = tree.first[leaf]
        assert (scores[:, a:b] >= lower[:, leaf:leaf + 1]).all() and (scores[:, a:b] <= upper[:, leaf:leaf + 1]).all()
    assert (lower[:, tree.root] <= scores.min(axis=1)).all() and (upper[:, tree.root] >= scores.max(axis=1)).all()
    assert tree.levels[-1] == 1 and sum(tree.levels) == len(tree.low)
