"""The boosted trees against a plain recursion, and their use on Spark."""

import datetime as dt

import numpy as np
import pytest

from pricebars.operators import boosting as B
from pricebars.operators.boosting import Params


def plain(x, g, h, rows, depth, p):
    """The same tree by recursion: ``(feature, threshold, left, right)`` or a leaf's value."""
    def s(rs):
        return max(abs(sum(g[r] for r in rs)) - p.alpha, 0.0) ** 2 / (sum(h[r] for r in rs) + p.lam)

    best = (B.LEAST_GAIN, None)
    if depth:
        for f in range(x.shape[1]):
            for t in sorted({x[r, f] for r in rows})[1:]:
                left, right = [r for r in rows if x[r, f] < t], [r for r in rows if x[r, f] >= t]
                if min(sum(h[r] for r in left), sum(h[r] for r in right)) >= p.least:
                    gain = s(left) + s(right) - s(rows)
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, t, left, right))
    if best[1] is None:
        G = sum(g[r] for r in rows)
        return -p.rate * np.sign(G) * max(abs(G) - p.alpha, 0.0) / (sum(h[r] for r in rows) + p.lam)
    f, t, left, right = best[1]
    return f, t, plain(x, g, h, left, depth - 1, p), plain(x, g, h, right, depth - 1, p)


def walk(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] < tree[1] else tree[3]
    return tree


@pytest.mark.parametrize("alpha,least", [(0.0, 1.0), (0.1, 3.0)])
def test_tree_equals_plain_recursion(alpha, least):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(60, 4)), 1)  # equal values occur
    g, h = rng.normal(size=60), rng.uniform(0.5, 1.0, size=60)
    p = Params(rounds=1, depth=3, alpha=alpha, least=least)
    tree = B.grow(x, g, h, np.argsort(x, axis=0, kind="stable").T, np.arange(4), p)
    want = plain(x, g, h, list(range(60)), 3, p)
    assert B.margins(x, [tree]) == pytest.approx([walk(want, row) for row in x])


def test_rounds_lower_the_loss():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 5))
    y = x[:, 0] * 3 + np.sin(x[:, 1] * 4)
    loss = []
    for rounds in (1, 10, 60):
        trees = B.boost(x, y, Params(rounds=rounds, depth=4))
        loss.append(np.mean((y - trees[0]["base"] - B.margins(x, trees)) ** 2))
    assert loss[0] > loss[1] > loss[2] and loss[2] < 0.05 * np.var(y)


def test_softmax_has_one_tree_per_class_and_round():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(150, 3))
    y = (x[:, 0] > 0).astype(int) + (x[:, 1] > 0.5)
    trees = B.boost(x, y, Params(rounds=20, depth=3, classes=3))
    assert [(t["round"], t["cls"]) for t in trees] == [(r, c) for r in range(20) for c in range(3)]
    m = np.stack([B.margins(x, [t for t in trees if t["cls"] == c]) for c in range(3)], axis=1)
    assert np.allclose(B.softmax(m).sum(axis=1), 1) and (B.softmax(m).argmax(axis=1) == y).mean() > 0.9


def frame(spark, series):
    rows = [(k, dt.date(2024, 1, 1) + dt.timedelta(i), [float(v) for v in x], float(y)) for k, (xs, ys) in series.items()
            for i, (x, y) in enumerate(zip(xs, ys))]
    return spark.createDataFrame(rows, "coin_id string, event_date date, features array<double>, label double")


def test_each_series_has_its_own_model(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=(80, 3))
    series = {"up": (a, a[:, 0]), "down": (a, -100 * a[:, 0])}
    p = Params(rounds=30, depth=3)
    data = frame(spark, series)
    trees = B.fit(data, ["coin_id"], p)
    both = {(r["coin_id"], r["event_date"]): r["margins"][0] for r in B.predict(data, trees, ["coin_id"], p).collect()}
    alone = frame(spark, {"up": series["up"]})
    one = B.predict(alone, B.fit(alone, ["coin_id"], p), ["coin_id"], p).collect()
    assert len(both) == 160 and all(both["up", r["event_date"]] == r["margins"][0] for r in one)
    days = sorted(d for c, d in both if c == "up")
    assert np.corrcoef([both["up", d] for d in days], a[:, 0])[0, 1] > 0.9
    assert np.corrcoef([both["down", d] for d in days], a[:, 0])[0, 1] < -0.9
    shares = B.importance(trees, ["coin_id"], ["x", "y", "z"]).collect()
    assert len(shares) == 6 and {r["feature"] for r in shares} == {"x", "y", "z"}
    for c in ("up", "down"):
        mine = {r["feature"]: r["importance"] for r in shares if r["coin_id"] == c}
        assert sum(mine.values()) == pytest.approx(1) and max(mine, key=mine.get) == "x"


def test_constant_label_and_empty_table(spark):
    p = Params(rounds=2, depth=2)
    data = frame(spark, {"flat": (np.ones((10, 2)), np.full(10, 7.0))})
    got = B.predict(data, B.fit(data, ["coin_id"], p), ["coin_id"], p).collect()
    assert len(got) == 10 and all(r["margins"] == [7.0] for r in got)
    none = data.limit(0)
    assert B.fit(none, ["coin_id"], p).count() == 0
