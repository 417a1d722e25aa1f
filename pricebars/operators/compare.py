"""Cross-coin comparison: wide close matrix, correlation, normalised change.

The coin universe is the (small, fixed) list of symbols of the coin dimension;
it is passed in explicitly, so ``pivot`` needs no extra pass to find values.
No step pairs rows with each other: the correlation matrix is made of Gram sums of blocks
of symbols, one task for each pair of blocks and chunk of dates, so its plan is the same
for five symbols and for thousands.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def symbols_of(dim: DataFrame) -> list[str]:
    """The symbols of the coin dimension, in order (one row per supported coin)."""
    return sorted(r["coin_symbol"] for r in dim.select("coin_symbol").distinct().collect())


def pivot_close(metrics: DataFrame, symbols: list[str], value: str = "close_price_usd") -> DataFrame:
    """Dates down, symbols across (NULL where a coin has no row that day)."""
    return metrics.groupBy("event_date").pivot("coin_symbol", list(symbols)).agg(F.max(value))


PAIRS_PER_AGGREGATE = 128 * 128     # pairs of symbols of two blocks
CHUNK_DAYS = 2048
_SUMS = ["n", "sx", "sy", "sxx", "syy", "sxy"]
_ENDS = ["min_x", "max_x", "min_y", "max_y"]


def _matrix(rows: pd.DataFrame, width: int) -> np.ndarray:
    """Dates x symbols of one block, NaN where there is no value."""
    out = np.full((len(rows), width), np.nan)
    for k, cells in enumerate(rows["cells"]):
        for cell in cells:
            out[k, cell["place"]] = cell["value"]
    return out


def _gram(x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Sums over the dates that both of a pair have, for each symbol of ``x`` and of ``y``."""
    mx, my = ~np.isnan(x), ~np.isnan(y)
    fx, fy, ox, oy = np.where(mx, x, 0.0), np.where(my, y, 0.0), mx.astype(float), my.astype(float)
    out = {"n": ox.T @ oy, "sx": fx.T @ oy, "sy": ox.T @ fy, "sxx": (fx * fx).T @ oy, "syy": ox.T @ (fy * fy), "sxy": fx.T @ fy}
    # the range of each side on the common dates tells a constant one exactly
    low = lambda v, m: np.where(m, v, np.inf).min(axis=0, initial=np.inf)
    high = lambda v, m: np.where(m, v, -np.inf).max(axis=0, initial=-np.inf)
    out["min_x"] = np.stack([low(fx, mx & my[:, j:j + 1]) for j in range(y.shape[1])], axis=1)
    out["max_x"] = np.stack([high(fx, mx & my[:, j:j + 1]) for j in range(y.shape[1])], axis=1)
    out["min_y"] = np.stack([low(fy, my & mx[:, i:i + 1]) for i in range(x.shape[1])], axis=0)
    out["max_y"] = np.stack([high(fy, my & mx[:, i:i + 1]) for i in range(x.shape[1])], axis=0)
    return out


def correlation(metrics: DataFrame, symbols: list[str], value: str = "close_price_usd") -> DataFrame:
    """Long-form correlation matrix ``(symbol_a, symbol_b, corr)`` of closes: Pearson over the dates
    that both symbols have; NULL when either side is constant there or fewer than two pair up.

    Symbols are dealt into blocks and dates into chunks.  Each pair of blocks meets per chunk in
    one task as two small matrices, whose Gram sums (counts, sums, products) are added over
    the chunks by one aggregate.  Values are taken from the symbol's first one, so that sums
    of squares keep their digits."""
    spark = metrics.sparkSession
    symbols = list(symbols)
    width = max(1, math.isqrt(PAIRS_PER_AGGREGATE))
    blocks = max(1, -(-len(symbols) // width))
    index = spark.createDataFrame(list(enumerate(symbols)), "id long, coin_symbol string")
    daily = metrics.groupBy("event_date", "coin_symbol").agg(F.max(value).alias("v")).where("v is not null and not isnan(v)")
    first = daily.groupBy("coin_symbol").agg(F.min_by("v", "event_date").alias("v0"))
    cells = daily.join(index.join(first, "coin_symbol"), "coin_symbol").select(
        "event_date", F.floor(F.col("id") / width).cast("int").alias("block"),
        F.struct((F.col("id") % width).cast("int").alias("place"), (F.col("v") - F.col("v0")).alias("value")).alias("cell"))
    packed = cells.groupBy("event_date", "block").agg(F.collect_list("cell").alias("cells"))
    chunk = F.floor(F.unix_date("event_date") / CHUNK_DAYS).cast("int").alias("chunk")
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    met = packed.select("event_date", chunk, "block", "cells", other).select(
        "event_date", "chunk", "block", "cells", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"))

    def sums(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = int(rows["a"].iloc[0]), int(rows["b"].iloc[0])
        days = pd.Index(rows["event_date"].unique())
        left, right = (rows[rows["block"] == k].set_index("event_date").reindex(days) for k in (a, b))
        x, y = (_matrix(side.assign(cells=[c if isinstance(c, (list, np.ndarray)) else [] for c in side["cells"]]), width) for side in (left, right))
        gram = _gram(x, y)
        i, j = np.nonzero(gram["n"])
        keep = (a * width + i) <= (b * width + j)  # the mirror half has the same values
        i, j = i[keep], j[keep]
        return pd.DataFrame({"i": a * width + i, "j": b * width + j, **{k: v[i, j] for k, v in gram.items()}})

    schema = "i long, j long, " + ", ".join(f"{c} double" for c in _SUMS + _ENDS)
    parts = met.groupBy("chunk", "a", "b").applyInPandas(sums, schema)
    total = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in _SUMS],
                                        *[(F.min if c.startswith("min") else F.max)(c).alias(c) for c in _ENDS])
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    spread = lambda c: F.col(f"s{c}{c}") - F.col(f"s{c}") * F.col(f"s{c}") / F.col("n")
    varies = (F.col("min_x") < F.col("max_x")) & (F.col("min_y") < F.col("max_y"))
    known = total.select("i", "j", F.when(varies, F.try_divide(cov, F.sqrt(spread("x")) * F.sqrt(spread("y")))).alias("corr"))
    # every pair has a row, also one without a common date
    n = F.lit(len(symbols))
    grid = spark.range(len(symbols) ** 2).select((F.col("id") / n).cast("long").alias("p"), (F.col("id") % n).alias("q"))
    grid = grid.select("p", "q", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"))
    names = {c: index.select(F.col("id").alias(c), F.col("coin_symbol").alias(f"symbol_{c}")) for c in "pq"}
    return (grid.join(known, ["i", "j"], "left").join(names["p"], "p").join(names["q"], "q")
            .select(F.col("symbol_p").alias("symbol_a"), F.col("symbol_q").alias("symbol_b"), "corr"))


def normalized(metrics: DataFrame, symbols: list[str]) -> DataFrame:
    """Change in percent of each coin's close against its close on the table's
    first date, on the dense date x symbol grid (NULL where a coin has no row, and
    for the whole coin when it has no row on the first date).

    Everything derives from the one pivoted frame: the base row is a global
    ``min_by(symbol, event_date)`` aggregate over it (one row per symbol), so the
    input is computed once and the pivot's shuffle is reused."""
    wide = pivot_close(metrics, symbols)
    cols = [F.col(f"`{s}`") for s in symbols]
    grid = wide.unpivot("event_date", cols, "coin_symbol", "close")
    first = wide.agg(*[F.min_by(F.col(f"`{s}`"), "event_date").alias(s) for s in symbols])
    base = first.unpivot([], [F.col(f"`{s}`") for s in symbols], "coin_symbol", "base")
    change = F.try_divide(F.col("close") - F.col("base"), F.col("base")) * F.lit(100.0)
    return (grid.join(base, "coin_symbol", "left")
            .select("event_date", "coin_symbol", change.alias("value")))
