"""Windows in blocks of a series and correlation in blocks of symbols."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricebars.operators import compare as C
from pricebars.operators import features as FT

START = dt.date(2015, 1, 1)


def metrics(spark, seed=0):
    """Two long series with gaps, one of a day and one of 31 rows."""
    rng = np.random.default_rng(seed)
    rows = []
    for coin, n in (("a", 700), ("b", 333), ("one", 1), ("short", 31)):
        day = 0
        for _ in range(n):
            day += int(rng.integers(1, 60)) if rng.random() < 0.1 else 1
            rows.append((coin, START + dt.timedelta(day), float(rng.uniform(50, 150)), float(rng.uniform(0, 9)), float(rng.uniform(1, 5))))
    return spark.createDataFrame(rows, "coin_id string, event_date date, close_price_usd double, volume_usd double, market_cap_usd double")


def rows_of(df):
    return {(r["coin_id"], r["event_date"]): tuple(r) for r in df.collect()}


@pytest.mark.parametrize("rows,span", [(30, 40), (64, 2048), (1024, 365)])
def test_blocks_give_the_same_features(spark, monkeypatch, rows, span):
    monkeypatch.setattr(FT, "RANK_DAYS", span)
    m = metrics(spark)
    for features in (FT.price_features, FT.trend_features):
        plain, cut = features(m), FT.in_blocks(m, features, rows=rows)
        assert cut.columns == plain.columns and rows_of(cut) == rows_of(plain)


def test_blocks_must_be_as_long_as_the_reach(spark):
    with pytest.raises(ValueError):
        FT.in_blocks(metrics(spark), FT.price_features, rows=29)


@pytest.mark.parametrize("pairs,days", [(4, 2048), (9, 13), (128 * 128, 100)])
def test_correlation_equals_pandas(spark, monkeypatch, pairs, days):
    monkeypatch.setattr(C, "PAIRS_PER_AGGREGATE", pairs)
    monkeypatch.setattr(C, "CHUNK_DAYS", days)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(90, 11)).cumsum(axis=0) + 1000
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 3] = 0.1 + 0.2                                        # constant
    x[:, 4] = np.where(np.arange(90) < 40, 7.5, np.nan)        # constant, and no date in common with the next
    x[:, 5] = np.where(np.arange(90) < 40, np.nan, x[:, 0])
    x[1:, 6] = np.nan                                          # a single day
    names = [f"S{k}" for k in range(12)]                       # the last one has no rows
    rows = [(START + dt.timedelta(int(d)), names[s], float(x[d, s])) for d in range(90) for s in range(11) if not np.isnan(x[d, s])]
    m = spark.createDataFrame(rows, "event_date date, coin_symbol string, close_price_usd double")
    got = C.correlation(m, names).toPandas().pivot(index="symbol_a", columns="symbol_b", values="corr").loc[names, names].to_numpy(float)
    want = np.full((12, 12), np.nan)
    want[:11, :11] = pd.DataFrame(x).corr(min_periods=2).to_numpy()
    want[3, :] = want[:, 3] = want[4, :] = want[:, 4] = np.nan
    assert (np.isnan(got) == np.isnan(want)).all() and np.nanmax(np.abs(got - want)) < 1e-9


def test_correlation_plan_does_not_grow_with_symbols(spark):
    m = spark.range(10).select(F.lit(START).alias("event_date"), F.concat(F.lit("S"), "id").alias("coin_symbol"), F.lit(1.0).alias("close_price_usd"))

    def size(n):
        return len(C.correlation(m, [f"S{k}" for k in range(n)])._jdf.queryExecution().optimizedPlan().toString())

    assert size(2000) < 1.2 * size(5)
