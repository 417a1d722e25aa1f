"""Serving, comparison, features and modeling fixtures (FIXTURES N1-T1)."""

import datetime as dt

import pytest

from pricebars.functions.exprs import sentiment_band, trend_label
from pricebars.operators import compare as C
from pricebars.operators import features as FT
from pricebars.operators import modeling as M
from pricebars.operators import serving as S

D0 = dt.date(2024, 1, 1)


def series_frame(spark, closes_by_coin: dict, start=D0, dates_by_coin=None):
    rows = []
    for coin, closes in closes_by_coin.items():
        dates = (dates_by_coin or {}).get(coin) or [start + dt.timedelta(i) for i in range(len(closes))]
        for d, c in zip(dates, closes):
            rows.append((coin, coin.upper(), d, float(c), float(c), float(c), float(c), float(c), 1.0, 1.0, 1))
    return spark.createDataFrame(rows, "coin_id string, coin_symbol string, event_date date, open_price_usd double, "
                                       "close_price_usd double, avg_price_usd double, max_price_usd double, "
                                       "min_price_usd double, volume_usd double, market_cap_usd double, "
                                       "samples_per_day long")


def col_list(df, c, order="event_date"):
    return [r[c] for r in df.orderBy(order).collect()]


def test_n1_normalized_global_base(spark):
    m = series_frame(spark, {"a": [10, 20], "b": [30]}, dates_by_coin={"b": [D0 + dt.timedelta(1)]})
    got = {(r["event_date"], r["coin_symbol"], r["value"]) for r in C.normalized(m, ["A", "B"]).collect()}
    assert got == {(D0, "A", 0.0), (D0 + dt.timedelta(1), "A", 100.0), (D0, "B", None), (D0 + dt.timedelta(1), "B", None)}


def test_c1_correlation(spark):
    m = series_frame(spark, {"a": [1, 2, 3], "b": [2, 4, 6], "k": [5, 5, 5]})
    got = {(r["symbol_a"], r["symbol_b"]): r["corr"] for r in C.correlation(m, ["A", "B", "K"]).collect()}
    assert got[("A", "B")] == pytest.approx(1.0) and got[("B", "A")] == pytest.approx(1.0)
    assert got[("A", "K")] is None and got[("K", "K")] is None
    assert got[("A", "A")] == pytest.approx(1.0)


def test_l1_trend_label(spark):
    df = spark.createDataFrame([(100.0, 102.0), (100.0, 102.01), (100.0, 98.0), (100.0, 97.99), (100.0, None)],
                               "c double, f double")
    got = [r[0] for r in df.select(trend_label("c", "f", 2.0)).collect()]
    assert got == ["FLAT", "UP", "FLAT", "DOWN", None]


def test_r1_rsi_rising(spark):
    m = series_frame(spark, {"a": list(range(1, 15))})
    rsi = col_list(FT.with_rsi(m), "rsi_14")
    assert rsi[:13] == [None] * 13 and rsi[13] == 100.0


def test_r2_rsi_flat(spark):
    m = series_frame(spark, {"a": [5] * 20})
    assert col_list(FT.with_rsi(m), "rsi_14") == [None] * 20


def test_m1_moving_average_and_std(spark):
    from pricebars.functions.exprs import rolling_mean, rolling_std, series_window

    m = series_frame(spark, {"a": [1, 2, 4, 8]})
    df = m.select("event_date", rolling_mean("close_price_usd", series_window(), 3).alias("ma"),
                  rolling_std("close_price_usd", series_window(), 3).alias("sd"))
    ma, sd = col_list(df, "ma"), col_list(df, "sd")
    assert ma[:2] == [None, None] and ma[2:] == pytest.approx([2.3333333, 4.6666667])
    assert sd[:2] == [None, None] and sd[2:] == pytest.approx([1.5275252, 3.0550505])


def test_w1_calendar(spark):
    m = series_frame(spark, {"a": [1]})
    r = m.select(*FT.calendar_features()).collect()[0]
    assert (r["day_of_week"], r["month"], r["day_of_month"]) == (0, 1, 1)


def test_k1_kpi(spark):
    m = series_frame(spark, {"a": [100, 110], "b": [50]})
    got = {r["coin_id"]: (r["price_delta"], r["price_pct"]) for r in S.kpi(m).collect()}
    assert got["a"] == (10.0, pytest.approx(10.0)) and got["b"] == (0.0, 0.0)


def test_s1_sentiment_band(spark):
    df = spark.createDataFrame([(v,) for v in (24, 25, 49, 50, 74, 75)], "v int")
    assert [r[0] for r in df.select(sentiment_band("v")).collect()] == [0, 1, 1, 2, 2, 3]


def test_t1_chrono_split(spark):
    m = series_frame(spark, {"a": list(range(10))})
    got = col_list(M.chrono_split(m, 0.2), "split")
    assert got == ["train"] * 8 + ["test"] * 2
    gapped = col_list(M.chrono_split(m, 0.2, gap=2), "split")
    assert gapped == ["train"] * 6 + ["test"] * 2


def test_current_prices_global_last_date(spark):
    m = series_frame(spark, {"a": [1, 2], "b": [7]})
    assert {(r["metric"], r["value"]) for r in S.current_prices(m).collect()} == {("A", 2.0)}


def test_standardize_zero_std_scales_by_one(spark):
    df = spark.createDataFrame([("a", "train", 3.0), ("a", "train", 3.0), ("a", "test", 5.0)],
                               "coin_id string, split string, x double")
    out = M.standardize(df, M.scaler_stats(df, ["x"]), ["x"])
    assert sorted(r["x"] for r in out.collect()) == [0.0, 0.0, 2.0]


def test_lag_lead_inverse(spark):
    m = series_frame(spark, {"a": [3, 1, 4, 1, 5, 9, 2, 6]})
    df = m.select("event_date", "close_price_usd", *FT.lag_features(lags=[1]), *FT.target_features(horizons=[1]))
    rows = df.orderBy("event_date").collect()
    for prev, cur in zip(rows, rows[1:]):
        assert cur["price_lag_1"] == prev["close_price_usd"] and prev["target_1d"] == cur["close_price_usd"]


def test_feature_counts(spark):
    m = series_frame(spark, {"a": list(range(1, 80))})
    assert len(FT.feature_columns(FT.price_features(m), "price")) == 47
    assert len(FT.feature_columns(FT.trend_features(m), "trend")) == 48


def test_regression_metrics_formulas(spark):
    df = spark.createDataFrame([("a", "test", 1.0, 1.5), ("a", "test", 2.0, 2.0), ("a", "test", 3.0, 2.0)],
                               "coin_id string, split string, label double, prediction double")
    r = M.regression_metrics(df).collect()[0]
    assert r["mae"] == pytest.approx(0.5) and r["rmse"] == pytest.approx((1.25 / 3) ** 0.5)
    assert r["r2"] == pytest.approx(1 - (1.25 / 3) / (2 / 3))
    assert r["mape"] == pytest.approx((0.5 + 0 + 1 / 3) / 3 * 100)


def test_m9_label_index_alphabetical(spark):
    df = spark.createDataFrame([("UP",), ("UP",), ("FLAT",), ("DOWN",), ("UP",)], "trend_label string")
    got = {(r["trend_label"], r["label"]) for r in M.label_indexer(df).transform(df).collect()}
    assert got == {("DOWN", 0.0), ("FLAT", 1.0), ("UP", 2.0)}


def test_p9_processed_at_stamp(spark):
    from pricebars.operators.bars import daily_metrics
    from pricebars.sources import testdata as TD

    m = daily_metrics(TD.event_payloads(TD.table(spark, "/root/testdata/sf0.001", "events")))
    assert m.where("processed_at IS NULL").count() == 0


def test_forecast_wrappers_on_small_data(spark):
    from pricebars.sources import testdata as TD

    metrics = TD.order_metrics(spark, "/root/testdata/sf0.001").where("coin_id IN ('1-URGENT', '2-HIGH')")
    fc, fit = M.forecast_trend(metrics, 7, 2.0, max_iter=1, max_depth=2)
    rows = fc.collect()
    assert len(rows) == 2
    for r in rows:
        assert r["trend"] in ("DOWN", "FLAT", "UP")
        assert abs(r["p_down"] + r["p_flat"] + r["p_up"] - 1.0) < 1e-9
        assert r["confidence"] == max(r["p_down"], r["p_flat"], r["p_up"])
    assert {r["split"] for r in fit.metrics.collect()} == {"train", "test"}
    acc, grid, classes = M.trend_metrics(fit.scored)
    tests = fit.scored.where("split = 'test'").count()
    assert grid.count() == 6 and sum(r["pred_down"] + r["pred_flat"] + r["pred_up"] for r in grid.collect()) == tests
    assert sum(r["n"] for r in classes.collect()) == tests
    assert sum(r["importance"] for r in fit.importance(None).collect()) == pytest.approx(1.0)
    out, price_fit = M.train_and_predict(metrics, target_days=7, max_iter=1)
    assert {r["split"] for r in price_fit.metrics.collect()} == {"train", "test"}
    price = out.collect()
    assert len(price) == 2 and all(r["prediction"] is not None and r["confidence"] is not None for r in price)


def test_short_series_gets_null_forecast(spark):
    from pricebars.sources import testdata as TD

    m = TD.order_metrics(spark, "/root/testdata/sf0.001")
    long_coin = m.where("coin_id = '1-URGENT'")
    short_coin = m.where("coin_id = '2-HIGH'").orderBy("event_date").limit(55)
    both = long_coin.unionByName(short_coin)
    out, _ = M.forecast_price(both, horizons=(1,), max_iter=1, max_depth=2)
    got = {r["coin_id"]: r["prediction"] for r in out.collect()}
    assert got["1-URGENT"] is not None and got["2-HIGH"] is None
    trend = {r["coin_id"]: r["trend"] for r in M.forecast_trend(both, max_iter=1, max_depth=2)[0].collect()}
    assert trend["1-URGENT"] is not None and trend["2-HIGH"] is None


def test_in_range_filters_before_features(spark):
    m = series_frame(spark, {"a": list(range(1, 41))})
    cut = M.in_range(m, D0 + dt.timedelta(10), D0 + dt.timedelta(29))
    assert cut.count() == 20
    lags = col_list(cut.select("event_date", *FT.lag_features(lags=[1])), "price_lag_1")
    assert lags[0] is None  # the look-back starts inside the range


def test_correlation_chunks_equal_single_aggregate(spark, monkeypatch):
    rows = {f"s{k}": [float((d * (k + 1)) % 7 + d) for d in range(20)] for k in range(5)}
    m = series_frame(spark, rows)
    syms = [f"S{k}" for k in range(5)]
    whole = {(r[0], r[1]): r[2] for r in C.correlation(m, syms).collect()}
    monkeypatch.setattr(C, "PAIRS_PER_AGGREGATE", 4)
    chunked = {(r[0], r[1]): r[2] for r in C.correlation(m, syms).collect()}
    assert len(whole) == 25 and whole == chunked


def test_labels_partition_labelled_rows(spark):
    from pricebars.sources import testdata as TD

    lab = FT.trend_labels(TD.order_metrics(spark, "/root/testdata/sf0.001"), 7, 2.0)
    counts = {r["trend_label"]: r["count"] for r in lab.groupBy("trend_label").count().collect()}
    with_future = lab.where("future_price IS NOT NULL").count()
    assert set(counts) == {"DOWN", "FLAT", "UP", None}
    assert counts["DOWN"] + counts["FLAT"] + counts["UP"] == with_future
    assert counts[None] == lab.count() - with_future == 5 * 7
