"""Payload reading and the daily roll-up (FIXTURES B1-B8)."""

import datetime as dt

from pricebars.operators.bars import bars_from_enriched, daily_bars, daily_metrics, tick_open_close
from pricebars.operators.ticks import price_ticks
from pricebars.operators.bars import pulled_metrics
from pricebars.sources.payloads import read_payloads

D1 = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
H = 3600 * 1000
DAY = 24 * H


def rows(df, *cols):
    return {tuple(r[c] for c in cols) for r in df.collect()}


def metrics_of(spark, write_json, payloads: dict):
    good, rejects = read_payloads(spark, write_json(payloads))
    return daily_metrics(good), rejects


def test_b1_open_close_avg(spark, write_json):
    p = {"prices": [[D1, 10], [D1 + 12 * H, 14], [D1 + DAY - 1, 12], [D1 + DAY, 20]]}
    m, _ = metrics_of(spark, write_json, {"bitcoin_2024-01-02.json": p})
    got = rows(m, "event_date", "open_price_usd", "close_price_usd", "avg_price_usd", "max_price_usd",
               "min_price_usd", "samples_per_day", "volume_usd", "market_cap_usd")
    assert got == {(dt.date(2024, 1, 1), 10.0, 12.0, 12.0, 14.0, 10.0, 3, 0.0, 0.0),
                   (dt.date(2024, 1, 2), 20.0, 20.0, 20.0, 20.0, 20.0, 1, 0.0, 0.0)}


def test_b2_sub_second_order(spark, write_json):
    p = {"prices": [[D1 + 900, 7], [D1 + 100, 5]]}
    m, _ = metrics_of(spark, write_json, {"bitcoin_2024-01-02.json": p})
    assert rows(m, "open_price_usd", "close_price_usd") == {(5.0, 7.0)}


def test_b3_same_ms_array_position(spark, write_json):
    p = {"prices": [[D1, 5], [D1, 7]]}
    m, _ = metrics_of(spark, write_json, {"bitcoin_2024-01-02.json": p})
    assert rows(m, "open_price_usd", "close_price_usd") == {(5.0, 7.0)}


def test_b4_null_and_short_pairs_dropped(spark, write_json):
    p = '{"prices": [[%d, null], [%d], [%d, 3.0]]}' % (D1, D1 + 1, D1 + 2)
    m, _ = metrics_of(spark, write_json, {"bitcoin_2024-01-02.json": p})
    assert rows(m, "open_price_usd", "samples_per_day") == {(3.0, 1)}


def test_b5_b6_b7_volume_rules(spark, write_json):
    p = {"prices": [[D1, 1.0]],
         "total_volumes": [[D1, 10.0], [D1 + 1, None], [D1 + 2, 20.0], [D1 + DAY, 99.0]]}
    m, _ = metrics_of(spark, write_json, {"bitcoin_2024-01-02.json": p})
    # one day only (volume-only day is dropped), NULL volume skipped, no caps -> 0
    assert rows(m, "event_date", "volume_usd", "market_cap_usd") == {(dt.date(2024, 1, 1), 15.0, 0.0)}


def test_b8_bad_files_do_not_block(spark, write_json):
    files = {"bitcoin_2024-01-02.json": {"prices": [[D1, 1.0]]},
             "ethereum_2024-01-02.json": {"prices": []},
             "solana_2024-01-02.json": "{not json",
             "cardano_2024-01-02.json": {"prices": [[D1, None]]}}
    good, rejects = read_payloads(spark, write_json(files))
    assert rows(good, "coin_id") == {("bitcoin",)}
    assert {r["coin_id"] or r["file_name"].split("_")[0] for r in rejects.collect()} == {
        "ethereum", "solana", "cardano"}
    assert rows(daily_metrics(good), "coin_id", "open_price_usd") == {("bitcoin", 1.0)}


def test_file_name_gives_coin_and_date(spark, write_json):
    good, _ = read_payloads(spark, write_json({"binancecoin_2024-03-05.json": {"prices": [[D1, 1.0]]}}))
    assert rows(good, "coin_id", "logical_date", "part") == {("binancecoin", dt.date(2024, 3, 5), 0)}


def test_newest_pull_decides_a_day(spark, write_json):
    files = {"bitcoin_2024-01-02.json": {"prices": [[D1, 1.0]]},
             "bitcoin_2024-01-03.json": {"prices": [[D1, 2.0]]}}
    good, _ = read_payloads(spark, write_json(files))
    assert rows(pulled_metrics(good), "open_price_usd") == {(2.0,)}


def test_window_form_equals_aggregate_form(spark):
    from pricebars.sources import testdata as TD

    payloads = TD.event_payloads(TD.table(spark, "/root/testdata/sf0.001", "events"))
    ticks = price_ticks(payloads)
    from pricebars.functions.exprs import round_doubles

    a = round_doubles(daily_bars(ticks), 9)
    b = round_doubles(bars_from_enriched(tick_open_close(ticks)), 9)
    cols = a.columns
    assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0
    assert b.select(*cols).exceptAll(a.select(*cols)).count() == 0


def test_bar_invariants(spark):
    from pyspark.sql import functions as F

    from pricebars.sources import testdata as TD

    m = daily_metrics(TD.event_payloads(TD.table(spark, "/root/testdata/sf0.001", "events")))
    bad = m.where(~((F.col("min_price_usd") <= F.col("open_price_usd")) & (F.col("open_price_usd") <= F.col("max_price_usd"))
                    & (F.col("min_price_usd") <= F.col("close_price_usd")) & (F.col("close_price_usd") <= F.col("max_price_usd"))
                    & (F.col("min_price_usd") <= F.col("avg_price_usd") + 1e-9)
                    & (F.col("avg_price_usd") <= F.col("max_price_usd") + 1e-9)))
    assert bad.count() == 0
