"""Batch and streaming refresh of the daily metrics table."""

import datetime as dt

import pytest

from pricebars.sources.tables import read_metrics, read_sentiment_table
from pricebars.streaming.refresh import refresh_batch, refresh_stream

D1 = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
DAY = 24 * 3600 * 1000


def payload(base, n=3):
    return {"prices": [[D1 + i * DAY, base + i] for i in range(n)],
            "total_volumes": [[D1 + i * DAY, 10.0 * (i + 1)] for i in range(n)]}


def table_rows(spark, path):
    df = read_metrics(spark, path)
    return sorted((r["coin_id"], r["coin_symbol"], r["event_date"], r["close_price_usd"], r["volume_usd"])
                  for r in df.collect())


def test_batch_refresh_and_rejects(spark, write_json, tmp_path):
    raw = write_json({"bitcoin_2024-01-04.json": payload(100), "solana_2024-01-04.json": payload(5),
                      "dogecoin_2024-01-04.json": payload(1), "cardano_2024-01-04.json": "{oops"})
    table = str(tmp_path / "metrics")
    rejects = refresh_batch(spark, raw, table, raw_log=str(tmp_path / "rawlog"))
    assert spark.read.parquet(str(tmp_path / "rawlog")).count() == 4
    assert {r["reason"] for r in rejects.collect()} == {"malformed json", "unknown coin"}
    rows = table_rows(spark, table)
    assert len(rows) == 6 and {r[0] for r in rows} == {"bitcoin", "solana"}
    # re-running the same files changes nothing
    refresh_batch(spark, raw, table)
    assert table_rows(spark, table) == rows


def test_empty_input_raises(spark, write_json, tmp_path):
    raw = write_json({"bitcoin_2024-01-04.json": {"prices": []}})
    with pytest.raises(ValueError):
        refresh_batch(spark, raw, str(tmp_path / "metrics"))


def test_stream_two_runs_equal_one_batch(spark, write_json, tmp_path):
    table_s, table_b = str(tmp_path / "stream"), str(tmp_path / "batch")
    first = {"bitcoin_2024-01-04.json": payload(100), "solana_2024-01-04.json": payload(5)}
    second = {"bitcoin_2024-01-05.json": payload(200, 4)}
    raw = write_json(first, "landing")
    refresh_stream(spark, raw, table_s, checkpoint=str(tmp_path / "ckpt")).awaitTermination()
    write_json(second, "landing")
    refresh_stream(spark, raw, table_s, checkpoint=str(tmp_path / "ckpt")).awaitTermination()
    refresh_batch(spark, raw, table_b)
    assert table_rows(spark, table_s) == table_rows(spark, table_b)
    assert len(table_rows(spark, table_s)) == 7


def test_overlapping_pulls_in_one_batch_equal_two_batches(spark, write_json, tmp_path):
    old, new = payload(100, 5), {k: [[ms + DAY, v + 1] for ms, v in rows] for k, rows in payload(200, 5).items()}
    one = write_json({"bitcoin_2024-01-05.json": old, "bitcoin_2024-01-06.json": new}, "one")
    refresh_batch(spark, one, str(tmp_path / "t1"))
    for name, content in (("bitcoin_2024-01-05.json", old), ("bitcoin_2024-01-06.json", new)):
        refresh_batch(spark, write_json({name: content}, name), str(tmp_path / "t2"))
    rows = table_rows(spark, str(tmp_path / "t1"))
    assert rows == table_rows(spark, str(tmp_path / "t2")) and len(rows) == 6
    assert [r[3] for r in rows] == [100.0, 201.0, 202.0, 203.0, 204.0, 205.0]


def test_plain_session_keeps_other_coins_and_utc_days(spark, write_json, tmp_path):
    table = str(tmp_path / "metrics")
    plain = spark.newSession()
    plain.conf.set("spark.sql.session.timeZone", "America/New_York")
    plain.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    refresh_batch(plain, write_json({"bitcoin_2024-01-04.json": payload(1), "solana_2024-01-04.json": payload(5)}, "a"), table)
    refresh_batch(plain, write_json({"bitcoin_2024-01-05.json": {"prices": [[D1 + DAY + 3600_000, 9.0]]}}, "b"), table)
    rows = table_rows(plain, table)
    assert len(rows) == 6 and ("bitcoin", "BTC", dt.date(2024, 1, 2), 9.0, 0.0) in rows


def test_tick_out_of_range_is_reported_and_blocks_nothing(spark, write_json, tmp_path):
    odd = payload(100)
    odd["prices"].append([D1 * 1000, 7.0])
    raw = write_json({"bitcoin_2024-01-04.json": odd, "solana_2024-01-04.json": payload(5), "notes.json": payload(1)})
    rejects = refresh_batch(spark, raw, str(tmp_path / "metrics"), raw_log=str(tmp_path / "log"))
    assert {(r["coin_id"], r["reason"]) for r in rejects.collect()} == {("bitcoin", "tick time out of range"), (None, "unrecognised file name")}
    assert len(table_rows(spark, str(tmp_path / "metrics"))) == 6 and spark.read.parquet(str(tmp_path / "log")).count() == 3


def test_refresh_loads_sentiment_and_reports_unknown_coins(spark, write_json, tmp_path):
    day = 1704067200000  # 2024-01-01 UTC
    raw = write_json({"bitcoin_2024-01-02.json": {"prices": [[day, 1.0]]}, "othercoin_2024-01-02.json": {"prices": [[day, 2.0]]}})
    moods = write_json({"mood.json": {"data": [{"timestamp": str(day // 1000), "value": "40", "value_classification": "Fear"}]}}, "moods")
    table, mood_table = str(tmp_path / "metrics"), str(tmp_path / "mood")
    for _ in range(2):  # a second run changes nothing
        rejects = refresh_batch(spark, raw, table, sentiment=(moods, mood_table)).collect()
        assert [(r["file_name"], r["reason"]) for r in rejects] == [("othercoin_2024-01-02.json", "unknown coin")]
        assert [r["coin_id"] for r in read_metrics(spark, table).collect()] == ["bitcoin"]
        assert [(str(r["event_date"]), r["value"]) for r in read_sentiment_table(spark, mood_table).collect()] == [("2024-01-01", 40)]

def test_pulls_land_in_few_files(spark, tmp_path, monkeypatch):
    from pricebars.plans import catalog

    monkeypatch.setattr(catalog.TB, "staging_path", lambda spark, name: str(tmp_path / name))
    spark.range(0, 40 * 1024, 8).selectExpr(
        "id AS event_id", "id % 7 AS user_id", "concat('c/', cast(id % 3 AS string)) AS event_type",
        "cast(id AS double) AS value", "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, id) AS ts").write.parquet(str(tmp_path / "events.parquet"))
    rows = catalog.QUERIES["refresh_pulls"](spark, str(tmp_path)).collect()
    assert {(r["coin_id"], r["coin_symbol"]) for r in rows} == {(f"c/{k}", f"C/{k}") for k in range(3)}
    assert sum(r["samples_per_day"] for r in rows) > 0
    landed = [p for p in (tmp_path / "pulls" / "raw").rglob("part-*")]
    assert 0 < len(landed) <= 16  # 120 pulls: no file for each
