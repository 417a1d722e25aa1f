"""Upserts, table round trips, raw log, sentiment, fallback and CSV (FIXTURES U1-U3)."""

import datetime as dt

from pyspark.sql import functions as F

from pricebars.operators.upsert import latest_per_key, upsert
from pricebars.schemas import DAILY_METRICS, SENTIMENT
from pricebars.sources import tables as TB
from pricebars.sources.sentiment import read_sentiment

KEY, KEEP = ["coin_id", "event_date"], ["coin_symbol", "coin_name"]
D = dt.date(2024, 1, 1)


def metric_row(coin, day, symbol, close, volume=1.0):
    return (coin, symbol, symbol.lower(), day, close, close, close, close, close, volume, 2.0, 1, None)


def frame(spark, rows):
    return spark.createDataFrame(rows, DAILY_METRICS)


def as_set(df, *cols):
    return {tuple(r[c] for c in cols) for r in df.collect()}


def test_u1_idempotent(spark):
    old = frame(spark, [metric_row("bitcoin", D, "BTC", 1.0)])
    new = frame(spark, [metric_row("bitcoin", D, "BTC", 2.0), metric_row("bitcoin", D + dt.timedelta(1), "BTC", 3.0)])
    once = upsert(old, new, KEY, KEEP)
    twice = upsert(once, new, KEY, KEEP)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    assert as_set(once, "event_date", "close_price_usd") == {(D, 2.0), (D + dt.timedelta(1), 3.0)}


def test_u2_symbol_kept_metrics_replaced(spark):
    old = frame(spark, [metric_row("bitcoin", D, "OLD", 1.0)])
    new = frame(spark, [metric_row("bitcoin", D, "NEW", 5.0)])
    assert as_set(upsert(old, new, KEY, KEEP), "coin_symbol", "close_price_usd") == {("OLD", 5.0)}


def test_u3_incoming_null_wins(spark):
    old = frame(spark, [metric_row("bitcoin", D, "BTC", 1.0, volume=7.0)])
    new = frame(spark, [metric_row("bitcoin", D, "BTC", 1.0, volume=None)])
    assert as_set(upsert(old, new, KEY, KEEP), "volume_usd") == {(None,)}


def test_table_upsert_rewrites_touched_coins_only(spark, tmp_path):
    path = str(tmp_path / "metrics")
    TB.write_metrics(frame(spark, [metric_row("bitcoin", D, "BTC", 1.0), metric_row("solana", D, "SOL", 9.0)]), path)
    TB.upsert_metrics_table(spark, path, frame(spark, [metric_row("bitcoin", D, "NEW", 2.0),
                                                        metric_row("bitcoin", D + dt.timedelta(1), "NEW", 3.0)]))
    got = TB.read_metrics(spark, path)
    assert as_set(got, "coin_id", "event_date", "coin_symbol", "close_price_usd") == {
        ("bitcoin", D, "BTC", 2.0), ("bitcoin", D + dt.timedelta(1), "NEW", 3.0), ("solana", D, "SOL", 9.0)}


def test_latest_per_key_last_write_wins(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (2, "c", 1)], "k int, v string, seq int")
    assert as_set(latest_per_key(df, ["k"], ["seq"]), "k", "v") == {(1, "b"), (2, "c")}


def test_raw_log_append_and_latest(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = spark.createDataFrame([("bitcoin", D, '{"v": 1}')], "coin_id string, logical_date date, payload string")
    TB.append_raw(rows, path)
    TB.append_raw(rows.withColumn("payload", F.lit('{"v": 2}')), path)
    log = TB.read_raw(spark, path)
    assert log.count() == 2
    assert TB.latest_raw(log).count() == 1


def test_sentiment_reader_defaults_and_rejects(spark, write_json):
    ts = int(dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc).timestamp())
    payload = {"data": [{"timestamp": str(ts), "value": "24", "value_classification": "Fear"},
                        {"timestamp": str(ts + 60), "value": "30", "value_classification": "Fear"},
                        {"value": "x"}, {}]}
    points, rejects = read_sentiment(spark, write_json({"fng.json": payload}, "fng"))
    assert as_set(points, "event_date", "value") == {(D, 24), (D, 30), (dt.date(1970, 1, 1), 0)}
    assert rejects.count() == 1
    empty = spark.createDataFrame([], SENTIMENT)
    table = TB.upsert_sentiment(empty, points)
    assert as_set(table, "event_date", "value") == {(D, 30), (dt.date(1970, 1, 1), 0)}


def test_sentiment_upsert_keeps_inserted_at(spark):
    stamp = dt.datetime(2020, 1, 1)
    old = spark.createDataFrame([(D, 10, "Fear", stamp)], SENTIMENT)
    pts = spark.createDataFrame([(D, 60, "Greed", 0, 0)],
                                "event_date date, value int, value_classification string, part long, pos int")
    got = TB.upsert_sentiment(old, pts).collect()[0]
    assert (got["value"], got["value_classification"], got["inserted_at"]) == (60, "Greed", stamp)


def test_first_non_empty(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2,)], "x int")
    assert as_set(TB.first_non_empty(a, b), "x") == {(1,)}
    assert as_set(TB.first_non_empty(a.where("x > 5"), b), "x") == {(2,)}


def test_csv_export_has_header(spark, tmp_path):
    path = str(tmp_path / "csv")
    TB.export_csv(frame(spark, [metric_row("bitcoin", D, "BTC", 1.0)]), path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == DAILY_METRICS.fieldNames() and back.count() == 1


def test_land_raw_files_and_read_newest(spark, write_json, tmp_path):
    raw = write_json({"bitcoin_2024-01-02.json": {"prices": [[1, 2.0]]}, "solana_2024-01-02.json": {"prices": []}})
    log = str(tmp_path / "rawlog")
    TB.land_raw(spark, raw, log)
    TB.land_raw(spark, raw, log)  # a rerun appends copies; readers see one per key
    got = TB.latest_raw(TB.read_raw(spark, log))
    assert as_set(got, "coin_id", "logical_date") == {("bitcoin", dt.date(2024, 1, 2)), ("solana", dt.date(2024, 1, 2))}
    assert '"prices"' in got.where("coin_id = 'bitcoin'").collect()[0]["payload"]


def test_sentiment_table_upsert(spark, tmp_path):
    path = str(tmp_path / "fng")
    schema = "event_date date, value int, value_classification string, part long, pos int"
    TB.upsert_sentiment_table(spark, path, spark.createDataFrame([(D, 10, "Fear", 0, 0)], schema), exists=False)
    TB.upsert_sentiment_table(spark, path, spark.createDataFrame(
        [(D, 80, "Greed", 1, 0), (D + dt.timedelta(1), 50, "Neutral", 1, 1)], schema))
    assert as_set(TB.read_sentiment_table(spark, path), "event_date", "value") == {(D, 80), (D + dt.timedelta(1), 50)}


def test_first_non_empty_many_sources(spark):
    a, b, c = (spark.createDataFrame([(i,)], "x int") for i in (1, 2, 3))
    assert as_set(TB.first_non_empty(a.where("x > 5"), b.where("x > 5"), c), "x") == {(3,)}
    assert as_set(TB.first_non_empty(a.where("x > 5"), b, c), "x") == {(2,)}


def test_cluster_conf_sizes_partitions():
    from pricebars.session import cluster_conf

    conf = cluster_conf(total_cores=4000, largest_shuffle_bytes=100 * 1024 ** 4, checkpoint_dir="hdfs:///ckpt")
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (256 * 1024 ** 2) + 1
    assert cluster_conf(8, 1e6, "/tmp/x")["spark.sql.shuffle.partitions"] == "24"
