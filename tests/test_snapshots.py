"""Snapshot tables: one-rename commits, merge versions, both refresh streams."""

import datetime as dt
import json

import pytest

from pricebars.schemas import DAILY_METRICS, SENTIMENT
from pricebars.sources import snapshots
from pricebars.sources import tables as TB
from pricebars.sources.payloads import in_parts, read_payloads, split_rejects
from pricebars.streaming.refresh import refresh_batch, refresh_run, refresh_stream

D = dt.date(2024, 1, 1)
DAY_MS = 24 * 3600 * 1000
START = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)


def row(coin, day, close):
    return (coin, coin.upper(), coin, day, close, close, close, close, close, 1.0, 2.0, 1, None)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), DAILY_METRICS)


def closes(df):
    return {(r["coin_id"], r["event_date"]): r["close_price_usd"] for r in df.collect()}


def test_a_job_that_ends_before_the_rename_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    TB.write_metrics(frame(spark, row("a", D, 1.0), row("b", D, 2.0)), path)
    before = closes(TB.read_metrics(spark, path))

    def ended(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(snapshots, "publish", ended)  # all data is written, the commit is not
    with pytest.raises(KeyboardInterrupt):
        TB.upsert_metrics_table(spark, path, frame(spark, row("a", D, 9.0)))
    with pytest.raises(KeyboardInterrupt):
        TB.upsert_sentiment_table(spark, str(tmp_path / "s"), spark.createDataFrame(
            [(D, 1, "x", 0, 0)], "event_date date, value int, value_classification string, part long, pos int"))
    monkeypatch.undo()
    assert closes(TB.read_metrics(spark, path)) == before and not snapshots.exists(spark, str(tmp_path / "s"))
    TB.upsert_metrics_table(spark, path, frame(spark, row("a", D, 9.0)))
    assert closes(TB.read_metrics(spark, path)) == {("a", D): 9.0, ("b", D): 2.0}


def test_old_versions_stay_readable_until_collected(spark, tmp_path):
    path = str(tmp_path / "t")
    for close in (1.0, 2.0, 3.0):
        TB.write_metrics(frame(spark, row("a", D, close)), path)
    TB.write_metrics(frame(spark, row("b", D, 7.0)), path)
    assert snapshots.versions(spark, path) == [1, 2, 3, 4]
    assert closes(TB.read_metrics(spark, path, version=2)) == {("a", D): 2.0}
    (tmp_path / "t" / "data" / "batch=left-over").mkdir()
    snapshots.collect_old(spark, path, keep=2)
    assert snapshots.versions(spark, path) == [3, 4]
    # the batches of the third and fourth version, and nothing else
    assert len([p for p in (tmp_path / "t" / "data").iterdir()]) == 2
    assert closes(TB.read_metrics(spark, path)) == {("a", D): 3.0, ("b", D): 7.0}
    with pytest.raises(Exception):
        TB.read_metrics(spark, path, version=1).collect()


def test_the_second_of_two_writers_conflicts_and_runs_again(spark, tmp_path):
    path = str(tmp_path / "t")
    TB.write_metrics(frame(spark, row("a", D, 1.0)), path)
    base = snapshots.latest(spark, path)
    TB.write_metrics(frame(spark, row("b", D, 2.0)), path)
    with pytest.raises(snapshots.Conflict):
        snapshots.replace(spark, path, TB._versioned(frame(spark, row("c", D, 3.0)), TB.F.lit(None)), "coin_id", base=base)
    assert closes(TB.read_metrics(spark, path)) == {("a", D): 1.0, ("b", D): 2.0}
    calls = []

    def change(at):  # another job commits while the first attempt runs
        calls.append(at)
        if len(calls) == 1:
            TB.write_metrics(frame(spark, row("d", D, 4.0)), path)
        snapshots.replace(spark, path, TB._versioned(frame(spark, row("c", D, 3.0)), TB.F.lit(None)), "coin_id", base=at)

    TB._from_newest(spark, path, change)
    assert calls == [2, 3] and set(closes(TB.read_metrics(spark, path))) == {(c, D) for c in "abcd"}


def test_names_like_numbers_and_empty_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    TB.write_metrics(frame(spark, row("007", D, 1.0), row("7", D, 2.0)), path)
    TB.write_metrics(frame(spark, row("7", D, 3.0)), path)
    TB.write_metrics(frame(spark), path)
    assert closes(TB.read_metrics(spark, path)) == {("007", D): 1.0, ("7", D): 3.0}
    with pytest.raises(FileNotFoundError):
        TB.read_metrics(spark, str(tmp_path / "none"))
    assert SENTIMENT.fieldNames()[0] == "event_date"


def pull(base, days):
    return {"prices": [[START + d * DAY_MS, base + d] for d in days]}


def test_any_order_of_batches_gives_the_table_of_one(spark, write_json, tmp_path):
    files = {"bitcoin_2024-01-05.json": pull(100, range(0, 4)), "bitcoin_2024-01-06.json": pull(200, range(1, 5)),
             "bitcoin_2024-01-07.json": pull(300, range(2, 6)), "solana_2024-01-06.json": pull(5, range(0, 3))}
    refresh_batch(spark, write_json(files, "all"), str(tmp_path / "one"))
    want = closes(TB.read_metrics(spark, str(tmp_path / "one")))
    assert want["bitcoin", D] == 100 and want["bitcoin", D + dt.timedelta(1)] == 201 and want["bitcoin", D + dt.timedelta(2)] == 302
    for order in ([2, 0, 1, 3], [1, 3, 2, 0]):
        run = "".join(map(str, order))
        table = str(tmp_path / f"t{run}")
        for k in order:
            name = list(files)[k]
            refresh_batch(spark, write_json({name: files[name]}, f"f{run}-{k}"), table)
        assert closes(TB.read_metrics(spark, table)) == want


def test_arrays_are_cut_into_parts_that_roll_up_alike(spark):
    pairs = [[float(START + k * 3600_000), float(k)] for k in range(50)]
    raw = spark.createDataFrame([("bitcoin_2024-01-05.json", pairs, pairs[:20], None, None), ("x.json", pairs, None, None, None)],
                                "file_name string, prices array<array<double>>, market_caps array<array<double>>, "
                                "total_volumes array<array<double>>, _corrupt_record string")
    tagged = in_parts(raw, size=8)
    good, rejects = split_rejects(tagged)
    parts = sorted(good.collect(), key=lambda r: r["part"])
    assert [r["part"] for r in parts] == list(range(7)) and [p for r in parts for p in r["prices"]] == pairs
    assert [p for r in parts for p in r["market_caps"]] == pairs[:20]
    assert [(r["file_name"], r["reason"]) for r in rejects.collect()] == [("x.json", "unrecognised file name")]


def test_each_file_is_parsed_once(spark, write_json):
    raw = write_json({"bitcoin_2024-01-05.json": pull(1, range(3)), "solana_2024-01-05.json": "{oops"})
    good, rejects = read_payloads(spark, raw)
    # both sides read the staged rows: the files may go
    for name in ("bitcoin_2024-01-05.json", "solana_2024-01-05.json"):
        open(f"{raw}/{name}", "w").write("")
    assert good.count() == 1 and [r["reason"] for r in rejects.collect()] == ["malformed json"]


def test_files_of_many_lines_are_one_row(spark, write_json, tmp_path):
    text = json.dumps(pull(1, range(40)), indent=2)
    raw = write_json({"bitcoin_2024-01-05.json": text})
    good, rejects = read_payloads(spark, raw)
    assert [len(r["prices"]) for r in good.collect()] == [40] and rejects.isEmpty()
    TB.land_raw(spark, raw, str(tmp_path / "log"))
    assert [r["payload"] for r in TB.read_raw(spark, str(tmp_path / "log")).collect()] == [text]


def mood(day, value):
    return {"data": [{"timestamp": str((START + day * DAY_MS) // 1000), "value": str(value), "value_classification": "Fear"}]}


def test_both_streams_resume_and_load_each_file_once(spark, write_json, tmp_path):
    where = dict(table_path=str(tmp_path / "m"), sentiment_table=str(tmp_path / "s"), checkpoint=str(tmp_path / "c"),
                 raw_log=str(tmp_path / "log"), rejects_path=str(tmp_path / "rejects"))
    raw = write_json({"bitcoin_2024-01-04.json": pull(100, range(2))}, "raw")
    moods = write_json({"a.json": mood(0, 10)}, "moods")
    refresh_run(spark, raw, sentiment_dir=moods, **where)
    versions = snapshots.versions(spark, where["sentiment_table"])
    refresh_run(spark, raw, sentiment_dir=moods, **where)  # nothing new: nothing loaded
    assert snapshots.versions(spark, where["sentiment_table"]) == versions
    write_json({"bitcoin_2024-01-05.json": pull(200, range(1, 3))}, "raw")
    write_json({"b.json": mood(1, 20)}, "moods")
    refresh_run(spark, raw, sentiment_dir=moods, **where)
    assert closes(TB.read_metrics(spark, where["table_path"])) == {("bitcoin", D): 100, ("bitcoin", D + dt.timedelta(1)): 201,
                                                                   ("bitcoin", D + dt.timedelta(2)): 202}
    got = {(r["event_date"], r["value"]) for r in TB.read_sentiment_table(spark, where["sentiment_table"]).collect()}
    assert got == {(D, 10), (D + dt.timedelta(1), 20)}
    log = TB.read_raw(spark, where["raw_log"])
    assert log.count() == 2 and json.loads(TB.latest_raw(log).where("logical_date = '2024-01-05'").first()["payload"]) == pull(200, range(1, 3))


def test_a_stream_that_failed_after_its_commit_replays_without_change(spark, write_json, tmp_path, monkeypatch):
    raw = write_json({"bitcoin_2024-01-04.json": pull(100, range(2))}, "raw")
    table, mark = str(tmp_path / "m"), str(tmp_path / "c")
    from pricebars.streaming import refresh as R

    real = R.load_good_payloads

    def then_fail(*args):
        real(*args)
        raise ValueError("lost after the commit")

    monkeypatch.setattr(R, "load_good_payloads", then_fail)
    with pytest.raises(Exception):
        refresh_stream(spark, raw, table, mark).awaitTermination()
    monkeypatch.undo()
    once = closes(TB.read_metrics(spark, table))
    refresh_stream(spark, raw, table, mark).awaitTermination()
    assert closes(TB.read_metrics(spark, table)) == once and len(once) == 2


def test_latest_raw_keeps_the_text_out_of_the_aggregate(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([("a", D, "old"), ("a", D, "new"), ("b", None, "x"), (None, None, "y")],
                                 "coin_id string, logical_date date, payload string")
    for k in range(4):
        TB.append_raw(rows.where("payload = 'old'" if k == 0 else "payload <> 'old'"), path)
    latest = TB.latest_raw(TB.read_raw(spark, path))
    assert sorted((r["coin_id"] or "", r["payload"]) for r in latest.collect()) == [("", "y"), ("a", "new"), ("b", "x")]
    plan = latest._jdf.queryExecution().optimizedPlan().toString()
    assert all("payload" not in line for line in plan.splitlines() if "Aggregate" in line)
