"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver's tables through the stand-ins in
``pricebars.sources.testdata`` and runs the library operators over the whole
tables.  Doubles are rounded to 6 decimals at the very end (comparison hygiene
only; the library returns full precision).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pricebars.functions.exprs import TREND_CLASSES, round_doubles
from pricebars.operators import bars as B
from pricebars.operators import boosting
from pricebars.operators import compare as C
from pricebars.operators import features as FT
from pricebars.operators import modeling as M
from pricebars.operators import serving as S
from pricebars.operators import ticks as TK
from pricebars.operators.upsert import first_per_key, upsert
from pricebars.schemas import PAYLOAD
from pricebars.session import configure, materialize
from pricebars.sources import tables as TB
from pricebars.sources import testdata as TD
from pricebars.sources.payloads import read_payloads, tag_payloads
from pricebars.sources.sentiment import sentiment_points as parse_sentiment
from pricebars.streaming.refresh import load_good_payloads, sentiment_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def run(spark, sf_dir):
        configure(spark)
        return round_doubles(fn(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def _events(spark, sf_dir):
    return TD.table(spark, sf_dir, "events")


def _payloads(spark, sf_dir):
    return TD.event_payloads(_events(spark, sf_dir))


# ---------------------------------------------------------------- stage 1: E


@query
def tick_points(spark, sf_dir):
    t = TK.ticks(_payloads(spark, sf_dir), TK.PRICE, "price_usd")
    return t.select("coin_id", "event_ms", "event_date", "price_usd")


@query
def daily_bars(spark, sf_dir):
    return B.daily_bars(TK.price_ticks(_payloads(spark, sf_dir)))


@query
def open_close_window(spark, sf_dir):
    return B.bars_from_enriched(B.tick_open_close(TK.price_ticks(_payloads(spark, sf_dir))))


@query
def daily_volume(spark, sf_dir):
    pts = TK.ticks(_payloads(spark, sf_dir), TK.VOLUME, "volume", keep_null_values=True)
    return B.daily_mean(pts, "volume", "volume_usd")


@query
def daily_market_cap(spark, sf_dir):
    pts = TK.ticks(_payloads(spark, sf_dir), TK.MARKET_CAP, "market_cap", keep_null_values=True)
    return B.daily_mean(pts, "market_cap", "market_cap_usd")


@query
def daily_metrics(spark, sf_dir):
    return B.daily_metrics(_payloads(spark, sf_dir), processed_at=False)


# ---------------------------------------------------------------- stage 2: tables


COIN = TD.PRIORITIES[0]          # the coin the single-coin reads filter on
UNTOUCHED = "purchase"           # the event type that the table upsert leaves out
RANGE = ("1996-01-01", "1996-12-31")
SERIES_OUT = [c for c in S.SERIES_COLUMNS if c != "processed_at"]


def _metrics(spark, sf_dir):
    return TD.order_metrics(spark, sf_dir)


def _symbols(spark):
    return C.symbols_of(TD.priority_dimension(spark))


@query
def enrich_dim(spark, sf_dir):
    return _metrics(spark, sf_dir)


@query
def scan_parquet(spark, sf_dir):
    path = TB.staging_path(spark, "daily-metrics")
    TB.write_metrics(_metrics(spark, sf_dir), path)
    return TB.read_metrics(spark, path).drop("processed_at")


@query
def fallback_source(spark, sf_dir):
    m = _metrics(spark, sf_dir)
    primary = S.series(m, "bitcoin").drop("processed_at")
    legacy = (S.series(m, COIN)
              .select(F.lit("bitcoin").alias("coin_id"), F.lit("BTC").alias("coin_symbol"),
                      F.lit("Bitcoin").alias("coin_name"), "event_date", "open_price_usd", "close_price_usd",
                      "avg_price_usd", "max_price_usd", "min_price_usd", F.lit(0.0).alias("volume_usd"),
                      F.lit(0.0).alias("market_cap_usd"), "samples_per_day"))
    return TB.first_non_empty(primary, legacy)


def _sentiment_points(spark, sf_dir):
    points, _ = parse_sentiment(TD.event_sentiment_records(_events(spark, sf_dir)))
    return points


@query
def sentiment_points(spark, sf_dir):
    return _sentiment_points(spark, sf_dir).select("event_date", "value", "value_classification")


def _sentiment(spark, sf_dir):
    return S.sentiment_table(_sentiment_points(spark, sf_dir))


@query
def upsert_sentiment(spark, sf_dir):
    """Stored: the first record of each day up to day 20.  Incoming: every record
    from day 15 on; the last of each day wins."""
    pts = _sentiment_points(spark, sf_dir)
    day = F.dayofmonth("event_date")
    stored = (first_per_key(pts.where(day <= 20).select("event_date", "value", "value_classification", "part", "pos"),
                            ["event_date"], ["part", "pos"])
              .select("event_date", "value", "value_classification",
                      F.lit(None).cast("timestamp").alias("inserted_at")))
    merged = TB.upsert_sentiment(stored, pts.where(day >= 15))
    return merged.select("event_date", "value", "value_classification")


@query
def raw_latest(spark, sf_dir):
    """Raw log: one entry per event, keyed by (coin, day); newest by time then id."""
    e = _events(spark, sf_dir)
    log = e.select(F.col("event_type").alias("coin_id"), F.to_date("ts").alias("logical_date"),
                   F.col("props").alias("payload"), F.col("ts").cast("timestamp").alias("inserted_at"),
                   F.col("event_id").alias("seq"))
    return TB.latest_raw(log, tie_breaker="seq").select("coin_id", "logical_date", "payload")


@query
def upsert_daily(spark, sf_dir):
    """Stored: a legacy load of days 1-20 (bars only, volume and cap 0, symbol =
    upper-cased id).  Incoming: a full refresh of days 15-30 (symbol = id).
    Overlap days take the new metrics but keep the stored symbol and name."""
    stored, incoming = _stored_and_incoming(spark, sf_dir)
    return upsert(stored, incoming, TB.METRICS_KEY, TB.METRICS_KEEP)


# ---------------------------------------------------------------- files and tables


@query
def refresh_pulls(spark, sf_dir):
    """JSON payloads of overlapping pulls (1,024 events each, one day apart), loaded
    by the refresh job; of the pulls that hold a day the newest decides it."""
    events = _events(spark, sf_dir)
    folder = TB.staging_path(spark, "pulls")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("part").cast("int"))
    (_payloads(spark, sf_dir)
     .select(F.concat("coin_id", F.lit("_"), day.cast("string"), F.lit(".json")).alias("file_name"),
             "prices", "market_caps", "total_volumes")
     .write.json(f"{folder}/raw"))
    # a line for each pull, with the name it landed as: a folder for each makes as many files as pulls
    schema = StructType([*PAYLOAD.fields, StructField("file_name", StringType())])
    raw = (spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt_record").json(f"{folder}/raw"))
    good, _ = tag_payloads(raw)
    coins = events.select(F.col("event_type").alias("coin_id"), F.upper("event_type").alias("coin_symbol"),
                          F.col("event_type").alias("coin_name")).distinct()
    load_good_payloads(spark, good, f"{folder}/table", coins)
    return TB.read_metrics(spark, f"{folder}/table").drop("processed_at")


@query
def json_payload_scan(spark, sf_dir):
    """Multi-line JSON files as they land (some cut off), read by the file reader: coin and date from
    the file name, pairs of each array, and the reason where a file was rejected."""
    folder = TB.staging_path(spark, "landing")
    TD.land_files(TD.pull_files(_events(spark, sf_dir)), folder)
    good, rejects = read_payloads(spark, folder)
    price = F.transform("prices", lambda p: F.get(p, 1))
    read = good.groupBy("file_name", "coin_id", "logical_date").agg(
        F.sum(F.size("prices")).alias("n_prices"), F.sum(F.size("market_caps")).alias("n_caps"),
        F.sum(F.size("total_volumes")).alias("n_volumes"), F.min(F.array_min(price)).alias("min_price"),
        F.max(F.array_max(price)).alias("max_price"))
    return read.withColumn("reason", F.lit(None).cast("string")).unionByName(rejects, allowMissingColumns=True)


@query
def refresh_sentiment(spark, sf_dir):
    """Sentiment files that land in two waves, each loaded by its own run of the stream."""
    folder = TB.staging_path(spark, "moods")
    for wave in (0, 1):
        TD.land_files(TD.mood_files(_events(spark, sf_dir), wave), f"{folder}/landing")
        sentiment_stream(spark, f"{folder}/landing", f"{folder}/table", f"{folder}/progress").awaitTermination()
    return TB.read_sentiment_table(spark, f"{folder}/table").drop("inserted_at")


def _stored_and_incoming(spark, sf_dir):
    payloads = _payloads(spark, sf_dir)
    full = B.daily_metrics(payloads, processed_at=False)
    day = F.dayofmonth("event_date")
    stored = (B.daily_bars(TK.price_ticks(payloads)).where(day <= 20)
              .select("coin_id", F.upper("coin_id").alias("coin_symbol"), F.upper("coin_id").alias("coin_name"),
                      "event_date", *B.BAR_COLUMNS, F.lit(0.0).alias("volume_usd"),
                      F.lit(0.0).alias("market_cap_usd")))
    incoming = (full.where(day >= 15)
                .select("coin_id", F.col("coin_id").alias("coin_symbol"), F.col("coin_id").alias("coin_name"),
                        "event_date", *B.BAR_COLUMNS, "volume_usd", "market_cap_usd"))
    return stored, incoming


@query
def table_upsert(spark, sf_dir):
    """``upsert_daily`` on the written table, with one coin left out of the incoming
    rows: that coin's partition stays as it was."""
    stored, incoming = (x.withColumn("processed_at", F.current_timestamp()) for x in _stored_and_incoming(spark, sf_dir))
    path = TB.staging_path(spark, "upsert")
    TB.write_metrics(stored, path)
    TB.upsert_metrics_table(spark, path, incoming.where(F.col("coin_id") != UNTOUCHED))
    return TB.read_metrics(spark, path).drop("processed_at")


@query
def table_one_coin(spark, sf_dir):
    """One coin's read of the written table: a partition filter, no other file is read."""
    path = TB.staging_path(spark, "daily-metrics")
    TB.write_metrics(_metrics(spark, sf_dir), path)
    return S.series(TB.read_metrics(spark, path), COIN).select(*SERIES_OUT)


@query
def csv_round_trip(spark, sf_dir):
    path = TB.staging_path(spark, "csv")
    metrics = _metrics(spark, sf_dir)
    TB.export_csv(metrics, path)
    return spark.read.schema(metrics.schema).option("header", True).csv(path)


# ---------------------------------------------------------------- stage 3: serving


@query
def series_for_coin(spark, sf_dir):
    return S.series(_metrics(spark, sf_dir), COIN).select(*SERIES_OUT)


@query
def date_range(spark, sf_dir):
    return S.series(_metrics(spark, sf_dir), COIN, *RANGE).select(*SERIES_OUT)


@query
def price_series(spark, sf_dir):
    return S.price_series(_metrics(spark, sf_dir), COIN)


@query
def volume_series(spark, sf_dir):
    return S.volume_series(_metrics(spark, sf_dir), COIN)


@query
def intraday_volatility(spark, sf_dir):
    return S.intraday_volatility(_metrics(spark, sf_dir), COIN)


@query
def all_series(spark, sf_dir):
    return S.all_series(_metrics(spark, sf_dir))


@query
def compare_series(spark, sf_dir):
    return S.compare_series(_metrics(spark, sf_dir))


@query
def candles(spark, sf_dir):
    return S.candles(_metrics(spark, sf_dir), COIN)


@query
def band(spark, sf_dir):
    return S.band(_metrics(spark, sf_dir), COIN)


@query
def close_vs_avg(spark, sf_dir):
    return S.close_vs_avg(_metrics(spark, sf_dir), COIN)


@query
def display_table(spark, sf_dir):
    return S.display_table(S.series(_metrics(spark, sf_dir), COIN))


@query
def current_prices(spark, sf_dir):
    return S.current_prices(_metrics(spark, sf_dir))


@query
def coverage(spark, sf_dir):
    return S.coverage(_metrics(spark, sf_dir))


@query
def coin_count(spark, sf_dir):
    return S.coin_count(_metrics(spark, sf_dir))


@query
def selection_bounds(spark, sf_dir):
    return S.selection_bounds(S.series(_metrics(spark, sf_dir), COIN, *RANGE))


@query
def series_reducers(spark, sf_dir):
    return S.series_reducers(_metrics(spark, sf_dir))


@query
def kpi(spark, sf_dir):
    return S.kpi(_metrics(spark, sf_dir))


@query
def latest_row(spark, sf_dir):
    return S.latest_row(_metrics(spark, sf_dir)).select(*SERIES_OUT)


@query
def sentiment_latest(spark, sf_dir):
    return S.sentiment_latest(_sentiment(spark, sf_dir))


@query
def sentiment_last30(spark, sf_dir):
    return S.sentiment_last(_sentiment(spark, sf_dir), 30)


@query
def sentiment_band(spark, sf_dir):
    return S.sentiment_bands(_sentiment(spark, sf_dir))


# ---------------------------------------------------------------- stage 4: compare



@query
def pivot_close(spark, sf_dir):
    return C.pivot_close(_metrics(spark, sf_dir), _symbols(spark))


@query
def corr_matrix(spark, sf_dir):
    return C.correlation(_metrics(spark, sf_dir), _symbols(spark))


@query
def normalized(spark, sf_dir):
    return C.normalized(_metrics(spark, sf_dir), _symbols(spark))


# ---------------------------------------------------------------- stage 5: features


KEYS = ["coin_id", "event_date"]


def _pf(spark, sf_dir):
    return FT.price_features(_metrics(spark, sf_dir))


def _tf(spark, sf_dir):
    return FT.trend_features(_metrics(spark, sf_dir), horizon_days=7, threshold_pct=2.0)


@query
def feat_lags(spark, sf_dir):
    return _metrics(spark, sf_dir).select(*KEYS, *FT.lag_features())


@query
def feat_ma(spark, sf_dir):
    return _metrics(spark, sf_dir).select(*KEYS, *FT.ma_features())


@query
def feat_volatility(spark, sf_dir):
    return _metrics(spark, sf_dir).select(*KEYS, *FT.volatility_features(pct=True))


@query
def feat_returns(spark, sf_dir):
    return _metrics(spark, sf_dir).select(*KEYS, *FT.return_features())


@query
def feat_range(spark, sf_dir):
    return _metrics(spark, sf_dir).select(*KEYS, *FT.range_features())


@query
def feat_rsi(spark, sf_dir):
    return FT.with_rsi(_metrics(spark, sf_dir)).select(*KEYS, "rsi_14")


@query
def feat_momentum(spark, sf_dir):
    return _metrics(spark, sf_dir).select(*KEYS, *FT.momentum_features())


@query
def feat_bollinger(spark, sf_dir):
    return _metrics(spark, sf_dir).select(*KEYS, *FT.bollinger_features())


@query
def feat_trend(spark, sf_dir):
    """Regressor trend (fraction) and classifier trends (percent) in one pass."""
    return FT.trend_lines(_metrics(spark, sf_dir))


@query
def feat_volume(spark, sf_dir):
    """Volume mean / ratio / change and market-cap change in one pass."""
    return FT.volume_changes(_metrics(spark, sf_dir))


@query
def feat_calendar(spark, sf_dir):
    return _metrics(spark, sf_dir).select(*KEYS, *FT.calendar_features())


@query
def targets(spark, sf_dir):
    return _metrics(spark, sf_dir).select(*KEYS, *FT.target_features())


@query
def trend_labels(spark, sf_dir):
    return FT.trend_labels(_metrics(spark, sf_dir), 7, 2.0)


@query
def trend_labels_14(spark, sf_dir):
    return FT.trend_labels(_metrics(spark, sf_dir), 14, 2.0)


@query
def trend_labels_30(spark, sf_dir):
    return FT.trend_labels(_metrics(spark, sf_dir), 30, 2.0)


@query
def features_price(spark, sf_dir):
    return _pf(spark, sf_dir)


@query
def features_trend(spark, sf_dir):
    return _tf(spark, sf_dir)


@query
def features_price_blocks(spark, sf_dir):
    """``features_price`` with every series cut into blocks that see their neighbours' rows."""
    return FT.in_blocks(_metrics(spark, sf_dir), FT.price_features, rows=256)


@query
def features_trend_blocks(spark, sf_dir):
    return FT.in_blocks(_metrics(spark, sf_dir), FT.trend_features, rows=256)


# ---------------------------------------------------------------- stage 6: modeling


def _price_split(spark, sf_dir, horizon=1):
    frame = _pf(spark, sf_dir)
    cols = FT.feature_columns(frame, "price")
    clean = M.clean_rows(frame, cols, f"target_{horizon}d")
    return frame, cols, clean, M.chrono_split(clean, 0.2)


def _trend_split(spark, sf_dir):
    frame = _tf(spark, sf_dir)
    cols = FT.feature_columns(frame, "trend")
    clean = M.clean_rows(frame, cols, "trend_label")
    return frame, cols, clean, M.chrono_split(clean, 0.2)


@query
def clean_rows(spark, sf_dir):
    _, _, clean, _ = _price_split(spark, sf_dir)
    return M.clean_counts(clean)


@query
def chrono_split(spark, sf_dir):
    _, _, _, split = _price_split(spark, sf_dir)
    return split.select("coin_id", "event_date", "split")


@query
def scaled_features(spark, sf_dir):
    _, cols, _, split = _price_split(spark, sf_dir)
    split = materialize(split)
    return M.standardize(split, M.scaler_stats(split, cols), cols).select("coin_id", "event_date", "split", *cols)


@query
def score_row(spark, sf_dir):
    frame = _pf(spark, sf_dir)
    cols = FT.feature_columns(frame, "price")
    return M.impute_latest(materialize(frame), cols).select("coin_id", "event_date", *cols)


@query
def metrics_regression(spark, sf_dir):
    """Metric formulas on the naive forecast "tomorrow's close = today's close"."""
    _, _, _, split = _price_split(spark, sf_dir)
    pred = split.select("coin_id", "split", F.col("target_1d").alias("label"),
                        F.col("close_price_usd").alias("prediction"))
    return M.regression_metrics(pred)


def _flat_forecast(spark, sf_dir):
    _, _, _, split = _trend_split(spark, sf_dir)
    return split.withColumn("predicted", F.lit("FLAT"))


@query
def metrics_trend(spark, sf_dir):
    return M.accuracy(_flat_forecast(spark, sf_dir))


@query
def confusion(spark, sf_dir):
    return M.confusion(_flat_forecast(spark, sf_dir).where(F.col("split") == "test"))


@query
def class_distribution(spark, sf_dir):
    _, _, _, split = _trend_split(spark, sf_dir)
    return M.class_distribution(split)


@query
def label_index(spark, sf_dir):
    _, _, clean, _ = _trend_split(spark, sf_dir)
    return M.label_indexer(clean).transform(clean).groupBy("trend_label", "label").agg(F.count(F.lit(1)).alias("n"))


@query
def forecast_price(spark, sf_dir):
    return M.predict_multiple_horizons(_metrics(spark, sf_dir))[0]


@query
def forecast_trend(spark, sf_dir):
    return M.predict_trend(_metrics(spark, sf_dir))[0]


@query
def forecast_trend_14(spark, sf_dir):
    return M.predict_trend(_metrics(spark, sf_dir), 14)[0]


@query
def forecast_trend_30(spark, sf_dir):
    return M.predict_trend(_metrics(spark, sf_dir), 30)[0]


@query
def feature_importance(spark, sf_dir):
    """The ten features of the largest gain of each coin's one-day price model."""
    return M.train_and_predict(_metrics(spark, sf_dir), 1)[1].importance(10, by_coin=True)


FIRST = dict(rounds=1, depth=1, rows=1.0, columns=1.0)


@query
def boost_price_roots(spark, sf_dir):
    """The first split of each price model without drawing rows or columns: the best of all
    boundaries of all features, as a share of the label's sum of squares."""
    _, _, data = M.price_inputs(_metrics(spark, sf_dir))
    train, keys = data.split.where("split = 'train'"), ["coin_id", "horizon"]
    trees = boosting.fit(train, keys, replace(M.PRICE_PARAMS, **FIRST))
    labels = train.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("base"), F.var_pop("label").alias("var"))
    return (boosting.roots(trees, keys).join(labels, keys)
            .select(*keys, "n", "cover", "base", F.try_divide("gain", F.col("var") * F.col("n")).alias("gain_share")))


@query
def boost_trend_roots(spark, sf_dir):
    """As ``boost_price_roots`` for the three trees of the first softmax round."""
    _, _, data = M.trend_inputs(_metrics(spark, sf_dir))
    trees = boosting.fit(data.split.where("split = 'train'"), ["coin_id"], replace(M.TREND_PARAMS, **FIRST))
    name = F.element_at(F.array(*[F.lit(c) for c in TREND_CLASSES]), F.col("cls") + 1)
    return boosting.roots(trees, ["coin_id"]).select("coin_id", name.alias("trend_label"), "cover", "gain")


def _rows_per_split(metrics, *keys):
    return metrics.groupBy("coin_id", *keys).agg(*[
        F.sum(F.when(F.col("split") == x, F.col("n"))).alias(f"n_{x}") for x in ("train", "test")])


@query
def forecast_price_check(spark, sf_dir):
    """What SQL can tell of the price forecasts: who gets one, from which price, the
    rows fitted and judged on, and how the columns agree with each other."""
    out, fits = M.predict_multiple_horizons(_metrics(spark, sf_dir))
    metrics = None
    for fit in fits.values():
        metrics = fit.metrics if metrics is None else metrics.unionByName(fit.metrics)
    change = (F.col("prediction") - F.col("current_price")) / F.col("current_price") * 100
    rows = _rows_per_split(metrics, "horizon").join(
        metrics.groupBy("coin_id", "horizon").agg(F.bool_and(F.col("mae") <= F.col("rmse")).alias("mae_within_rmse")),
        ["coin_id", "horizon"])
    return (out.join(rows, ["coin_id", "horizon"], "left")
            .select("coin_id", "horizon", "current_price", F.col("prediction").isNotNull().alias("predicted"),
                    (F.abs(F.col("change_pct") - change) < 1e-9).alias("change_agrees"),
                    (F.col("confidence") >= 0).alias("confident"), "n_train", "n_test", "mae_within_rmse"))


@query
def forecast_trend_check(spark, sf_dir):
    """As ``forecast_price_check``, with the true classes of the confusion matrix."""
    out, fit = M.predict_trend(_metrics(spark, sf_dir))
    acc, grid, _ = M.trend_metrics(fit.scored)
    true = grid.groupBy("coin_id").agg(*[
        F.sum(F.when(F.col("true_label") == c, F.col("pred_down") + F.col("pred_flat") + F.col("pred_up"))).alias(f"true_{c.lower()}")
        for c in ("DOWN", "FLAT", "UP")])
    p = {c: F.col(f"p_{c.lower()}") for c in ("DOWN", "FLAT", "UP")}
    best = F.element_at(F.create_map(*[x for c in p for x in (F.lit(c), p[c])]), F.col("trend"))
    return (out.join(_rows_per_split(acc), "coin_id", "left").join(true, "coin_id", "left")
            .select("coin_id", "current_price", (F.abs(sum(p.values()) - 1) < 1e-9).alias("sums_to_one"),
                    (best == F.greatest(*p.values())).alias("trend_is_likeliest"),
                    (F.col("confidence") == best).alias("confidence_agrees"),
                    "n_train", "n_test", "true_down", "true_flat", "true_up"))


@query
def importance_check(spark, sf_dir):
    """Every feature's importance in each coin's model is a share; all of a model sum to 1."""
    out = None
    for h, fit in M.predict_multiple_horizons(_metrics(spark, sf_dir))[1].items():
        rows = fit.importance(None, by_coin=True).withColumn("horizon", F.lit(h))
        out = rows if out is None else out.unionByName(rows)
    total = out.groupBy("horizon", "coin_id").agg(F.sum("importance").alias("total"))
    return (out.join(total, ["horizon", "coin_id"]).groupBy("horizon", "feature")
            .agg(F.bool_and(F.col("importance").between(0, 1)).alias("is_share"),
                 F.bool_and(F.abs(F.col("total") - 1) < 1e-9).alias("sums_to_one")))
