"""Serving reads over the daily metrics table: dashboard panels, app reads,
KPIs, chart data, bounds and the display table.

All of them are plain projections, filters and small aggregates over the table;
filters on ``coin_id`` / ``event_date`` reach the Parquet scan (partition and
row-group pruning).  Coins are parameters, never interpolated into SQL text.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebars.functions.exprs import safe_div, sentiment_band, series_window

SERIES_COLUMNS = ["coin_id", "coin_symbol", "coin_name", "event_date", "open_price_usd", "close_price_usd",
                  "avg_price_usd", "max_price_usd", "min_price_usd", "volume_usd", "market_cap_usd",
                  "samples_per_day", "processed_at"]


def _coin(metrics: DataFrame, coin_id: str) -> DataFrame:
    return metrics.where(F.col("coin_id") == F.lit(coin_id))


def series(metrics: DataFrame, coin_id: str, start: dt.date | str | None = None,
           end: dt.date | str | None = None) -> DataFrame:
    """One coin's rows, date ordered; optional inclusive date range."""
    df = _coin(metrics, coin_id)
    if start is not None:
        df = df.where(F.col("event_date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("event_date") <= F.lit(end).cast("date"))
    cols = [c for c in SERIES_COLUMNS if c in metrics.columns]
    return df.select(*cols).orderBy("event_date")


def all_series(metrics: DataFrame) -> DataFrame:
    """Slim read of every coin: id, symbol, date, close."""
    return metrics.select("coin_id", "coin_symbol", "event_date", "close_price_usd").orderBy("event_date")


def price_series(metrics: DataFrame, coin_id: str) -> DataFrame:
    return (_coin(metrics, coin_id)
            .select(F.col("event_date").alias("time"), F.col("close_price_usd").alias("value"),
                    F.col("coin_symbol").alias("metric")).orderBy("time"))


def volume_series(metrics: DataFrame, coin_id: str) -> DataFrame:
    return (_coin(metrics, coin_id).where(F.col("volume_usd") > 0)
            .select(F.col("event_date").alias("time"), F.col("volume_usd").alias("value")).orderBy("time"))


def volatility_pct(high="max_price_usd", low="min_price_usd", mean="avg_price_usd"):
    return safe_div(F.col(high) - F.col(low), F.col(mean)) * F.lit(100.0)


def intraday_volatility(metrics: DataFrame, coin_id: str) -> DataFrame:
    return (_coin(metrics, coin_id)
            .select(F.col("event_date").alias("time"), volatility_pct().alias("value")).orderBy("time"))


def compare_series(metrics: DataFrame) -> DataFrame:
    """All coins' closes as ``(time, value, metric)``, by date then symbol."""
    return (metrics.select(F.col("event_date").alias("time"), F.col("close_price_usd").alias("value"),
                           F.col("coin_symbol").alias("metric")).orderBy("time", "metric"))


def current_prices(metrics: DataFrame) -> DataFrame:
    """Closes on the table's last date (coins without a row that day are absent),
    dearest first.  The last date is a one-row aggregate, broadcast by nature."""
    last = metrics.agg(F.max("event_date").alias("_last"))
    return (metrics.join(F.broadcast(last), F.col("event_date") == F.col("_last"))
            .select(F.col("coin_symbol").alias("metric"), F.col("close_price_usd").alias("value"))
            .orderBy(F.col("value").desc()))


def candles(metrics: DataFrame, coin_id: str) -> DataFrame:
    return _coin(metrics, coin_id).select(
        "event_date", F.col("open_price_usd").alias("open"), F.col("max_price_usd").alias("high"),
        F.col("min_price_usd").alias("low"), F.col("close_price_usd").alias("close")).orderBy("event_date")


def band(metrics: DataFrame, coin_id: str) -> DataFrame:
    return _coin(metrics, coin_id).select("event_date", "max_price_usd", "min_price_usd",
                                          "avg_price_usd").orderBy("event_date")


def close_vs_avg(metrics: DataFrame, coin_id: str) -> DataFrame:
    return _coin(metrics, coin_id).select("event_date", "close_price_usd", "avg_price_usd").orderBy("event_date")


def display_table(metrics: DataFrame) -> DataFrame:
    """Date as ``yyyy-MM-dd`` text and the price columns, newest first."""
    cols = ["open_price_usd", "close_price_usd", "avg_price_usd", "max_price_usd", "min_price_usd"]
    if "volume_usd" in metrics.columns:
        cols.append("volume_usd")
    return (metrics.select(F.date_format("event_date", "yyyy-MM-dd").alias("event_date"), *cols)
            .orderBy(F.col("event_date").desc()))


def coverage(metrics: DataFrame) -> DataFrame:
    """Row count and first / last date per coin."""
    return metrics.groupBy("coin_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                          F.min("event_date").alias("first_date"),
                                          F.max("event_date").alias("last_date"))


def coin_count(metrics: DataFrame, minimum: int = 2) -> DataFrame:
    """Distinct coins and whether there are enough for a correlation."""
    return (metrics.agg(F.count_distinct("coin_id").alias("n_coins"))
            .withColumn("enough", F.col("n_coins") >= F.lit(minimum)))


def selection_bounds(selection: DataFrame) -> DataFrame:
    """First date, last date and row count of a selection."""
    return selection.agg(F.min("event_date").alias("min_date"), F.max("event_date").alias("max_date"),
                         F.count(F.lit(1)).alias("n_days"))


def series_reducers(metrics: DataFrame) -> DataFrame:
    """Panel reducers per coin: last and mean close, last non-NULL volume."""
    return metrics.groupBy("coin_symbol").agg(
        F.max_by("close_price_usd", "event_date").alias("last_close"),
        F.avg("close_price_usd").alias("mean_close"),
        F.max_by("volume_usd", F.when(F.col("volume_usd").isNotNull(), F.col("event_date"))).alias(
            "last_volume"))


def kpi(metrics: DataFrame) -> DataFrame:
    """Latest row of each coin against the row before it.

    Change in percent is 0 when the previous close is not positive; a coin with
    one row compares the row with itself.  Volume is shown only when positive, and
    market cap only when volume is shown and the cap is positive."""
    w = series_window()
    prev = F.coalesce(F.lag("close_price_usd", 1).over(w), F.col("close_price_usd"))
    last = F.lead("event_date", 1).over(w).isNull()
    df = metrics.select("*", prev.alias("prev_close"), last.alias("_last")).where("_last")
    delta = F.col("close_price_usd") - F.col("prev_close")
    vol_shown = F.col("volume_usd") > 0
    return df.select(
        "coin_id", "event_date", F.col("close_price_usd").alias("price"), delta.alias("price_delta"),
        F.when(F.col("prev_close") > 0, (delta / F.col("prev_close")) * F.lit(100.0))
         .otherwise(F.lit(0.0)).alias("price_pct"),
        F.col("max_price_usd").alias("high"), F.col("min_price_usd").alias("low"),
        volatility_pct().alias("volatility_pct"),
        F.when(vol_shown, F.col("volume_usd")).alias("volume_shown"),
        F.when(vol_shown & (F.col("market_cap_usd") > 0), F.col("market_cap_usd")).alias("market_cap_shown"))


def latest_row(df: DataFrame, key: str = "coin_id", order: str = "event_date") -> DataFrame:
    """Newest row per entity."""
    w = series_window(key, order)
    return df.select("*", F.lead(order, 1).over(w).isNull().alias("_last")).where("_last").drop("_last")


# ---------------------------------------------------------------- sentiment


def sentiment_table(points: DataFrame) -> DataFrame:
    """Sentiment index, one row per day: the last record of the day wins."""
    from pricebars.operators.upsert import latest_per_key

    return latest_per_key(points.select("event_date", "value", "value_classification", "part", "pos"),
                          ["event_date"], ["part", "pos"]).drop("part", "pos")


def sentiment_latest(sentiment: DataFrame) -> DataFrame:
    return sentiment.orderBy(F.col("event_date").desc()).limit(1).select("value")


def sentiment_last(sentiment: DataFrame, n: int = 30) -> DataFrame:
    return (sentiment.orderBy(F.col("event_date").desc()).limit(n)
            .select("event_date", "value", "value_classification"))


def sentiment_bands(sentiment: DataFrame) -> DataFrame:
    return sentiment.select("event_date", "value", sentiment_band("value").alias("band"))
