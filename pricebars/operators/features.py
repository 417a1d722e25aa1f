"""Windowed technical features over each coin's daily series.

Every feature is defined over the same ``Window.partitionBy("coin_id")
.orderBy("event_date")``, so the whole feature frame costs one shuffle and one
sort; the RSI's difference column adds a second window pass over the already
sorted partition.  Windows are row based (the n-th previous *row*, not date) and
need a full window, as in pandas ``rolling(n)``.  A coin's daily series holds
one row per calendar day at most, so a window partition is bounded by the
calendar, not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricebars.functions.exprs import (
    pct_change, rolling_max, rolling_mean, rolling_min, rolling_std, rsi, safe_div, series_window,
    trend_label,
)

PRICE = "close_price_usd"

# Feature parameters (lags, moving-average windows, volatility
# windows, return periods, RSI and Bollinger windows, forecast horizons).
LAGS = [1, 2, 3, 5, 7, 14, 21, 30]
MA_WINDOWS = [3, 7, 14, 21, 30]
VOL_WINDOWS = [7, 14, 30]
RETURN_PERIODS_PRICE = [1, 3, 7, 14, 30]
RETURN_PERIODS_TREND = [1, 3, 7, 14]
RSI_WINDOW = 14
BB_WINDOW = 20
TARGET_HORIZONS = [1, 7, 30]

ID_COLUMNS = ["event_date", "processed_at", "coin_id", "coin_symbol", "coin_name", "id"]
BOLLINGER_RAW = ["bb_std", "bb_middle", "bb_upper", "bb_lower"]


def _return_name(p: int) -> str:
    return "daily_return" if p == 1 else f"return_{p}d"


def _w():
    return series_window()


# Column helpers (one feature group each).  They inline their window
# expressions, which suits single-group reads; the full frames below are built
# in stages instead, so each window expression appears exactly once.


def lag_features(c: str = PRICE, lags=LAGS) -> list[Column]:
    return [F.lag(c, n).over(_w()).alias(f"price_lag_{n}") for n in lags]


def ma_features(c: str = PRICE, windows=MA_WINDOWS) -> list[Column]:
    out = []
    for n in windows:
        ma = rolling_mean(c, _w(), n)
        out += [ma.alias(f"ma_{n}"), safe_div(F.col(c), ma).alias(f"ma_{n}_ratio")]
    return out


def volatility_features(c: str = PRICE, windows=VOL_WINDOWS, pct: bool = False) -> list[Column]:
    out = []
    for n in windows:
        sd = rolling_std(c, _w(), n)
        out.append(sd.alias(f"volatility_{n}"))
        if pct:
            out.append((safe_div(sd, F.col(c)) * F.lit(100.0)).alias(f"volatility_{n}_pct"))
    return out


def return_features(c: str = PRICE, periods=RETURN_PERIODS_PRICE, scale: float = 1.0) -> list[Column]:
    return [(pct_change(c, _w(), p) * F.lit(scale) if scale != 1.0 else pct_change(c, _w(), p))
            .alias(_return_name(p)) for p in periods]


def range_features(c: str = PRICE, n: int = 7) -> list[Column]:
    lo, hi = rolling_min(c, _w(), n), rolling_max(c, _w(), n)
    return [lo.alias(f"min_{n}d"), hi.alias(f"max_{n}d"), (hi - lo).alias(f"range_{n}d"),
            safe_div(hi - lo, F.col(c)).alias(f"range_{n}d_pct")]


def momentum_features(c: str = PRICE, periods=(7, 14)) -> list[Column]:
    return [(F.col(c) - F.lag(c, p).over(_w())).alias(f"momentum_{p}d") for p in periods]


def bollinger_features(c: str = PRICE, n: int = BB_WINDOW) -> list[Column]:
    mid, sd = rolling_mean(c, _w(), n), rolling_std(c, _w(), n)
    upper, lower = mid + F.lit(2.0) * sd, mid - F.lit(2.0) * sd
    return [mid.alias("bb_middle"), sd.alias("bb_std"), upper.alias("bb_upper"), lower.alias("bb_lower"),
            safe_div(F.col(c) - lower, upper - lower).alias("bb_position")]


def calendar_features(day_of_month: bool = True) -> list[Column]:
    """Monday = 0, as pandas ``dayofweek``."""
    out = [F.weekday("event_date").alias("day_of_week"), F.month("event_date").alias("month")]
    if day_of_month:
        out.append(F.dayofmonth("event_date").alias("day_of_month"))
    return out


def target_features(c: str = PRICE, horizons=TARGET_HORIZONS) -> list[Column]:
    return [F.lead(c, h).over(_w()).alias(f"target_{h}d") for h in horizons]


def with_rsi(df: DataFrame, c: str = PRICE, n: int = RSI_WINDOW) -> DataFrame:
    """Add ``rsi_14`` (second window pass on the same partitioning)."""
    d = df.withColumn("_delta", F.col(c) - F.lag(c, 1).over(_w()))
    return d.withColumn(f"rsi_{n}", rsi("_delta", _w(), n)).drop("_delta")


def trend_lines(df: DataFrame) -> DataFrame:
    """Gaps between moving averages, and their strength as a fraction (price model) and
    in percent (trend model), in one pass."""
    m = df.select("coin_id", "event_date", *[rolling_mean(PRICE, _w(), n).alias(f"_ma{n}") for n in (7, 21, 30)])
    gap = F.col("_ma7") - F.col("_ma30")
    strength = safe_div(gap, F.col("_ma30"))
    return m.select("coin_id", "event_date", gap.alias("trend"), strength.alias("trend_strength_frac"),
                    (F.col("_ma7") - F.col("_ma21")).alias("trend_7_21"), gap.alias("trend_7_30"),
                    (strength * F.lit(100.0)).alias("trend_strength_pct"))


def volume_changes(df: DataFrame) -> DataFrame:
    """Volume mean, ratio and change, and market-cap change, in one pass."""
    m = df.select("coin_id", "event_date", "volume_usd", rolling_mean("volume_usd", _w(), 7).alias("volume_ma_7"),
                  pct_change("market_cap_usd", _w(), 1).alias("mcap_change"),
                  (pct_change("volume_usd", _w(), 1) * F.lit(100.0)).alias("volume_change"))
    return m.select("coin_id", "event_date", "volume_ma_7",
                    safe_div(F.col("volume_usd"), F.col("volume_ma_7")).alias("volume_ratio"), "mcap_change", "volume_change")


# ---------------------------------------------------------------- full frames


def _window_stage(metrics: DataFrame, lags, extra_lags, ma_windows, std_windows, range_window,
                  leads: dict[str, int]) -> DataFrame:
    """Stage 1: every window expression once (lags, gated means / stds /
    extremes, the RSI difference, volume mean, leads)."""
    w, c = _w(), PRICE
    cols = [F.lag(c, n).over(w).alias(f"price_lag_{n}") for n in lags]
    cols += [F.lag(c, n).over(w).alias(f"_lag_{n}") for n in extra_lags if n not in lags]
    cols += [rolling_mean(c, w, n).alias(f"ma_{n}") for n in ma_windows]
    cols += [rolling_std(c, w, n).alias(f"_sd_{n}") for n in std_windows]
    if range_window:
        cols += [rolling_min(c, w, range_window).alias(f"min_{range_window}d"),
                 rolling_max(c, w, range_window).alias(f"max_{range_window}d")]
    cols.append((F.col(c) - F.lag(c, 1).over(w)).alias("_delta"))
    if "volume_usd" in metrics.columns:
        cols += [rolling_mean("volume_usd", w, 7).alias("volume_ma_7"),
                 F.lag("volume_usd", 1).over(w).alias("_vol_lag_1")]
    if "market_cap_usd" in metrics.columns:
        cols.append(F.lag("market_cap_usd", 1).over(w).alias("_cap_lag_1"))
    cols += [F.lead(c, h).over(w).alias(name) for name, h in leads.items()]
    out = metrics.select("*", *cols)
    return out.withColumn(f"rsi_{RSI_WINDOW}", rsi("_delta", w, RSI_WINDOW))


def _lag_col(n: int, lags) -> Column:
    return F.col(f"price_lag_{n}") if n in lags else F.col(f"_lag_{n}")


def _ret(n: int, lags) -> Column:
    return safe_div(F.col(PRICE), _lag_col(n, lags)) - F.lit(1.0)


def price_features(metrics: DataFrame, lookback_days: int = 30) -> DataFrame:
    """Regressor feature frame: input columns, 39 derived features and the three
    targets, in the reference's column order."""
    c = F.col(PRICE)
    lags = [n for n in LAGS if n <= lookback_days]
    st = _window_stage(metrics, lags, RETURN_PERIODS_PRICE, MA_WINDOWS, VOL_WINDOWS, 7,
                       {f"target_{h}d": h for h in TARGET_HORIZONS})
    cols = [F.col(f"price_lag_{n}") for n in lags]
    for n in MA_WINDOWS:
        cols += [F.col(f"ma_{n}"), safe_div(c, F.col(f"ma_{n}")).alias(f"ma_{n}_ratio")]
    cols += [F.col(f"_sd_{n}").alias(f"volatility_{n}") for n in VOL_WINDOWS]
    cols += [_ret(p, lags).alias(_return_name(p)) for p in RETURN_PERIODS_PRICE]
    rng = F.col("max_7d") - F.col("min_7d")
    cols += [F.col("min_7d"), F.col("max_7d"), rng.alias("range_7d"), safe_div(rng, c).alias("range_7d_pct"),
             F.col("rsi_14"), *calendar_features(),
             (F.col("ma_7") - F.col("ma_30")).alias("trend"),
             safe_div(F.col("ma_7") - F.col("ma_30"), F.col("ma_30")).alias("trend_strength")]
    if "volume_usd" in metrics.columns:
        cols += [F.col("volume_ma_7"), safe_div(F.col("volume_usd"), F.col("volume_ma_7")).alias("volume_ratio")]
    if "market_cap_usd" in metrics.columns:
        cols.append((safe_div(F.col("market_cap_usd"), F.col("_cap_lag_1")) - F.lit(1.0)).alias("mcap_change"))
    cols += [F.col(f"target_{h}d") for h in TARGET_HORIZONS]
    return st.select(*metrics.columns, *cols)


def trend_features(metrics: DataFrame, horizon_days: int = 7, threshold_pct: float = 2.0) -> DataFrame:
    """Classifier feature frame with ``future_price`` and ``trend_label``."""
    c = F.col(PRICE)
    hundred = F.lit(100.0)
    st = _window_stage(metrics, LAGS, RETURN_PERIODS_TREND, MA_WINDOWS + [BB_WINDOW], VOL_WINDOWS + [BB_WINDOW],
                       None, {"future_price": horizon_days})
    cols = [F.col(f"price_lag_{n}") for n in LAGS]
    for n in MA_WINDOWS:
        cols += [F.col(f"ma_{n}"), safe_div(c, F.col(f"ma_{n}")).alias(f"ma_{n}_ratio")]
    for n in VOL_WINDOWS:
        cols += [F.col(f"_sd_{n}").alias(f"volatility_{n}"),
                 (safe_div(F.col(f"_sd_{n}"), c) * hundred).alias(f"volatility_{n}_pct")]
    cols += [(_ret(p, LAGS) * hundred).alias(_return_name(p)) for p in RETURN_PERIODS_TREND]
    cols += [(c - F.col(f"price_lag_{p}")).alias(f"momentum_{p}d") for p in (7, 14)]
    mid, sd = F.col(f"ma_{BB_WINDOW}"), F.col(f"_sd_{BB_WINDOW}")
    upper, lower = mid + F.lit(2.0) * sd, mid - F.lit(2.0) * sd
    cols += [F.col("rsi_14"), mid.alias("bb_middle"), sd.alias("bb_std"), upper.alias("bb_upper"),
             lower.alias("bb_lower"), safe_div(c - lower, upper - lower).alias("bb_position"),
             (F.col("ma_7") - F.col("ma_21")).alias("trend_7_21"),
             (F.col("ma_7") - F.col("ma_30")).alias("trend_7_30"),
             (safe_div(F.col("ma_7") - F.col("ma_30"), F.col("ma_30")) * hundred).alias("trend_strength")]
    if "volume_usd" in metrics.columns:
        cols += [F.col("volume_ma_7"), safe_div(F.col("volume_usd"), F.col("volume_ma_7")).alias("volume_ratio"),
                 ((safe_div(F.col("volume_usd"), F.col("_vol_lag_1")) - F.lit(1.0)) * hundred).alias("volume_change")]
    cols += [*calendar_features(day_of_month=False), F.col("future_price"),
             trend_label(PRICE, "future_price", threshold_pct).alias("trend_label")]
    return st.select(*metrics.columns, *cols)


LOOK_BACK = 30      # rows before and after that any feature, target or label reaches
BLOCK_ROWS = 1024
RANK_DAYS = 2048


def in_blocks(metrics: DataFrame, features, rows: int = BLOCK_ROWS, reach: int = LOOK_BACK) -> DataFrame:
    """``features(metrics)`` for series too long for one task: each series is cut into blocks of
    ``rows`` rows, and a block's windows also see the ``reach`` rows before and after it.

    Rows are numbered without a window over the series: within spans of dates, after the counts
    of the spans before.  ``features`` must keep its input's columns and key its windows by
    ``coin_id`` (which is the series and the block here), as ``price_features`` and
    ``trend_features`` do; the result is the same as without blocks."""
    if reach > rows:
        raise ValueError("a block must be as long as what its neighbours see of it")
    spans = metrics.withColumn("_span", F.floor(F.unix_date("event_date") / RANK_DAYS))
    counts = spans.groupBy("coin_id", "_span").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("coin_id").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("coin_id", "_span", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("coin_id", "_span").orderBy("event_date"))
    ranked = spans.join(counts, ["coin_id", "_span"]).withColumn("_rank", F.col("_before") + inside - 1)
    block, place = F.floor(F.col("_rank") / rows), F.col("_rank") % rows
    seen_by = F.filter(F.array(block, F.when(place >= rows - reach, block + 1), F.when(place < reach, block - 1)), lambda b: b.isNotNull())
    dealt = ranked.select(*metrics.columns, block.alias("_home"), F.explode(seen_by).alias("_block"))
    named = dealt.select(*[F.struct("coin_id", "_block").alias(c) if c == "coin_id" else F.col(c) for c in metrics.columns],
                         (F.col("_home") == F.col("_block")).alias("_own"))
    out = features(named).where("_own").drop("_own")
    return out.select(*[F.col("coin_id.coin_id").alias(c) if c == "coin_id" else F.col(c) for c in out.columns])


def feature_columns(frame: DataFrame, kind: str = "price") -> list[str]:
    """Model inputs: every column except ids, dates and targets (and, for the
    trend model, the four raw Bollinger columns)."""
    if kind == "price":
        skip = set(ID_COLUMNS) | {"target_1d", "target_7d", "target_30d"}
        return [c for c in frame.columns if c not in skip and not c.startswith("target_")]
    skip = set(ID_COLUMNS) | {"future_price", "trend_label"} | set(BOLLINGER_RAW)
    return [c for c in frame.columns if c not in skip]


def trend_labels(metrics: DataFrame, horizon_days: int = 7, threshold_pct: float = 2.0) -> DataFrame:
    w = _w()
    fut = F.lead(PRICE, horizon_days).over(w)
    return (metrics.select("coin_id", "event_date", PRICE, fut.alias("future_price"))
            .withColumn("trend_label", trend_label(PRICE, "future_price", threshold_pct)))
