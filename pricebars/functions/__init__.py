from pricebars.functions.exprs import (  # noqa: F401
    TREND_CLASSES, full_window, pct_change, rolling_max, rolling_mean, rolling_min,
    rolling_std, round_doubles, rsi, safe_div, sentiment_band, series_window, trailing,
    trend_label, zero_if_missing,
)
