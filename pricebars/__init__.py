"""pricebars: daily price-series analytics on Spark DataFrames.

Public API (every function takes and returns DataFrames):

* sources: ``read_payloads``, ``read_sentiment``, ``write_metrics``,
  ``read_metrics``, ``upsert_metrics_table``, ``upsert_sentiment``, ``append_raw``,
  ``latest_raw``, ``export_csv``, ``first_non_empty``
* snapshot tables: ``collect_old`` (and ``pricebars.sources.snapshots``)
* roll-up: ``ticks``, ``price_ticks``, ``daily_bars``, ``daily_mean``, ``daily_metrics``
* tables: ``enrich``, ``coin_dimension``, ``upsert``, ``latest_per_key``
* serving: ``series``, ``all_series``, ``kpi``, ``coverage``, ``current_prices`` ...
* comparison: ``correlation``, ``normalized``, ``pivot_close``
* features: ``price_features``, ``trend_features``, ``trend_labels``, ``in_blocks``
* models: ``chrono_split``, ``score_row``, ``regression_metrics``, ``trend_metrics``,
  ``train_and_predict``, ``predict_multiple_horizons``, ``predict_trend``
* jobs: ``refresh_batch``, ``refresh_stream``, ``sentiment_stream``, ``refresh_run``
"""

__version__ = "0.1.0"

from pricebars.functions.exprs import sentiment_band, trend_label  # noqa: E402,F401
from pricebars.operators.bars import daily_bars, daily_mean, daily_metrics, roll_up  # noqa: E402,F401
from pricebars.operators.compare import correlation, normalized, pivot_close  # noqa: E402,F401
from pricebars.operators.enrich import coin_dimension, enrich  # noqa: E402,F401
from pricebars.operators.features import in_blocks, price_features, trend_features, trend_labels  # noqa: E402,F401
from pricebars.operators.modeling import (  # noqa: E402,F401
    chrono_split, predict_multiple_horizons, predict_trend, regression_metrics, score_row,
    train_and_predict, trend_metrics,
)
from pricebars.operators.serving import (  # noqa: E402,F401
    all_series, coverage, current_prices, kpi, series,
)
from pricebars.operators.ticks import price_ticks, ticks  # noqa: E402,F401
from pricebars.operators.upsert import latest_per_key, upsert  # noqa: E402,F401
from pricebars.sources import (  # noqa: E402,F401
    append_raw, export_csv, first_non_empty, latest_raw, read_metrics, read_payloads,
    read_sentiment, upsert_metrics_table, upsert_sentiment, write_metrics,
)
from pricebars.sources.snapshots import collect_old  # noqa: E402,F401
from pricebars.streaming.refresh import (  # noqa: E402,F401
    refresh_batch, refresh_run, refresh_stream, sentiment_stream,
)
