from pricebars.sources.payloads import read_payloads  # noqa: F401
from pricebars.sources.sentiment import read_sentiment, sentiment_points  # noqa: F401
from pricebars.sources.tables import (  # noqa: F401
    append_raw, export_csv, first_non_empty, land_raw, latest_raw, read_metrics, read_raw,
    read_sentiment_table, upsert_metrics_table, upsert_sentiment, upsert_sentiment_table, write_metrics,
)
