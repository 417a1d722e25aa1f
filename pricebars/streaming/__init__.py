from pricebars.streaming.refresh import refresh_batch, refresh_run, refresh_stream, sentiment_stream  # noqa: F401
