"""Declared schemas for every input and table (no inference anywhere)."""

from pyspark.sql import types as T

PAIR_ARRAY = T.ArrayType(T.ArrayType(T.DoubleType()))

# Market payload: one JSON object per coin and logical date, three parallel arrays
# of [epoch_ms, value] pairs.  `_corrupt_record` collects unparsable files.
PAYLOAD = T.StructType([
    T.StructField("prices", PAIR_ARRAY),
    T.StructField("market_caps", PAIR_ARRAY),
    T.StructField("total_volumes", PAIR_ARRAY),
    T.StructField("_corrupt_record", T.StringType()),
])

SENTIMENT_RECORD = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("value_classification", T.StringType()),
])

SENTIMENT_PAYLOAD = T.StructType([
    T.StructField("data", T.ArrayType(SENTIMENT_RECORD)),
    T.StructField("_corrupt_record", T.StringType()),
])

# Daily metrics table, key (coin_id, event_date).
DAILY_METRICS = T.StructType([
    T.StructField("coin_id", T.StringType()),
    T.StructField("coin_symbol", T.StringType()),
    T.StructField("coin_name", T.StringType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("open_price_usd", T.DoubleType()),
    T.StructField("close_price_usd", T.DoubleType()),
    T.StructField("avg_price_usd", T.DoubleType()),
    T.StructField("max_price_usd", T.DoubleType()),
    T.StructField("min_price_usd", T.DoubleType()),
    T.StructField("volume_usd", T.DoubleType()),
    T.StructField("market_cap_usd", T.DoubleType()),
    T.StructField("samples_per_day", T.LongType()),
    T.StructField("processed_at", T.TimestampType()),
])

# As stored: with the date of the pull that decided the row (the merge version).
METRICS_TABLE = T.StructType([*DAILY_METRICS.fields, T.StructField("logical_date", T.DateType())])

# Sentiment table, key event_date.
SENTIMENT = T.StructType([
    T.StructField("event_date", T.DateType()),
    T.StructField("value", T.IntegerType()),
    T.StructField("value_classification", T.StringType()),
    T.StructField("inserted_at", T.TimestampType()),
])

# Raw landing log, append only.
RAW_LOG = T.StructType([
    T.StructField("coin_id", T.StringType()),
    T.StructField("logical_date", T.DateType()),
    T.StructField("payload", T.StringType()),
    T.StructField("inserted_at", T.TimestampType()),
])

COIN_DIM = T.StructType([
    T.StructField("coin_id", T.StringType()),
    T.StructField("coin_symbol", T.StringType()),
    T.StructField("coin_name", T.StringType()),
])

# The supported coins (id, symbol, name), in the reference's order.
SUPPORTED_COINS = [
    ("bitcoin", "BTC", "Bitcoin"),
    ("ethereum", "ETH", "Ethereum"),
    ("binancecoin", "BNB", "BNB"),
    ("solana", "SOL", "Solana"),
    ("cardano", "ADA", "Cardano"),
]
