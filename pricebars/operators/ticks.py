"""Unnest market payloads into tick rows.

A payload row carries ``coin_id``, a ``part`` number (which slice of one pull the
row holds; 0 for a whole file) and three arrays of ``[epoch_ms, value]`` pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebars.functions.exprs import event_in_range, order_key, utc_day

PRICE, VOLUME, MARKET_CAP = "prices", "total_volumes", "market_caps"


def ticks(payloads: DataFrame, field: str = PRICE, value_name: str = "price_usd",
          keep_null_values: bool = False) -> DataFrame:
    """One row per pair of ``field``.

    Columns: ``coin_id, part, pos, event_ms, event_time, event_date, <value_name>``.
    ``pos`` is the position inside the array; together with ``part`` it breaks ties
    between ticks of the same millisecond.  Short pairs give a NULL value instead
    of an index error; pairs without a time, or with one out of range (not in
    milliseconds), are dropped: they belong to no day, and their file is reported;
    NULL values are dropped unless ``keep_null_values`` (volume and cap keep them,
    the mean skips them).
    """
    exploded = payloads.select("coin_id", "part", F.posexplode(field).alias("pos", "pair"))
    ms = F.get("pair", 0).try_cast("long")
    out = (exploded
           .select("coin_id", "part", "pos", ms.alias("event_ms"),
                   F.get("pair", 1).alias(value_name))
           .where(event_in_range("event_ms")))
    if not keep_null_values:
        out = out.where(F.col(value_name).isNotNull())
    ts = F.timestamp_millis("event_ms")
    return out.select("coin_id", "part", "pos", "event_ms", ts.alias("event_time"),
                      utc_day("event_ms", 1000).alias("event_date"), value_name)


def price_ticks(payloads: DataFrame) -> DataFrame:
    """Price ticks with the ordering key used for open / close: full-precision
    time, then part, then array position (``part < 10**14``)."""
    t = ticks(payloads, PRICE, "price_usd")
    return t.withColumn("tick_key", order_key("event_ms", ("part", 14), ("pos", 10)))


KIND_PRICE, KIND_VOLUME, KIND_CAP = 0, 1, 2


def tagged_points(payloads: DataFrame) -> DataFrame:
    """All three arrays of each payload row in one pass (one ``inline`` over a
    tagged, concatenated array), as roll-up input: ``coin_id, event_date,
    tick_key, price_usd, volume_usd, market_cap_usd`` with one measure set per row.

    Reading payloads once matters for file sources: three separate explodes
    would parse every JSON file three times."""
    from pricebars.schemas import PAIR_ARRAY

    def tag(field, kind):
        arr = F.coalesce(F.col(field), F.array().cast(PAIR_ARRAY))
        return F.transform(arr, lambda p, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("pos"), F.get(p, 0).try_cast("long").alias("event_ms"),
            F.get(p, 1).alias("v")))

    pts = (payloads.select("coin_id", "part", F.inline(F.concat(
        tag(PRICE, KIND_PRICE), tag(VOLUME, KIND_VOLUME), tag(MARKET_CAP, KIND_CAP))))
           .where(event_in_range("event_ms")))
    is_price = (F.col("kind") == KIND_PRICE) & F.col("v").isNotNull()
    return pts.select(
        "coin_id", utc_day("event_ms", 1000).alias("event_date"),
        F.when(is_price, order_key("event_ms", ("part", 14), ("pos", 10))).alias("tick_key"),
        F.when(is_price, F.col("v")).alias("price_usd"),
        F.when(F.col("kind") == KIND_VOLUME, F.col("v")).alias("volume_usd"),
        F.when(F.col("kind") == KIND_CAP, F.col("v")).alias("market_cap_usd"))
