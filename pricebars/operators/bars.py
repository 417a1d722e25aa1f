"""Daily roll-up of ticks into open / high / low / close bars and daily metrics.

Design: open and close are ``min_by`` / ``max_by`` over the full-precision tick
key (packed into one decimal, see ``order_key``), computed in the same
``groupBy`` as the other aggregates.  Spark runs that as a hash aggregate with
map-side partial aggregation before a single shuffle on ``(coin_id,
event_date)``, so no task ever holds all ticks of a day, however hot one
coin-day is.  Volume and market cap are folded into the same aggregate (payload
arrays are read in one tagged pass, other sources by a tagged union) instead of
two extra aggregates and two joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["coin_id", "event_date"]
BAR_COLUMNS = ["open_price_usd", "close_price_usd", "avg_price_usd", "max_price_usd",
               "min_price_usd", "samples_per_day"]


def _bar_aggs(price: str = "price_usd", key: str = "tick_key"):
    return [
        F.min_by(price, key).alias("open_price_usd"),
        F.max_by(price, key).alias("close_price_usd"),
        F.avg(price).alias("avg_price_usd"),
        F.max(price).alias("max_price_usd"),
        F.min(price).alias("min_price_usd"),
        F.count(price).alias("samples_per_day"),
    ]


def daily_bars(price_ticks: DataFrame) -> DataFrame:
    """One bar per ``(coin_id, event_date)`` from ``price_ticks`` (columns
    ``coin_id, event_date, tick_key, price_usd``)."""
    return price_ticks.groupBy(*KEY).agg(*_bar_aggs())


def daily_mean(points: DataFrame, value_col: str, out_col: str) -> DataFrame:
    """Mean of ``value_col`` per coin and day (NULL values are skipped)."""
    return points.groupBy(*KEY).agg(F.avg(value_col).alias(out_col))


def roll_up(price_ticks: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """Daily metrics from separate price ticks and measure rows (``coin_id,
    event_date, volume_usd, market_cap_usd``, either may be NULL): tagged union,
    then ``roll_up_points``."""
    rows = price_ticks.select(*KEY, "tick_key", "price_usd",
                              F.lit(None).cast("double").alias("volume_usd"),
                              F.lit(None).cast("double").alias("market_cap_usd"))
    if measures is not None:
        key_type = price_ticks.schema["tick_key"].dataType
        rows = rows.unionByName(measures.select(
            *KEY, F.lit(None).cast(key_type).alias("tick_key"),
            F.lit(None).cast("double").alias("price_usd"),
            F.col("volume_usd").cast("double").alias("volume_usd"),
            F.col("market_cap_usd").cast("double").alias("market_cap_usd")))
    return roll_up_points(rows)


def roll_up_points(points: DataFrame) -> DataFrame:
    """Daily metrics from tagged points (``coin_id, event_date, tick_key,
    price_usd, volume_usd, market_cap_usd``), one shuffle.

    Days come from the price side only; a day without volume or cap gets 0.0; a
    measure-only day is dropped."""
    agg = (points.groupBy(*KEY)
           .agg(*_bar_aggs(), F.avg("volume_usd").alias("volume_usd"),
                F.avg("market_cap_usd").alias("market_cap_usd"))
           .where(F.col("samples_per_day") > 0))
    return agg.fillna(0.0, subset=["volume_usd", "market_cap_usd"])


def daily_metrics(payloads: DataFrame, processed_at: bool = True) -> DataFrame:
    """Payload rows of all coins -> daily metrics of all coins, in one job."""
    from pricebars.operators.ticks import tagged_points

    out = roll_up_points(tagged_points(payloads))
    cols = KEY + BAR_COLUMNS + ["volume_usd", "market_cap_usd"]
    out = out.select(*cols)
    if processed_at:
        out = out.withColumn("processed_at", F.current_timestamp())
    return out


def pulled_metrics(payloads: DataFrame) -> DataFrame:
    """Daily metrics of all pulls (``coin_id``, ``logical_date``): each pull is rolled up
    by itself, and of the pulls that hold a day the newest decides it.  So the result
    does not depend on how files are batched, and no pull's days are lost.  The date of the
    pull that decided comes with each row."""
    pulls = daily_metrics(payloads.withColumn("coin_id", F.struct("coin_id", "logical_date")))
    rest = [c for c in pulls.columns if c not in KEY]
    newest = pulls.groupBy(F.col("coin_id.coin_id").alias("coin_id"), "event_date").agg(
        F.max_by(F.struct(*rest), "coin_id.logical_date").alias("m"), F.max("coin_id.logical_date").alias("logical_date"))
    return newest.select(*KEY, *(F.col(f"m.{c}").alias(c) for c in rest), "logical_date")


def tick_open_close(price_ticks: DataFrame) -> DataFrame:
    """Each tick with its day's first and last price (the reference's full-frame
    window form).  Expressed as a partially aggregated ``groupBy`` joined back on
    ``(coin_id, event_date)``, with the daily rows as the hashed side: the ticks are
    never broadcast or built on, and AQE splits a skewed coin-day, which a window
    over the whole day could not do."""
    day = price_ticks.groupBy(*KEY).agg(F.min_by("price_usd", "tick_key").alias("open_price_usd"),
                                        F.max_by("price_usd", "tick_key").alias("close_price_usd"))
    return price_ticks.join(day.hint("shuffle_hash"), KEY, "inner")


def bars_from_enriched(enriched: DataFrame) -> DataFrame:
    """Group enriched ticks by day and their open / close, as the reference does."""
    return (enriched.groupBy(*KEY, "open_price_usd", "close_price_usd")
            .agg(F.avg("price_usd").alias("avg_price_usd"), F.max("price_usd").alias("max_price_usd"),
                 F.min("price_usd").alias("min_price_usd"), F.count(F.lit(1)).alias("samples_per_day")))
