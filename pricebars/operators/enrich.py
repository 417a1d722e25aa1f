"""Dimension lookup and load-time normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebars.functions.exprs import zero_if_missing
from pricebars.schemas import COIN_DIM, SUPPORTED_COINS


def coin_dimension(spark: SparkSession, rows=None) -> DataFrame:
    """The coin dimension ``(coin_id, coin_symbol, coin_name)``; a literal table."""
    return spark.createDataFrame(list(rows or SUPPORTED_COINS), COIN_DIM)


def enrich(metrics: DataFrame, dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Attach symbol and name and normalise types before a load.

    Returns ``(rows, rejects)``: rows of unknown coins go to ``rejects`` instead of
    failing the batch.  The planner broadcasts the dimension while it is within its
    size limit, as the literal table of supported coins is.
    """
    dim = dim.select("coin_id", "coin_symbol", "coin_name")
    more = [c for c in ("processed_at", "logical_date") if c in metrics.columns]
    typed = metrics.select(
        "coin_id", "event_date",
        *[F.col(c).cast("double").alias(c) for c in
          ("open_price_usd", "close_price_usd", "avg_price_usd", "max_price_usd", "min_price_usd")],
        zero_if_missing("volume_usd").alias("volume_usd"),
        zero_if_missing("market_cap_usd").alias("market_cap_usd"),
        F.col("samples_per_day").cast("long").alias("samples_per_day"),
        *more,
    )
    rows = typed.join(dim, "coin_id", "inner")
    order = ["coin_id", "coin_symbol", "coin_name", "event_date", "open_price_usd", "close_price_usd",
             "avg_price_usd", "max_price_usd", "min_price_usd", "volume_usd", "market_cap_usd",
             "samples_per_day", *more]
    rejects = metrics.join(dim.select("coin_id"), "coin_id", "left_anti")
    return rows.select(*order), rejects
