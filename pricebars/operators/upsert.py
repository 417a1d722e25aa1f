"""Keyed upsert of DataFrames (``INSERT ... ON CONFLICT DO UPDATE`` semantics).

The merge is a tagged union followed by one ``groupBy`` on the key, not a full
outer join: it shuffles each side once, needs no broadcast, and a hot key only
costs partial-aggregation work.  On a conflict the incoming row wins for every
column except ``keep_cols``, which keep the stored value; the incoming value wins
even when it is NULL.  With a ``version`` date the newer side wins instead, the incoming one
of equals, so batches may come in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """Keep one row per key: the one with the largest ``order_cols`` (last write
    wins).  An aggregate, so duplicates are collapsed map-side before the shuffle."""
    value_cols = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(
        F.max_by(F.struct(*value_cols), F.struct(*order_cols)).alias("_row"))
    return packed.select(*keys, *[F.col("_row")[c].alias(c) for c in value_cols])


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str],
           keep_cols: list[str] | tuple = (), version: str | None = None) -> DataFrame:
    """Merge ``incoming`` into ``existing`` on ``keys``.

    ``incoming`` must hold at most one row per key (use ``latest_per_key``).
    Running the same batch twice leaves the result unchanged.  ``version`` names a date
    column of both: a row gives way only to one of the same or a later date (NULL is the
    earliest).
    """
    cols = existing.columns
    incoming = incoming.select(*cols)
    replace = [c for c in cols if c not in keys and c not in keep_cols]
    keep = [c for c in cols if c in keep_cols]
    tagged = (existing.withColumn("_src", F.lit(0))
              .unionByName(incoming.withColumn("_src", F.lit(1))))
    # one number: the days of the version, then the side
    days = F.coalesce(F.unix_date(F.col(version)), F.lit(-2**31)) if version else F.lit(0)
    tagged = tagged.withColumn("_age", days.cast("long") * 2 + F.col("_src"))
    aggs = [F.max_by(F.struct(*replace), "_age").alias("_new")]
    if keep:
        aggs.append(F.min_by(F.struct(*keep), "_src").alias("_old"))
    merged = tagged.groupBy(*keys).agg(*aggs)
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
        elif c in keep:
            out.append(F.col("_old")[c].alias(c))
        else:
            out.append(F.col("_new")[c].alias(c))
    return merged.select(*out)


def first_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """Keep the row with the smallest ``order_cols`` per key."""
    value_cols = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(
        F.min_by(F.struct(*value_cols), F.struct(*order_cols)).alias("_row"))
    return packed.select(*keys, *[F.col("_row")[c].alias(c) for c in value_cols])
