"""Parquet tables: daily metrics, sentiment and the raw landing log.

The daily metrics and sentiment tables are snapshot tables (see ``snapshots``): a change is
written beside the old state and becomes visible by one rename, so a job that fails on the
way leaves the table readable as it was.  The metrics table is partitioned by ``coin_id`` and
sorted by date inside each file: a one-coin read prunes to that coin's folders, a date range
prunes row groups, and an upsert rewrites only the coins it touches.  Each row keeps the
logical date of the pull that decided it; an older pull never replaces a newer one's rows,
whatever the order in which they arrive.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebars.functions.exprs import order_key
from pricebars.operators.upsert import latest_per_key, upsert
from pricebars.schemas import DAILY_METRICS, METRICS_TABLE, RAW_LOG, SENTIMENT
from pricebars.session import ensure_checkpoint_dir
from pricebars.sources import snapshots

METRICS_KEY = ["coin_id", "event_date"]
METRICS_KEEP = ["coin_symbol", "coin_name"]
VERSION = "logical_date"
ATTEMPTS = 3


def _versioned(df: DataFrame, default) -> DataFrame:
    """The table's columns, NULL where ``df`` has none; rows without a logical date get ``default``."""
    given = {VERSION: default}
    return df.select(*[F.col(f.name) if f.name in df.columns else given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in METRICS_TABLE.fields])


def write_metrics(df: DataFrame, path: str) -> None:
    """Write daily metrics partitioned by coin, date-sorted inside each file.  Coins that ``df``
    does not have stay as they are."""
    snapshots.replace(df.sparkSession, path, _versioned(df, F.lit(None)), "coin_id", "event_date")


def read_metrics(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return snapshots.read(spark, path, METRICS_TABLE, "coin_id", version).select(*DAILY_METRICS.fieldNames())


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/staging/{name}-{uuid.uuid4().hex}"


def _from_newest(spark: SparkSession, path: str, change: Callable[[int | None], None]) -> None:
    """Apply ``change`` to the newest version, again if another job commits in between."""
    for attempt in range(ATTEMPTS):
        try:
            return change(snapshots.latest(spark, path))
        except snapshots.Conflict:
            if attempt == ATTEMPTS - 1:
                raise


def upsert_metrics_table(spark: SparkSession, path: str, incoming: DataFrame) -> None:
    """Upsert ``incoming`` daily rows into the table at ``path`` (a new one, if there is none).

    Only the partitions of coins present in ``incoming`` are read and rewritten (a semi join on
    the partition column lets Spark prune the rest).  A row replaces the stored one if its
    ``logical_date`` is not older; rows without that column are as of today.
    """
    incoming = latest_per_key(_versioned(incoming, F.current_date()), METRICS_KEY, [VERSION, "processed_at"])

    def change(base: int | None) -> None:
        merged = incoming
        if base is not None:
            touched = incoming.select("coin_id").distinct()
            stored = snapshots.read(spark, path, METRICS_TABLE, "coin_id", base).join(touched, "coin_id", "left_semi")
            merged = upsert(stored, incoming, METRICS_KEY, METRICS_KEEP, VERSION)
        snapshots.replace(spark, path, merged, "coin_id", "event_date", base)

    _from_newest(spark, path, change)


def upsert_sentiment(existing: DataFrame, points: DataFrame) -> DataFrame:
    """Upsert sentiment points (last write of a day wins) into the sentiment table.

    The reference's conflict clause updates value and class but keeps the stored
    ``inserted_at``."""
    incoming = latest_per_key(points.select("event_date", "value", "value_classification", "part", "pos"),
                              ["event_date"], ["part", "pos"])
    incoming = incoming.select("event_date", "value", "value_classification",
                               F.current_timestamp().alias("inserted_at"))
    return upsert(existing.select(*SENTIMENT.fieldNames()), incoming, ["event_date"], ["inserted_at"])


def read_sentiment_table(spark: SparkSession, path: str) -> DataFrame:
    return snapshots.read(spark, path, SENTIMENT)


def upsert_sentiment_table(spark: SparkSession, path: str, points: DataFrame, exists: bool = True) -> None:
    """Upsert sentiment points into the sentiment table (one row per day, so the table is small
    and a version holds all of it).  Without ``exists`` what is there is not read."""

    def change(base: int | None) -> None:
        known = exists and base is not None
        stored = snapshots.read(spark, path, SENTIMENT, version=base) if known else spark.createDataFrame([], SENTIMENT)
        snapshots.replace(spark, path, upsert_sentiment(stored, points), base=base)

    _from_newest(spark, path, change)


def land_raw(spark: SparkSession, raw_path: str, log_path: str) -> None:
    """Append every payload file under ``raw_path`` to the raw log, one row per
    file (the whole file text; files are bounded API answers).  A file whose name
    does not match is kept too, without coin and date."""
    from pricebars.sources.payloads import file_texts

    append_raw(file_texts(spark.read, raw_path), log_path)


def append_raw(payload_rows: DataFrame, path: str) -> None:
    """Append landed payloads to the raw log (``coin_id, logical_date, payload``)."""
    (payload_rows.select("coin_id", "logical_date", "payload",
                         F.current_timestamp().alias("inserted_at"))
     .write.mode("append").parquet(path))


LANDED = ["landed_file", "landed_row"]


def latest_raw(log: DataFrame, tie_breaker: str | None = None) -> DataFrame:
    """Newest landed payload per ``(coin_id, logical_date)``: the log appends a
    copy per re-run, readers see only the newest.

    Late materialisation: the newest entry of each key is found from numbers alone, then a
    semi join fetches its text, so no payload goes through an aggregate.  Entries of one
    moment are told apart by ``tie_breaker`` (a whole number of up to 19 digits, unique within a key
    and moment), or by where they lie in the log (``read_raw``)."""
    if tie_breaker is None and not set(LANDED) <= set(log.columns):
        return latest_per_key(log, ["coin_id", "logical_date"], ["inserted_at", "payload"])
    more = [(tie_breaker, 19)] if tie_breaker else [("landed_file", 9), ("landed_row", 10)]
    keyed = log.withColumn("_age", order_key(F.coalesce(F.unix_micros("inserted_at"), F.lit(0)), *more))
    newest = keyed.groupBy("coin_id", "logical_date").agg(F.max("_age").alias("_newest"))
    newest = newest.select(F.col("coin_id").alias("_coin"), F.col("logical_date").alias("_day"), "_newest")
    same = (F.col("coin_id").eqNullSafe(F.col("_coin")) & F.col("logical_date").eqNullSafe(F.col("_day"))
            & (F.col("_age") == F.col("_newest")))
    return keyed.join(newest, same, "left_semi").select(*[c for c in log.columns if c not in LANDED])


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The raw log, with a number of the file and the row of each entry."""
    log = spark.read.schema(RAW_LOG).parquet(path)
    return log.select("*", F.pmod(F.xxhash64("_metadata.file_path"), F.lit(10**9)).alias("landed_file"),
                      F.col("_metadata.row_index").alias("landed_row"))


def export_csv(df: DataFrame, path: str) -> None:
    """Full-frame CSV export with a header row."""
    df.write.mode("overwrite").option("header", True).csv(path)


def first_non_empty(primary: DataFrame, *fallbacks: DataFrame) -> DataFrame:
    """Rows of the first source that has any, trying ``primary`` then each
    fallback in order (all with the same columns).

    Lazily planned: each fallback is anti-joined against at most one probe row
    of every source before it, so no count or collect runs on the driver."""
    out, earlier = primary, [primary]
    for fb in fallbacks:
        guarded = fb
        for prev in earlier:
            guarded = guarded.join(prev.select(F.lit(1).alias("_probe")).limit(1), how="left_anti")
        out = out.unionByName(guarded)
        earlier.append(fb)
    return out
