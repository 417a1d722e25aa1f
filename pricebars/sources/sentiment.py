"""Market-sentiment index: ``{"data": [{timestamp, value, value_classification}]}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebars.functions.exprs import utc_day

from pricebars.schemas import SENTIMENT_PAYLOAD


def read_sentiment(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Read sentiment JSON files and unnest them into ``(points, rejects)``."""
    raw = (spark.read.schema(SENTIMENT_PAYLOAD).option("multiLine", True)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
           .json(path))
    return sentiment_points(sentiment_records(raw))


def sentiment_records(files: DataFrame) -> DataFrame:
    """``part, pos, rec``: the records of parsed files (a batch or a stream), files in order of
    arrival (modification time), records in order of position."""
    arrived = files.select("data", F.col("_metadata.file_modification_time").alias("modified"))
    return arrived.select(F.unix_micros("modified").alias("part"), F.posexplode("data").alias("pos", "rec"))


def sentiment_points(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed sentiment points from ``part, pos, rec`` rows (``rec`` is the raw
    record struct of strings).

    Absent fields take the reference defaults (timestamp 0, value 0, class "");
    a present but unparsable number goes to ``rejects``.  The date of an epoch
    second is taken in UTC.  ``part, pos`` keep the arrival order, which decides
    the last write of a day.
    """
    ts_txt = F.coalesce(F.col("rec.timestamp"), F.lit("0"))
    val_txt = F.coalesce(F.col("rec.value"), F.lit("0"))
    typed = records.select(
        "part", "pos",
        ts_txt.try_cast("long").alias("epoch_s"),
        val_txt.try_cast("int").alias("value"),
        F.coalesce(F.col("rec.value_classification"), F.lit("")).alias("value_classification"),
        F.col("rec").alias("raw"))
    ok = F.col("epoch_s").isNotNull() & F.col("value").isNotNull()
    points = (typed.where(ok)
              .select(utc_day("epoch_s").alias("event_date"), "value",
                      "value_classification", "part", "pos"))
    rejects = typed.where(~ok).select("part", "pos", "raw")
    return points, rejects
