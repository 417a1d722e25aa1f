"""The refresh job: landed payload and sentiment files -> daily metrics and sentiment tables.

``refresh_batch`` processes every file under a folder.  ``refresh_stream`` and
``sentiment_stream`` run the same work incrementally as Structured Streaming file sources
with the ``availableNow`` trigger, each with its own progress in its own checkpoint folder:
every run (e.g. every six hours, ``refresh_run``) picks up only files that landed since the last
one.  Each micro-batch is parsed once, staged, and folded into its table with an idempotent
upsert, so a batch that is replayed after a failure changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pricebars.operators.bars import pulled_metrics
from pricebars.operators.enrich import coin_dimension, enrich
from pricebars.schemas import SENTIMENT_PAYLOAD
from pricebars.session import materialize
from pricebars.sources.payloads import file_texts, split_rejects, stage_payloads, staged
from pricebars.sources.sentiment import read_sentiment, sentiment_records, sentiment_points
from pricebars.sources.tables import append_raw, upsert_metrics_table, upsert_sentiment_table


def load_good_payloads(spark: SparkSession, good: DataFrame, table_path: str, dim: DataFrame | None = None) -> DataFrame:
    """Roll up good payload rows, enrich and upsert them; returns a report of the files
    of coins missing from the dimension (not loaded).  The daily rows are staged once;
    the report reads file names alone, no ticks."""
    dim = dim if dim is not None else coin_dimension(spark)
    rows, _ = enrich(pulled_metrics(good), dim)
    upsert_metrics_table(spark, table_path, materialize(rows))
    return (good.where("part = 0").join(dim.select("coin_id"), "coin_id", "left_anti")
            .select("file_name", "coin_id", "logical_date", F.lit("unknown coin").alias("reason")))


def load_sentiment(spark: SparkSession, sentiment_path: str, table_path: str) -> DataFrame:
    """Upsert the sentiment files into their table; returns the records rejected."""
    points, rejects = read_sentiment(spark, sentiment_path)
    upsert_sentiment_table(spark, table_path, points)
    return rejects


def land_staged(tagged: DataFrame, raw_log: str) -> None:
    """Append the texts of staged files to the raw log."""
    append_raw(tagged.where("part = 0"), raw_log)


def refresh_batch(spark: SparkSession, raw_path: str, table_path: str, dim: DataFrame | None = None,
                  raw_log: str | None = None, sentiment: tuple[str, str] | None = None) -> DataFrame:
    """One refresh over all files under ``raw_path``; returns the rejects report
    (``file_name, coin_id, logical_date, reason``).  Raises when no file holds a
    usable price tick.  With ``raw_log`` the files are also appended to the raw
    landing log first, and with ``sentiment`` (folder of files, table) the sentiment
    files of the run are loaded as well."""
    tagged = stage_payloads(spark, raw_path, with_text=raw_log is not None)
    if raw_log:
        land_staged(tagged, raw_log)
    good, rejects = split_rejects(tagged)
    if good.isEmpty():
        raise ValueError(f"no usable payload under {raw_path}")
    if sentiment:
        load_sentiment(spark, *sentiment)
    return rejects.unionByName(load_good_payloads(spark, good, table_path, dim))


def refresh_stream(spark: SparkSession, raw_dir: str, table_path: str, checkpoint: str, dim: DataFrame | None = None,
                   rejects_path: str | None = None, raw_log: str | None = None) -> StreamingQuery:
    """Start an ``availableNow`` stream over ``raw_dir``; returns the query
    (call ``awaitTermination()``).  ``checkpoint`` is the stream's own lasting folder: a
    later session that names it again picks up only new files.  With ``rejects_path``
    the rejects report of every batch is appended there, as the batch refresh returns it,
    and with ``raw_log`` the files' texts to the raw log."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        tagged = staged(batch, with_text=raw_log is not None)
        if raw_log:
            land_staged(tagged, raw_log)
        good, rejects = split_rejects(tagged)
        if not good.isEmpty():
            rejects = rejects.unionByName(load_good_payloads(batch.sparkSession, good, table_path, dim))
        if rejects_path:
            rejects.write.mode("append").parquet(rejects_path)

    return (file_texts(spark.readStream, raw_dir).writeStream.foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def sentiment_stream(spark: SparkSession, sentiment_dir: str, table_path: str, checkpoint: str,
                     rejects_path: str | None = None) -> StreamingQuery:
    """Start an ``availableNow`` stream that folds new sentiment files into their table.  As in
    ``refresh_stream``, ``checkpoint`` keeps which files were loaded; files of a batch count in
    the order of their arrival."""
    files = (spark.readStream.schema(SENTIMENT_PAYLOAD).option("multiLine", True).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", "_corrupt_record").json(sentiment_dir))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        points, rejects = sentiment_points(materialize(batch))
        upsert_sentiment_table(batch.sparkSession, table_path, points)
        if rejects_path:
            rejects.write.mode("append").parquet(rejects_path)

    return (sentiment_records(files).writeStream.foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def refresh_run(spark: SparkSession, raw_dir: str, table_path: str, sentiment_dir: str, sentiment_table: str,
                checkpoint: str, **more) -> None:
    """One run of both streams, to be called on a schedule: prices and sentiment that landed
    since the last run.  ``more`` goes to ``refresh_stream``.  A failure of one stream is raised after the
    other one has ended; the next run takes up what is left."""
    queries = [refresh_stream(spark, raw_dir, table_path, f"{checkpoint}/prices", **more),
               sentiment_stream(spark, sentiment_dir, sentiment_table, f"{checkpoint}/sentiment")]
    failed = None
    for query in queries:
        try:
            query.awaitTermination()
        except Exception as error:  # raised below
            failed = failed or error
    if failed:
        raise failed
