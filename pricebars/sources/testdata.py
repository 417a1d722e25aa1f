"""Stand-ins built from the driver's generated tables.

* **E** (``events``): ``event_type`` is the coin, ``value`` the price.  Events are
  packed into payload rows shaped like the landed JSON (three ``[ms, value]``
  arrays), one row per coin and slice of ``PART_EVENTS`` consecutive event ids, so
  the unnest path is exercised on data that grows with the table while every
  packed array stays bounded.  Volume is ``value * user_id``, market cap
  ``value * 100``.  ``props.k`` is the sentiment value.
* **D** (``orders`` + ``lineitem``): ``o_orderpriority`` is the coin; each order is
  a tick at its order date (all midnight, ties broken by ``o_orderkey``); volume and
  market cap are the means of the whole-dollar ``l_extendedprice`` and of
  whole-dollar ``l_extendedprice * l_quantity`` per priority and ship date.
  Integer-valued inputs sum exactly in any order, so every engine gets the same
  mean, bit for bit.  This gives a long daily series
  with gaps for the window features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebars.functions.exprs import order_key
from pricebars.operators.bars import roll_up
from pricebars.operators.enrich import coin_dimension, enrich

PART_EVENTS = 1024

# The five order priorities used as coins.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_ticks_flat(events: DataFrame) -> DataFrame:
    """Events as ``coin_id, part, event_id, ms, price, volume, market_cap``."""
    return events.select(
        F.col("event_type").alias("coin_id"),
        F.floor(F.col("event_id") / PART_EVENTS).alias("part"),
        "event_id",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
        F.col("value").alias("price"),
        (F.col("value") * F.col("user_id")).alias("volume"),
        (F.col("value") * F.lit(100.0)).alias("market_cap"))


def event_payloads(events: DataFrame) -> DataFrame:
    """Payload rows ``coin_id, part, prices, market_caps, total_volumes``.

    Arrays are ordered by ``event_id`` so the array position breaks same-ms ties
    exactly like ``event_id`` does."""
    flat = event_ticks_flat(events)
    packed = flat.groupBy("coin_id", "part").agg(
        F.array_sort(F.collect_list(F.struct("event_id", "ms", "price", "volume", "market_cap"))).alias("t"))

    def pairs(field):
        return F.transform("t", lambda x: F.array(x["ms"].cast("double"), x[field]))

    return packed.select("coin_id", "part", pairs("price").alias("prices"),
                         pairs("market_cap").alias("market_caps"), pairs("volume").alias("total_volumes"))


def event_sentiment_payloads(events: DataFrame) -> DataFrame:
    """Sentiment payload rows ``part, data`` shaped like the API answer: ``data`` is
    an array of string records built from ``props.k``, in ``event_id`` order."""
    rec = F.struct(F.unix_seconds(F.col("ts").cast("timestamp")).cast("string").alias("timestamp"),
                   F.get_json_object("props", "$.k").alias("value"),
                   F.col("event_type").alias("value_classification"))
    packed = (events.select(F.floor(F.col("event_id") / PART_EVENTS).alias("part"), "event_id", rec.alias("rec"))
              .groupBy("part").agg(F.array_sort(F.collect_list(F.struct("event_id", "rec"))).alias("t")))
    return packed.select("part", F.transform("t", lambda x: x["rec"]).alias("data"))


def event_sentiment_records(events: DataFrame) -> DataFrame:
    """Unnested sentiment records ``part, pos, rec``."""
    return event_sentiment_payloads(events).select("part", F.posexplode("data").alias("pos", "rec"))


def order_ticks(orders: DataFrame) -> DataFrame:
    """Orders as price ticks ``coin_id, event_date, tick_key, price_usd``."""
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    return (orders.where(F.col("o_totalprice").isNotNull())
            .select(F.col("o_orderpriority").alias("coin_id"),
                    F.to_date("o_orderdate").alias("event_date"),
                    order_key(ms, ("o_orderkey", 19)).alias("tick_key"),
                    F.col("o_totalprice").alias("price_usd")))


def order_measures(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Line items as volume / cap points per priority and ship date."""
    li = lineitem.select("l_orderkey", "l_shipdate", "l_extendedprice", "l_quantity")
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    return (li.join(o, "l_orderkey")
            .select(F.col("o_orderpriority").alias("coin_id"), F.to_date("l_shipdate").alias("event_date"),
                    F.round("l_extendedprice").alias("volume_usd"),
                    (F.round("l_extendedprice") * F.col("l_quantity")).alias("market_cap_usd")))


def priority_dimension(spark: SparkSession) -> DataFrame:
    """Literal dimension: symbol = first character, name = text after the dash."""
    rows = [(p, p[0], p.split("-", 1)[1]) for p in PRIORITIES]
    return coin_dimension(spark, rows)


def order_metrics_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily metrics of the five priorities, before enrichment."""
    orders = table(spark, sf_dir, "orders")
    return roll_up(order_ticks(orders), order_measures(orders, table(spark, sf_dir, "lineitem")))


def order_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base **D**: the enriched daily metrics table (no ``processed_at``)."""
    rows, _ = enrich(order_metrics_raw(spark, sf_dir), priority_dimension(spark))
    return rows


def land_files(rows: DataFrame, folder: str) -> None:
    """Write ``text`` of each row to ``folder/<file_name>``, as a puller would land its answers: Spark
    writes one file per name, which is then given its name."""
    import uuid

    spark = rows.sparkSession
    hidden = f"{folder}/_landing-{uuid.uuid4().hex}"
    rows.select("file_name", "text").repartition("file_name").write.partitionBy("file_name").text(hidden)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    files = fs_path(hidden).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for named in files.listStatus(fs_path(hidden)):
        name = named.getPath().getName().removeprefix("file_name=")
        if named.isDirectory():
            for part in files.listStatus(named.getPath()):
                if part.getPath().getName().startswith("part-"):
                    files.rename(part.getPath(), fs_path(f"{folder}/{name}"))


def pull_files(events: DataFrame) -> DataFrame:
    """``file_name, text``: the payload slices of E as pretty-printed JSON, one file per coin and
    pull (dated a day apart); every tenth pull, from the fourth on, arrives cut in half."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("part").cast("int"))
    text = F.to_json(F.struct("prices", "market_caps", "total_volumes"), {"pretty": "true"})
    half = F.expr("left(text, cast(length(text) / 2 as int))")
    return (event_payloads(events)
            .select(F.concat("coin_id", F.lit("_"), day.cast("string"), F.lit(".json")).alias("file_name"), "part", text.alias("text"))
            .select("file_name", F.when(F.col("part") % 10 == 3, half).otherwise(F.col("text")).alias("text")))


def mood_files(events: DataFrame, wave: int) -> DataFrame:
    """``file_name, text``: sentiment answers of E, one file per day, of the odd or even slices."""
    rec = F.struct(F.unix_seconds(F.col("ts").cast("timestamp")).cast("string").alias("timestamp"),
                   F.get_json_object("props", "$.k").alias("value"), F.col("event_type").alias("value_classification"))
    mine = events.where(F.floor(F.col("event_id") / PART_EVENTS) % 2 == wave)
    packed = (mine.select(F.to_date("ts").alias("day"), "event_id", rec.alias("rec")).groupBy("day")
              .agg(F.array_sort(F.collect_list(F.struct("event_id", "rec"))).alias("t")))
    return packed.select(F.concat(F.col("day").cast("string"), F.lit(f"-{wave}.json")).alias("file_name"),
                         F.to_json(F.struct(F.transform("t", lambda x: x["rec"]).alias("data")), {"pretty": "true"}).alias("text"))
