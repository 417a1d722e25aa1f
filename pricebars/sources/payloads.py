"""Market payload files: ``{coin_id}_{yyyy-MM-dd}.json``, one JSON object each.

Every file is opened and parsed once: ``stage_payloads`` writes the parsed rows to the shared
staging folder, and the guard, the load, the raw log and the report all read from there.  A
file's arrays are cut into rows of at most ``PART_PAIRS`` pairs each, so what follows the parse
of a large file is dealt over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader

from pricebars.functions.exprs import event_in_range
from pricebars.schemas import PAIR_ARRAY, PAYLOAD

FILE_NAME_PATTERN = r"^(.+)_(\d{4}-\d{2}-\d{2})\.json$"
PART_PAIRS = 65_536
ARRAYS = ("prices", "market_caps", "total_volumes")


def file_texts(reader: DataFrameReader, path: str) -> DataFrame:
    """``coin_id, logical_date, payload, file_name`` of every file; ``reader`` is ``spark.read``
    or ``spark.readStream``.  Coin and date are NULL where the name does not tell them."""
    files = reader.text(path, wholetext=True).select(
        F.col("value").alias("payload"), F.col("_metadata.file_name").alias("file_name"))
    coin, day = (F.regexp_extract("file_name", FILE_NAME_PATTERN, k) for k in (1, 2))
    return files.select(F.when(coin != "", coin).alias("coin_id"), F.to_date(F.when(day != "", day)).alias("logical_date"),
                        "payload", "file_name")


def parsed(files: DataFrame) -> DataFrame:
    """``file_texts`` with the arrays and the ``_corrupt_record`` of the JSON object (as the JSON
    source gives them in permissive mode)."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    body = files.withColumn("_p", F.from_json("payload", PAYLOAD, options))
    broken = F.coalesce(F.col("_p._corrupt_record"), F.when(F.col("_p").isNull(), F.col("payload")), F.when(F.col("payload").isNull(), F.lit("")))
    return body.select(*files.columns, *[F.col(f"_p.{a}").alias(a) for a in ARRAYS], broken.alias("_corrupt_record"))


def _cut(part: Column, size: int) -> list[Column]:
    return [F.slice(F.coalesce(F.col(a), F.array().cast(PAIR_ARRAY)), part * size + 1, size).alias(a) for a in ARRAYS]


def in_parts(raw: DataFrame, size: int = PART_PAIRS) -> DataFrame:
    """Tagged payload rows, one per part of a file: the columns of ``raw`` that are told per file
    come with part 0 only (``payload``, ``reason``, ``odd``), the arrays with their part."""
    coin = F.regexp_extract("file_name", FILE_NAME_PATTERN, 1)
    day = F.regexp_extract("file_name", FILE_NAME_PATTERN, 2)
    ticks = F.coalesce("prices", F.array().cast(PAIR_ARRAY))
    usable = F.exists(ticks, lambda p: event_in_range(F.get(p, 0)) & F.get(p, 1).isNotNull())
    odd = F.exists(ticks, lambda p: ~event_in_range(F.get(p, 0)))
    reason = (F.when(F.col("_corrupt_record").isNotNull(), F.lit("malformed json"))
              .when(coin == "", F.lit("unrecognised file name"))
              .when(~usable, F.lit("no usable price tick")))
    tagged = raw.select(
        F.when(coin != "", coin).alias("coin_id"), F.to_date(F.when(day != "", day)).alias("logical_date"), "file_name",
        *(["payload"] if "payload" in raw.columns else []), *ARRAYS, reason.alias("reason"), F.coalesce(odd, F.lit(False)).alias("odd"))
    longest = F.greatest(*[F.coalesce(F.size(a), F.lit(0)) for a in ARRAYS])
    # a file that is not loaded has one part, without arrays
    parts = F.when(F.col("reason").isNull(), F.ceil(longest / size)).otherwise(1).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1),
                         lambda k: F.struct(k.cast("long").alias("part"), *_cut(k, size)))
    whole = [c for c in tagged.columns if c not in ARRAYS]
    cut = tagged.select(*whole, F.inline(pieces))
    if "payload" in whole:
        cut = cut.withColumn("payload", F.when(F.col("part") == 0, F.col("payload")))
    return cut


def split_rejects(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)`` of tagged rows (see ``read_payloads``)."""
    good = (tagged.where(F.col("reason").isNull())
            .select("coin_id", "logical_date", "part", *ARRAYS, "file_name"))
    # a file with some ticks out of range is loaded without them, and reported
    told = F.coalesce("reason", F.when(F.col("odd"), F.lit("tick time out of range")))
    rejects = (tagged.where(F.col("part") == 0).select("file_name", "coin_id", "logical_date", told.alias("reason"))
               .where(F.col("reason").isNotNull()))
    return good, rejects


def tag_payloads(raw: DataFrame, size: int = PART_PAIRS) -> tuple[DataFrame, DataFrame]:
    """Split parsed payload rows (arrays, ``_corrupt_record`` and ``file_name``) into ``(good, rejects)``."""
    return split_rejects(in_parts(raw, size))


def staged(files: DataFrame, with_text: bool = False) -> DataFrame:
    """Tagged rows of ``file_texts``, parsed by one job into the shared staging folder."""
    from pricebars.sources.tables import staging_path

    rows = in_parts(parsed(files))
    rows = rows if with_text else rows.drop("payload")
    spark = files.sparkSession
    path = staging_path(spark, "payloads")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def stage_payloads(spark: SparkSession, path: str, with_text: bool = False) -> DataFrame:
    """Tagged rows of every file under ``path``; with ``with_text`` part 0 has the file's text."""
    return staged(file_texts(spark.read, path), with_text)


def read_payloads(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Read every payload file under ``path`` in one job.

    Returns ``(good, rejects)``.  ``good`` has ``coin_id, logical_date, part,
    prices, market_caps, total_volumes, file_name``, a row for each part of a file; a file
    that does not parse, has an unrecognised name or carries no usable price tick lands in
    ``rejects`` with a ``reason`` and never blocks the other coins.
    """
    return split_rejects(stage_payloads(spark, path))
