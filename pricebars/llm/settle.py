"""Intermediate tables in the shared folder, and joins whose broadcast is bounded."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebars.session import ensure_checkpoint_dir

BROADCAST_ROWS = 1_000_000
HOT_SHARE = 10_000
PART_SHARE = 1_000
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark) -> Iterator[None]:
    """Within it, shuffle files are removed as soon as the job that wrote them has ended.  For frames made and
    run within it that write a table or give a number: a checkpointed frame holds its shuffles on disk as long as it
    is referred to, though nothing reads them again."""
    before = spark.conf.get(FREED)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """``checkpoint()`` that leaves no shuffle files."""
    with shuffles_freed(df.sparkSession):
        return df.select("*").checkpoint()  # a frame made within: the setting is read when a frame is made


def settled(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read again: cuts the
    lineage as ``checkpoint()`` does, compressed and by column, without shuffle files left."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.settled_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes settled tables that nothing reads any more: all that came of them has been written."""
    for table in tables:
        spark = table.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(table.settled_path)
        where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def rows_of(table: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``table`` whose ``key`` (a long or a short digest) is among those of ``ids``.  Up to
    ``BROADCAST_ROWS`` ids are counted and broadcast, so the table is not shuffled;
    more are joined by shuffle."""
    ids = ids.select(key).distinct().transform(checkpointed)
    with shuffles_freed(ids.sparkSession):
        few = ids.count() <= BROADCAST_ROWS
    return table.join(F.broadcast(ids) if few else ids, key, "left_semi")


def hot_of(counts: DataFrame, key: str, total: int) -> DataFrame:
    """``(key, _parts)`` of the keys whose count ``_n`` is more than one in ``HOT_SHARE`` of
    ``total``, so fewer than ``HOT_SHARE`` keys at any size; each is worth ``_parts`` parts of
    at most one in ``PART_SHARE``.  ``total`` is at least the sum of the counts."""
    parts = F.ceil(F.col("_n") * PART_SHARE / F.lit(max(total, 1))).cast("int")
    return counts.filter(F.col("_n") * HOT_SHARE > total).select(key, parts.alias("_parts")).transform(checkpointed)


def hot_keys(table: DataFrame, key: str, total: int | None = None) -> DataFrame:
    """The hot keys of ``table``; ``total`` may be any upper bound of its rows."""
    if total is None:
        with shuffles_freed(table.sparkSession):
            total = table.count()
    return hot_of(table.groupBy(key).agg(F.count(key).alias("_n")), key, total)  # NULL keys match nothing


def beside(table: DataFrame, key: str, summary: Callable[[DataFrame], DataFrame], total: int | None = None) -> DataFrame:
    """Rows of ``table``, each with the row that ``summary`` (a grouped aggregate of a few
    numbers for each ``key``) gives for its key; an inner join.  Rows of hot keys stay where
    they are and meet a broadcast of fewer than ``HOT_SHARE`` rows; the rest is shuffled."""
    hot = F.broadcast(hot_keys(table, key, total).select(key))
    often, rest = table.join(hot, key, "left_semi"), table.join(hot, key, "left_anti")
    return often.join(F.broadcast(summary(often)), key).unionByName(rest.join(summary(rest), key))


def spread_join(table: DataFrame, one_each: DataFrame, key: str, by: str | list[str], how: str = "inner", hot: DataFrame | None = None,
                dealt_alike: bool = False) -> DataFrame:
    """``table`` joined with ``one_each`` (at most one row per ``key``, of any width).  Rows of
    a hot key are dealt by ``by`` and the task they come from into parts, each joined with
    a copy of the key's row: fewer than ``HOT_SHARE + PART_SHARE`` copies in all.  Rows with
    a NULL key, which match nothing, are dealt too.  ``hot``: the hot keys, if known.  ``dealt_alike``:
    by ``by`` alone, and ``_part`` stays, so an aggregate over ``key``, ``_part`` and more needs no other exchange."""
    hot = F.broadcast(hot_keys(table, key) if hot is None else hot)
    parts = F.coalesce("_parts", F.lit(1))
    wide = F.when(F.col(key).isNull(), PART_SHARE).otherwise(parts)
    by = [by] if isinstance(by, str) else by
    dealt = table.join(hot, key, "left").withColumn("_part", F.pmod(F.xxhash64(*by, *[] if dealt_alike else [F.spark_partition_id()]), wide).cast("int")).drop("_parts")
    copies = one_each.join(hot, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    out = dealt.join(copies, [key, "_part"], how)
    return out if dealt_alike else out.drop("_part")
