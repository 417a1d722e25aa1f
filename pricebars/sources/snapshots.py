"""Parquet tables whose every change becomes visible at once.

A change writes its rows to a new folder ``data/batch=<id>``, then a manifest (which batch holds
each partition) to a hidden folder, and publishes it by one rename to ``commits/<n>``, where
``n`` follows the version it started from.  Readers follow the newest manifest.  A job that
ends anywhere before the rename leaves the table as it was; what it wrote is never read and
goes with a later ``collect_old``.  Of two writers that start from one version the second
finds its number taken, and has to run again from the newer table: no change is lost.

The rename must be atomic and refuse an existing target, as on HDFS and local disks.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

MANIFEST = StructType([StructField("part", StringType()), StructField("batch", StringType())])


class Conflict(RuntimeError):
    """Another job has committed the version that this one was about to write."""


def _files(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def _names(spark: SparkSession, path: str) -> list[str]:
    files, where = _files(spark, path)
    return [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """The committed versions of the table, oldest first."""
    return sorted(int(n) for n in _names(spark, f"{path}/commits") if n.isdigit())


def exists(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))


def manifest(spark: SparkSession, path: str, version: int | None) -> DataFrame:
    """``(part, batch)`` of a version; no rows for None."""
    if version is None:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{path}/commits/{version}")


def latest(spark: SparkSession, path: str) -> int | None:
    known = versions(spark, path)
    return known[-1] if known else None


def read(spark: SparkSession, path: str, schema: StructType, by: str | None = None, version: int | None = None) -> DataFrame:
    """The rows of the newest version, or of an older one while it is kept."""
    version = latest(spark, path) if version is None else version
    if version is None:
        raise FileNotFoundError(f"no committed version of a table at {path}")
    live = manifest(spark, path, version)
    batches = sorted(r["batch"] for r in live.select("batch").distinct().collect())
    if not batches:
        return spark.createDataFrame([], schema)
    stored = StructType([*schema.fields, StructField("batch", StringType())])
    rows = (spark.read.schema(stored).option("basePath", f"{path}/data")
            .parquet(*[f"{path}/data/batch={b}" for b in batches]))
    if by and len(batches) > 1:  # some partitions of the older batches have given way to newer ones
        same = F.col(by).eqNullSafe(F.col("part")) & (F.col("batch") == F.col("_batch"))
        rows = rows.join(live.withColumnRenamed("batch", "_batch"), same, "left_semi")
    return rows.select(*schema.fieldNames())


def replace(spark: SparkSession, path: str, rows: DataFrame, by: str | None = None, order: str | None = None,
            base: int | None = None) -> int:
    """Commit a version in which the partitions that ``rows`` has (by the values of ``by``; the whole
    table without it) hold exactly these rows and all others are as in version ``base`` (the
    newest by default; name the one that ``rows`` were made from).  Returns its number."""
    base = latest(spark, path) if base is None else base
    batch = uuid.uuid4().hex
    target = f"{path}/data/batch={batch}"
    if by:
        laid = rows.repartition(by)
        (laid.sortWithinPartitions(by, order) if order else laid).write.partitionBy(by).parquet(target)
        written = spark.read.schema(StructType([StructField(by, StringType())])).parquet(target).select(F.col(by).alias("part")).distinct()
        new = written.withColumn("batch", F.lit(batch))
        old = manifest(spark, path, base)
        live = old.join(new.select(F.col("part").alias("_part")), F.col("part").eqNullSafe(F.col("_part")), "left_anti").unionByName(new)
    else:
        rows.write.parquet(target)
        live = spark.createDataFrame([(None, batch)], MANIFEST)
    return publish(spark, path, live, (base or 0) + 1)


def publish(spark: SparkSession, path: str, live: DataFrame, number: int) -> int:
    """Write a manifest and make it version ``number``, or raise ``Conflict`` if there is one."""
    hidden = f"{path}/_writing-{uuid.uuid4().hex}"
    live.coalesce(1).write.parquet(hidden)
    files, source = _files(spark, hidden)
    target = _files(spark, f"{path}/commits/{number}")[1]
    files.mkdirs(target.getParent())
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri() if source.toUri().getScheme() else files.getUri(),
                                                                  spark._jsparkSession.sessionState().newHadoopConf())
    try:
        context.rename(source, target, gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
    except Py4JJavaError as taken:
        if "FileAlreadyExistsException" not in str(taken.java_exception.getClass().getName()):
            raise
        raise Conflict(f"version {number} of {path} is taken; run the change again from the newest version") from None
    return number


def collect_old(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all versions but the newest ``keep`` and every batch that none of these needs.  For
    times when no job writes to the table or reads an older version of it."""
    known = versions(spark, path)
    kept = known[-keep:]
    needed = {r["batch"] for v in kept for r in manifest(spark, path, v).select("batch").distinct().collect()}
    gone = [f"commits/{v}" for v in known if v not in kept]
    gone += [f"data/{n}" for n in _names(spark, f"{path}/data") if n.startswith("batch=") and n[6:] not in needed]
    gone += [n for n in _names(spark, path) if n.startswith("_writing-")]
    for name in gone:
        files, where = _files(spark, f"{path}/{name}")
        files.delete(where, True)
