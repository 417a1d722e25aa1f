"""Spark session helpers.

The library itself never creates a session; callers pass one in.  These helpers
exist for tests, the bench and the command-line entry points.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC dates (the reference pins UTC), ANSI left on,
# AQE for runtime coalescing and skew-join splitting.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Size post-shuffle partitions by bytes (advisory 64 MB), not by the core
    # count: small daily tables then run as a few tasks, big ones stay split.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Feature frames carry ~50 derived columns under a 48-way not-null filter;
    # inferring constraints over them costs the planner far more than it saves.
    "spark.sql.constraintPropagation.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20

RUNTIME_CONF = {k: v for k, v in BASE_CONF.items() if k.startswith("spark.sql.")}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the library relies on (UTC dates first)
    to a session someone else built."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            try:
                spark.conf.set(k, v)
            except Exception:  # not modifiable in this deployment
                pass
    return spark


def cluster_conf(total_cores: int, largest_shuffle_bytes: float, checkpoint_dir: str) -> dict:
    """Starting settings for a large cluster (add to ``build_session(extra=...)``
    or ``spark-submit --conf``).

    AQE can merge small shuffle partitions but never split beyond the initial
    count (skew splitting aside), so the initial count is sized for the largest
    shuffle at ~256 MB per partition, and at least 3 waves of the cores.  The
    roll-ups shuffle partially aggregated rows only, so their shuffles are far
    smaller than their input; the sizing guards the joins and the upsert."""
    partitions = max(3 * total_cores, int(largest_shuffle_bytes // (256 * 1024 * 1024)) + 1)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.checkpoint.dir": checkpoint_dir,
    }


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "pricebars",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static confs on an existing session
                pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is always respected.  Only
    when it is unset (tests, a laptop) do we pick a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
        configured = tempfile.mkdtemp(prefix="pricebars-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return configured


def bounded_batches(spark: SparkSession) -> None:
    """From now on in this session, Arrow batches of at most ``BATCH_BYTES``, for jobs over whole texts: Spark's
    own bound lets 10,000 of them into one batch, which the executor and each of its Python processes hold several
    times over.  A bound that someone chose stays."""
    if spark.conf.get(BATCH_CONF, None) in (None, "67108864b", "64m", "64MB"):
        spark.conf.set(BATCH_CONF, f"{BATCH_BYTES}b")


def materialize(df):
    """Reliable checkpoint into the session's ``spark.checkpoint.dir`` (shared
    storage on a cluster), for frames that several jobs read: a lost executor must
    not replay the whole lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
