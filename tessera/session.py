"""Spark session settings shared by tests, the bench and the catalogue.

On a cluster the session already exists; ``configure`` only fills settings
that are unset, so cluster-level values (shuffle partitions, checkpoint dir)
always win.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes (sort-merge
# joins whose side turns out small become broadcast joins; skewed partitions are
# split), which is the size check behind every join that is not a fixed lookup.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Parquet files are read as timestamp_ntz, so no session-zone shifts.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tessera",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local session for tests and the bench (no UI, UTC, AQE on)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder
        .master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    )
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply defaults that the cluster has not set already."""
    conf = spark.conf
    for k, v in SESSION_DEFAULTS.items():
        if conf.get(k, None) is None:
            conf.set(k, v)
    if _is_local(spark):
        checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    """Driver and executors are one process, so a local folder is shared."""
    master = getattr(spark.sparkContext, "master", "local")
    return master == "local" or master.startswith("local[")


_SCRATCH: dict = {}
# Spark's own switch (4.1): a query's shuffle files go when it has ended.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS/object store) folder at submit time. If
    nothing is set, a local master gets one scratch folder per SparkContext,
    removed when the process ends; any other master raises, as its executors
    could not read each other's files. ``spark.checkpoint.dir`` is a core setting that cannot be
    changed at run time, so the fallback is registered with
    ``setCheckpointDir`` instead.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if path:
        return path
    if not _is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    key = id(spark.sparkContext)
    if key not in _SCRATCH:
        _SCRATCH[key] = tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp")
        atexit.register(shutil.rmtree, _SCRATCH[key], ignore_errors=True)
        spark.sparkContext.setCheckpointDir(_SCRATCH[key])
    return _SCRATCH[key]


def materialize(df, name: str = "step", drop_shuffles: bool = False):
    """Cut lineage by writing ``df`` as a Parquet table in the shared folder.

    This is the stand-in for writing a new table version: each nightly step's
    output (a dimension after a merge) is stored once and later steps read it
    back (with column pruning and filter pushdown) instead of re-planning the
    whole history. One job per call; the files live in the folder named by
    ``spark.checkpoint.dir`` (shared storage on a cluster), so a lost
    executor loses nothing.

    With ``drop_shuffles`` the shuffle files of the job go when it has ended,
    and not when the driver happens to collect its garbage: for a small table
    made from large shuffles, before the next large ones.
    """
    import uuid
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
    before = spark.conf.get(DROP_SHUFFLES, None)
    if drop_shuffles:
        spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if drop_shuffles:
            spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.parquet(path)
