"""Session helpers for tests, the bench and local runs.

Library operators never set session configuration; only these helpers do,
and only for local runs.  On a cluster the caller owns the session.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "txrisk") -> SparkSession:
    """A local session: AQE on, UI off, UTC, Arrow on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call-site capture for error messages walks the Python stack and makes
        # extra JVM calls on every column function; off for batch runs
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TXRISK_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, setting a local one only
    when the session has none and runs in local mode (tests); a cluster
    names a shared folder in ``spark.checkpoint.dir`` and that one is always
    used as is (without it, this raises rather than write machine-local
    files)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; on a cluster it must name a shared "
                "folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="txrisk-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def materialize(df, name: str = "table"):
    """Write ``df`` as Parquet under the session's checkpoint directory (the
    shared folder a cluster names in ``spark.checkpoint.dir``) and return it
    read back.  One job computes and writes; the result has no lineage to
    recompute when an executor is lost."""
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/txrisk-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.parquet(path)
    out._txrisk_path = path
    return out


def discard(df) -> None:
    """Remove the table behind a frame that :func:`materialize` returned (no
    effect on any other frame)."""
    path = getattr(df, "_txrisk_path", None)
    if path:
        jvm = df.sparkSession._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of finished jobs now.  Its cleaner does so
    once the driver's garbage is collected, which on a large heap may be long after
    the last use; a job of many steps calls this after its large ones."""
    import gc

    gc.collect()  # frames in reference cycles hold their plans
    spark._jvm.System.gc()
