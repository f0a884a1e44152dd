"""Session helpers. Nothing here is needed to use the library on an existing session."""

from __future__ import annotations

import atexit
import contextlib
from collections.abc import Iterator
from uuid import uuid4

from pyspark.sql import SparkSession

# Ask the adaptive planner to split hot join partitions even where that costs one more shuffle.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Checkpoint files go when no frame refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(name: str = "marquee", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session, which the cluster names in ``spark.checkpoint.dir``.

    There is no other place for data between stages: a machine-local folder would not survive a lost executor.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder, removed when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())

    def forget() -> None:
        with contextlib.suppress(Exception):  # the JVM may have ended before
            files.delete(where, True)

    atexit.register(forget)
    return path


@contextlib.contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action go when it ends, inside this block; the session's own setting is put back after it.

    By default they stay until the driver collects its garbage, so a job of many steps keeps those of all steps on disk.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
