"""Session settings shared by tests, bench and the driver entry point."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (epoch <-> date conversions),
# ANSI casts (we use try_* forms where the shop data is lenient), AQE for
# runtime re-planning (coalescing, skew splits, broadcast of sides that turn
# out small at runtime).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "shopmart") -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``master`` and ``shuffle_partitions`` are only meant for local runs; on a
    cluster both come from the submit configuration.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        b = b.config("spark.ui.enabled", "false")
        b = b.config("spark.ui.showConsoleProgress", "false")
        b = b.config("spark.driver.memory", os.environ.get("SHOPMART_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in SESSION_CONF.items():
        if spark.conf.isModifiable(k):  # a static one on a shared session stays as set
            spark.conf.set(k, v)


#: Whether the shuffle files of a query go when it has ended.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """The shuffle files of what is written in the block go as soon as each write has ended, not
    when the driver happens to collect its garbage: a job of many steps holds those of one step
    at a time.  Only for writes: a DataFrame collected twice would find its files gone."""
    with _set(spark, FREED, "true"):
        yield


#: Bytes of files that a task reads at once, and most of them for stored attribute rows.
SPLIT, SPLIT_BYTES = "spark.sql.files.maxPartitionBytes", 16 << 20


@contextmanager
def small_splits(spark: SparkSession):
    """Files are read by at most ``SPLIT_BYTES`` a task in what is run in the block: a stored attribute
    row is a few bytes, but some 70 where it is sorted, so that larger splits spill."""
    now = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    with _set(spark, SPLIT, str(min(now, SPLIT_BYTES))):
        yield


@contextmanager
def _set(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Read from ``spark.checkpoint.dir`` as the cluster names it; only when it
    is unset (local tests) a fresh scratch folder is created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="shopmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d
