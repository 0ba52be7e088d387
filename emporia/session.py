"""Spark session defaults for the warehouse jobs."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Time zone: all business times are rendered
# explicitly in GMT+8 by the operators, so the session stays on UTC.
WAREHOUSE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # shuffles start fine-grained and are coalesced to the advisory size, so the count follows the
    # data and not a default; a cluster overrides both for its memory per core
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    # (16 MB in a shuffle file are up to 500 MB of rows in a task's sorts)
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # what lies together by an order's id is joined there by that and more
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # gzip files can't be split: what one task reads of them grows by ten
    "spark.sql.files.maxPartitionBytes": "32m",
    # the shuffle files of a write go when it ends, not when the driver collects garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # partition overwrite only replaces the partitions a write touches
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # dt=yyyy-MM-dd folders stay STRING (inference would make them DATE)
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: On one machine a fine-grained start only costs; the session's own shuffle count is used there.
LOCAL_PARTITIONS = 32
#: Settings of a running session that are kept if the cluster (or the caller) has set them.
SIZING = (INITIAL_PARTITIONS, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")


def is_local(spark: SparkSession) -> bool:
    """Driver and executors are one process, so they share local folders."""
    return spark.conf.get("spark.master", "").split("[")[0] == "local"


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "emporia",
    extra: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the warehouse defaults.

    On a cluster ``master`` is left to spark-submit. Locally the UI stays off.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("EMPORIA_DRIVER_MEMORY", "16g"))
    for key, value in WAREHOUSE_CONF.items():
        builder = builder.config(key, value)
    if master and master.startswith("local"):
        builder = builder.config(INITIAL_PARTITIONS, str(shuffle_partitions or LOCAL_PARTITIONS))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def apply_warehouse_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable defaults to an existing session."""
    for key, value in WAREHOUSE_CONF.items():
        if key in SIZING and (spark.conf.get(key, None) is not None or is_local(spark)):
            continue
        try:
            spark.conf.set(key, value)
        except Exception:  # static conf on a shared session: leave as is
            pass


OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextlib.contextmanager
def open_files(spark: SparkSession, most: int):
    """Writes to at most so many folders keep a file open for each, and don't sort their rows by folder."""
    before = spark.conf.get(OPEN_WRITERS, "0")
    spark.conf.set(OPEN_WRITERS, str(most))
    try:
        yield
    finally:
        spark.conf.set(OPEN_WRITERS, before)


LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextlib.contextmanager
def few_listing_tasks(spark: SparkSession, most: int = 64):
    """Tables with thousands of small day folders are listed by so many tasks, and not by one for each folder."""
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(most))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, before)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path in the checkpoint folder, which driver and executors share; nothing is created."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/emporia-{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; create a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Only local runs (tests) without the setting get a fresh temp folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return current
    current = current or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="emporia-ckpt-")  # one process: a local folder is shared
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path
