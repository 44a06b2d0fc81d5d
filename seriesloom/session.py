"""Session defaults and durable lineage cuts."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Rows behind a shuffle are merged into tasks of about so many compressed bytes. Product-days take some
# 14 bytes there and half a kilobyte in the hash maps of a task, so the usual 64 MB are gigabytes of memory.
TASK_INPUT = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")


def build_session(app: str = "seriesloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators assume (AQE, UTC, Arrow)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        TASK_INPUT[0]: TASK_INPUT[1],
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bound_tasks(spark: SparkSession) -> None:
    """Keep tasks behind a shuffle small, unless the session has a size of its own."""
    if spark.conf.get(TASK_INPUT[0], None) is None:
        spark.conf.set(*TASK_INPUT)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of the session; only a local session gets its own."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="seriesloom-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


_written: list[str] = []


def new_table_path(spark: SparkSession) -> str:
    """A fresh folder name in the checkpoint folder, deleted by `clear_durable`."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def durable(df: DataFrame) -> DataFrame:
    """Write `df` as a table in the checkpoint folder and continue from that.

    Unlike a local checkpoint this survives the loss of executors. As Parquet it
    keeps column pruning for its readers, and Catalyst knows its size, so that
    later joins may broadcast it if it is in fact small.
    """
    spark = df.sparkSession
    path = new_table_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_durable(spark: SparkSession, keep: int = 0) -> None:
    """Delete the tables of `durable`, but the first `keep`, once no DataFrame built on them is needed."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    while len(_written) > keep:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(hadoop).delete(path, True)


def cleans_up(job):
    """A job (spark, ...) that writes its results; the tables it made on the way go when it ends."""
    @functools.wraps(job)
    def run(spark: SparkSession, *args, **options):
        before = len(_written)
        try:
            return job(spark, *args, **options)
        finally:
            clear_durable(spark, before)
    return run


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="seriesloom-package-"), "seriesloom")
    archive = shutil.make_archive(target, "zip", os.path.dirname(package),
                                  os.path.basename(package))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
