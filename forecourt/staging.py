"""Shared intermediates, written to the folder all executors can reach."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000

#: Workers have one thread that allocates; with one pool, memory that is free goes back to the system.
WORKER_MEMORY = {"MALLOC_ARENA_MAX": "1", "ARROW_DEFAULT_MEMORY_POOL": "system"}

#: Where a local session without the setting checkpoints; see `ensure_checkpoint_dir`.
LOCAL_DEFAULT = "/tmp/checkpoints/forecourt"


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in spark.checkpoint.dir, or its context's checkpoint folder.

    There is no other fallback: intermediates must lie where all executors see them.
    """
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError(f"set {SETTING} to a folder shared by all executors")
    return folder.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession, folder: str = LOCAL_DEFAULT) -> None:
    """Give a local session without a checkpoint folder one; a cluster must name its own."""
    if spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir():
        return
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {SETTING} to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(folder)


def ready(spark: SparkSession) -> None:
    """Give the session a checkpoint folder, and its Python workers the way to this library.

    Rows with long texts come to workers a few thousand at a time, unless the application says otherwise.
    """
    ensure_checkpoint_dir(spark)
    if BATCH not in dict(spark.sparkContext.getConf().getAll()):
        spark.conf.set(BATCH, BATCH_ROWS)
    root = str(Path(__file__).resolve().parent.parent)
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        environment["PYTHONPATH"] = ":".join(filter(None, [root, *paths]))
    for name, value in WORKER_MEMORY.items():
        environment.setdefault(name, value)


def own_folder(spark: SparkSession) -> str:
    """Where this application keeps its intermediates."""
    return f"{shared_folder(spark)}/forecourt/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete what this application has staged. Frames that it returned must have been used by then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write `df` and read it back: later steps neither recompute nor replan it.

    This runs a job. Without `compression` the session's setting holds.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
