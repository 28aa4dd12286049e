"""Sessions for local runs. On a cluster, use the cluster's own session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from forecourt.staging import ensure_checkpoint_dir


def local_session(name: str, cpus: int = 8, partitions: int | None = None) -> SparkSession:
    """A session on this machine, with as many shuffle partitions as cores.

    Shuffles of test data are small, so partitions may be small too before they
    are merged; otherwise most cores would idle.
    """
    session = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    ensure_checkpoint_dir(session)
    return session
