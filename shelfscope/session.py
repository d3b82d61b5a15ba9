"""SparkSession construction used by tests, bench and the entry module."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8) -> SparkSession:
    """Return (or create) a session configured for this library.

    On a cluster the session already exists and its settings win; the
    configuration below only applies when this call creates the session.
    """
    builder = (
        SparkSession.builder.master(master or os.environ.get("SPARK_MASTER", "local[8]"))
        .appName("shelfscope")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``; raises where it is unset.

    Stage tables written to a machine-local folder could not be read by other
    executors, so the library never picks one itself.
    """
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise RuntimeError("spark.checkpoint.dir is unset: name a folder that all executors share")
    return folder


def use_local_checkpoint_dir(spark: SparkSession) -> str:
    """For tests, the bench and smoke runs on one machine: name a local folder if none is set."""
    try:
        return checkpoint_dir(spark)
    except RuntimeError:
        folder = tempfile.mkdtemp(prefix="shelfscope-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
