"""Spark session helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "manifest_spark") -> SparkSession:
    """Session for tests and local runs; on a cluster use the cluster's own."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = (SparkSession.builder
         .master(master or f"local[{cpus}]")
         .appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         # text extraction is CPU-bound: keep post-shuffle partitions at least
         # a few per core instead of letting AQE merge small shuffles into one
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 2 * int(cpus)))
         .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
         # small files are read by as many tasks as there are cores
         .config("spark.sql.files.openCostInBytes", "256k")
         .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names; a scratch one only in local mode, where all share it.

    A session's setting cannot be changed while it runs, so that a scratch
    folder is kept by the context alone.
    """
    named, context = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    kept = context.getCheckpointDir()
    if named:
        if kept is None:
            context.setCheckpointDir(named)
        return named
    if kept is not None:
        return kept
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="manifest-ckpt-", dir="/tmp"))
    return context.getCheckpointDir()
