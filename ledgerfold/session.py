"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# What one task of a shuffle should have to read.
TASK_BYTES = 128 * 1024 * 1024


def build(
    master: str | None = None, largest_shuffle_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the defaults this library is written for.

    On a cluster leave ``master`` out: the submit command names it. Give the size of
    the largest shuffle to expect, about that of the largest table's columns in use:
    there will be partitions enough to keep a task's share in memory, and the
    adaptive planner joins those that turn out small.
    """
    if largest_shuffle_bytes:
        partitions = max(200, -(-largest_shuffle_bytes // TASK_BYTES))
        conf = {"spark.sql.shuffle.partitions": str(partitions), **conf}
    builder = (
        SparkSession.builder.appName("ledgerfold")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package where it is not installed.

    The folder it was loaded from is put on the workers' path, as PYTHONPATH would do.
    """
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` or, where that is
    not set, the session's warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has been written to yet."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/ledgerfold/{app}/{name}-{uuid.uuid4().hex}"


def expire(spark: SparkSession) -> None:
    """Remove what this application has written below the shared folder.

    Collections and frames that still read it are lost; call it at the end.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(
        f"{shared_folder(spark)}/ledgerfold/{spark.sparkContext.applicationId}"
    )
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Cuts the lineage with a table that outlives lost executors, and gives later
    plans column pruning, pushed filters and real size statistics.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
