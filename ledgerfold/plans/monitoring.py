"""Monitoring: take snapshots of tables, keep them, read the last one per subject."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ledgerfold.operators.changes import latest_per_key
from ledgerfold.operators.profiling import column_profile, storage_profile
from ledgerfold.operators.sketches import sketched_profile
from ledgerfold.sinks.collections import replace_collection

#: What a snapshot row is of, and what settles ties between rows of one time.
SUBJECT, TIES = ["table_name", "column_name"], ["n_rows", "n_nulls", "n_distinct"]


def monitor(
    tables: dict[str, DataFrame], snapshot_at: str, exact: bool = False
) -> DataFrame:
    """A snapshot row per table and column."""
    profiles = [column_profile(df, name, snapshot_at, exact) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, profiles)


def monitor_storage(
    spark: SparkSession, paths: dict[str, str], snapshot_at: str
) -> DataFrame:
    """A snapshot row per stored table."""
    profiles = [storage_profile(spark, p, name, snapshot_at) for name, p in paths.items()]
    return reduce(DataFrame.unionByName, profiles)


def keep_snapshot(snapshot: DataFrame, path: str) -> None:
    """Add a snapshot to the kept ones."""
    snapshot.write.mode("append").parquet(path)


def monitor_files(
    spark: SparkSession, paths: dict[str, str], store: str, snapshot_at: str
) -> DataFrame:
    """A snapshot row per stored table and column, from sketches of each table's files
    kept below ``store``: only files that are new since the last snapshot are read."""
    profiles = [
        sketched_profile(spark, path, f"{store}/{name}", name, snapshot_at).drop("quantiles")
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, profiles)


def keep_latest(snapshot: DataFrame, name: str) -> DataFrame:
    """Take a snapshot into the collection ``name`` of the last one of each table and column.

    The collection has one row per column, however many snapshots there have been, so
    neither this nor reading it looks at those. An older snapshot that comes late
    replaces nothing. Gives what ``last_monitoring`` would give of all of them.
    """
    spark = snapshot.sparkSession
    if spark.catalog.tableExists(name):
        snapshot = spark.table(name).unionByName(snapshot)
    return replace_collection(latest_per_key(snapshot, SUBJECT, ["snapshot_at", *TIES]), name)


def last_monitoring(snapshots: DataFrame) -> DataFrame:
    """The last snapshot of each table and column; of two at one time, the larger."""
    return latest_per_key(snapshots, SUBJECT, ["snapshot_at", *TIES])


def last_monitoring_storage(snapshots: DataFrame) -> DataFrame:
    """The last storage snapshot of each table; of two at one time, the larger."""
    ties = ["n_rows", "n_bytes", "n_files"]
    return latest_per_key(snapshots, ["table_name"], ["snapshot_at", *ties])
