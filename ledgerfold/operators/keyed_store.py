"""A table kept by hash of its key, so that a change rewrites only the parts it touches.

A key's part is a hash of it. A change set is applied to the parts that its keys fall
into: those are read, changed as ``changes.apply_changes`` does, stored apart, and then
put in the place of the old ones by dynamic partition overwrite. Files of other parts are
neither read nor written. Parts should have the size of a few files (``parts_for``): a
task writes one, and a change of one row rewrites one. Rows without a key, which no
change can name, are a part of their own that many tasks write.

A change that fails while parts are put in place may have replaced some of them; applied
again it gives the same table, as its rows are whole ones.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold.operators.changes import apply_changes, latest_per_key
from ledgerfold.session import TASK_BYTES, land

#: The part of rows without a key.
NO_KEY = -1


def parts_for(n_bytes: int, part_bytes: int = TASK_BYTES) -> int:
    """As many parts as keep one near the size a task reads."""
    return max(1, -(-n_bytes // part_bytes))


def _part(key: Column, parts: int) -> Column:
    found = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    return F.when(key.isNull(), NO_KEY).otherwise(found)


def _write(rows: DataFrame, path: str, key: str, parts: int) -> None:
    placed = rows.withColumn("part", _part(F.col(key), parts))
    spread = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    writer = placed.repartition("part", spread).write.mode("overwrite").partitionBy("part")
    writer.option("partitionOverwriteMode", "dynamic").parquet(f"{path}/rows")


def create_store(df: DataFrame, path: str, key: str, parts: int) -> DataFrame:
    """Store ``df`` by its key; there must be nothing at ``path``."""
    if "part" in df.columns:
        raise ValueError("a column is named part, as the folders of the store are")
    about = df.sparkSession.createDataFrame([(key, parts, df.schema.json())], "key STRING, parts INT, schema STRING")
    about.coalesce(1).write.mode("error").parquet(f"{path}/about")
    _write(df, path, key, parts)
    return read_store(df.sparkSession, path)


def _about(spark: SparkSession, path: str) -> Row:
    return spark.read.parquet(f"{path}/about").first()


def _rows(spark: SparkSession, path: str, about: Row) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(about["schema"])).add("part", T.IntegerType())
    return spark.read.schema(schema).parquet(f"{path}/rows")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The rows as they are now."""
    return _rows(spark, path, _about(spark, path)).drop("part")


def change_store(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    op: str = "op",
    order_by: list[str] | None = None,
) -> list[int]:
    """Apply a change set, as ``apply_changes`` takes it; gives the parts it has touched."""
    about = _about(spark, path)
    key, parts = about["key"], about["parts"]
    if order_by:
        changes = latest_per_key(changes, [key], order_by)
    changes = land(changes, "changes")
    touched = changes.select(_part(F.col(key), parts).alias("part")).distinct()
    touched = sorted(r["part"] for r in touched.collect())  # as many as there are parts
    if not touched:
        return []
    stored = _rows(spark, path, about)
    base = stored.where(F.col("part").isin(touched)).drop("part")
    # Stored first: what is put in place does not depend on what it replaces.
    new = land(apply_changes(base, changes.select(*base.columns, op), key, op), "changed_parts")
    left = new.select(_part(F.col(key), parts).alias("part")).distinct()
    left = {r["part"] for r in left.collect()}
    if left:
        _write(new, path, key, parts)
    for part in touched:
        if part not in left:  # nothing is written for a part without rows
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/rows/part={part}")
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return touched
