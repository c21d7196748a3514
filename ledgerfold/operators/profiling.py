"""Snapshots of what tables hold and what they take up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Values of more bytes than this are counted by their SHA-256.
LONG_VALUE = 64


def column_profile(
    df: DataFrame, table: str, snapshot_at: str, exact: bool = False
) -> DataFrame:
    """Per column: rows, nulls and distinct values, in one pass over the table.

    Distinct values are estimated with one small sketch per column and task.
    ``exact`` counts them: all columns' values go through one shuffle, keyed by column
    and value, copies of a value being one row per task before it. A long value goes as
    its digest. ``operators.sketches`` profiles only the files that are new.
    """
    counted = _counted(df) if exact else _estimated(df)
    per_column = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"rows_{number}").alias("n_rows"),
            (F.col(f"rows_{number}") - F.col(f"filled_{number}")).alias("n_nulls"),
            F.col(f"distinct_{number}").alias("n_distinct"),
        )
        for number, name in enumerate(df.columns)
    ]
    return counted.select(F.inline(F.array(*per_column))).select(
        F.lit(snapshot_at).cast("timestamp_ntz").alias("snapshot_at"),
        F.lit(table).alias("table_name"),
        "*",
    )


def _estimated(df: DataFrame) -> DataFrame:
    measures: list[Column] = []
    for number, name in enumerate(df.columns):
        column = df[f"`{name}`"]
        measures.append(F.count(F.lit(1)).alias(f"rows_{number}"))
        measures.append(F.count(column).alias(f"filled_{number}"))
        measures.append(F.approx_count_distinct(column).alias(f"distinct_{number}"))
    return df.agg(*measures)


def _counted(df: DataFrame) -> DataFrame:
    cells = F.array(
        *[_cell(number, df[f"`{f.name}`"], f.dataType) for number, f in enumerate(df.schema)]
    )
    values = df.select(F.inline(cells)).groupBy("number", "whole", "real", "other")
    values = values.agg(F.count(F.lit(1)).alias("n"))
    filled = F.col("whole").isNotNull() | F.col("real").isNotNull() | F.col("other").isNotNull()
    measures: list[Column] = []
    for number in range(len(df.columns)):
        mine = F.col("number") == number
        of_mine = F.when(mine, F.col("n"))
        measures.append(F.coalesce(F.sum(of_mine), F.lit(0)).alias(f"rows_{number}"))
        measures.append(
            F.coalesce(F.sum(F.when(filled, of_mine)), F.lit(0)).alias(f"filled_{number}")
        )
        measures.append(F.count_if(mine & filled).alias(f"distinct_{number}"))
    return values.agg(*measures)


def _cell(number: int, column: Column, kind: T.DataType) -> Column:
    """A value in the field of its kind, the others null; what has no order is text."""
    whole = real = other = None
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        whole = column
    elif isinstance(kind, T.TimestampNTZType):
        epoch = F.lit("1970-01-01").cast("timestamp_ntz")
        whole = F.timestamp_diff("MICROSECOND", epoch, column)
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        real = column
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        other = F.to_json(column)
    else:
        other = column
    text = (F.lit(None) if other is None else other).cast("string")
    # A digest cannot be taken for a short value: those have another sign before them.
    digest = F.concat(F.lit("#"), F.sha2(text.cast("binary"), 256))
    short = F.when(F.octet_length(text) > LONG_VALUE, digest).otherwise(F.concat(F.lit("="), text))
    return F.struct(
        F.lit(number).alias("number"),
        (F.lit(None) if whole is None else whole).cast("bigint").alias("whole"),
        (F.lit(None) if real is None else real).cast("double").alias("real"),
        (text if other is None else short).alias("other"),
    )


def storage_profile(
    spark: SparkSession, path: str, table: str, snapshot_at: str
) -> DataFrame:
    """Files, bytes and rows of a Parquet table; row counts come from file footers.

    Files are listed, not opened: one without rows counts as well.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    files = listed.agg(
        F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes")
    )
    rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"))
    table_name, at = F.lit(table).alias("table_name"), F.lit(snapshot_at).cast("timestamp_ntz")
    keyed = files.withColumn("table_name", table_name)
    return keyed.join(rows.withColumn("table_name", table_name), "table_name").select(
        at.alias("snapshot_at"), "table_name", "n_files", "n_bytes", "n_rows"
    )
