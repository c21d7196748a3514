"""Gather rows into arrays of documents.

A key gives one document, however many rows it has, as a document store's push does;
an array has to fit one row of one task. Where keys may be too large for that, keep
flat rows, or ask for a number of parts per key with ``push_parts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def push(
    df: DataFrame,
    keys: list[str],
    values: list[str | Column],
    as_: str,
    totals: dict[str, Column] | None = None,
) -> DataFrame:
    """Per key an array of ``struct(values)``: columns ``keys, totals, as_``.

    Arrays are sorted by all their fields, so results repeat. ``totals`` names
    aggregates over the rows of the key, such as ``F.avg`` of a column.
    """
    named = [column.alias(name) for name, column in (totals or {}).items()]
    array = F.sort_array(F.collect_list("gathered_item")).alias(as_)
    rows = df.withColumn("gathered_item", F.struct(*values))
    return rows.groupBy(*keys).agg(*named, array)


def push_parts(
    df: DataFrame,
    keys: list[str],
    values: list[str | Column],
    as_: str,
    parts: int,
    part: str = "part",
) -> DataFrame:
    """Every key as up to ``parts`` documents: columns ``keys, part, as_``.

    A row's part follows from its values, so a task that is run again places its rows
    as before; equal rows of a key share a part. A part without rows gives no document.
    """
    number = F.pmod(F.xxhash64(F.struct(*values)), F.lit(parts)).cast("int")
    return push(df.withColumn(part, number), [*keys, part], values, as_)
