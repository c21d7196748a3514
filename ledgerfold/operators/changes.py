"""Keyed inserts, updates and deletes on a table.

Each function takes the present rows and gives the new rows; write them to a new
place with ``sinks.collections.replace_collection``. ``key`` identifies a row of the
table. Small change sets are broadcast by Spark's own size check, large ones are
joined by a shuffle on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerfold.session import land


def _one_per_key(changes: DataFrame, key: str) -> DataFrame:
    """The changes; reading them raises if a key has several. Null keys match nothing."""
    n_of_key = F.count(F.lit(1)).over(Window.partitionBy(key))
    complaint = F.concat(F.lit("several changes of key "), F.col(key).cast("string"))
    checked = F.when((F.col("n_of_key") > 1) & F.col(key).isNotNull(), F.raise_error(complaint))
    # The test is part of the key itself, so no plan can leave it out.
    counted = changes.withColumn("n_of_key", n_of_key)
    return counted.withColumn(
        key, F.coalesce(checked.cast(changes.schema[key].dataType), F.col(key))
    ).drop("n_of_key")


def insert_rows(base: DataFrame, rows: DataFrame) -> DataFrame:
    """Add rows. The caller gives the keys; columns left out become null."""
    return base.unionByName(rows, allowMissingColumns=True)


def insert_numbered(
    base: DataFrame, rows: DataFrame, key: str, order_by: list[str] | None = None
) -> DataFrame:
    """Add rows with keys the table gives: the numbers after its highest key, without gaps.

    Numbers follow ``order_by``, or the order rows come in. Each task numbers its own
    rows; how many the tasks before it have is added then, so no task sees all rows. The
    numbered rows are stored, so what reads them again finds the same keys. An empty
    table gives 1 first. Columns left out become null.
    """
    kind = base.schema[key].dataType
    highest = base.agg(F.max(key)).first()[0] or 0
    if order_by:
        order = [*order_by, F.monotonically_increasing_id()]
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order_by)
    # The number of the task in the upper bits, the place among its rows in the lower 33.
    placed = land(rows.withColumn("place_given", F.monotonically_increasing_id()), "placed")
    task = F.shiftright("place_given", 33)
    earlier = Window.partitionBy(F.lit(0)).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n"))
    # One row per task that wrote rows.
    before = sizes.select("task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = placed.withColumn("task", task).join(F.broadcast(before), "task")
    place = F.col("place_given").bitwiseAND((1 << 33) - 1)
    given = (F.lit(highest).cast("long") + F.col("before") + place + 1).cast(kind)
    added = numbered.withColumn(key, given).drop("task", "before", "place_given")
    return base.unionByName(added, allowMissingColumns=True)


def update_by_key(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Set the columns ``changes`` has, for the keys it has.

    A null in ``changes`` is set as null. A key that ``base`` lacks adds nothing.
    Several changes of one key raise: reduce them first, with ``latest_per_key``.
    """
    changed = [c for c in changes.columns if c != key]
    changes = _one_per_key(changes, key)
    packed = changes.select(F.col(key).alias("change_key"), F.struct(*changed).alias("change"))
    joined = base.join(packed, base[key] == packed["change_key"], "left")
    matched = F.col("change").isNotNull()
    columns = [
        F.when(matched, F.col("change")[c]).otherwise(base[c]).alias(c) if c in changed else base[c]
        for c in base.columns
    ]
    return joined.select(*columns)


def delete_by_key(base: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Remove the rows whose key is listed."""
    return base.join(keys.select(key), key, "left_anti").select(*base.columns)


def apply_changes(
    base: DataFrame,
    changes: DataFrame,
    key: str,
    op: str = "op",
    order_by: list[str] | None = None,
) -> DataFrame:
    """Apply a change set of whole rows in one pass over ``base``.

    ``op`` is ``I`` to add the row (taking the place of one with its key, so a
    change set may be applied twice), ``U`` to replace a row if there is one, ``D``
    to remove it; another ``op`` raises. With several changes per key give
    ``order_by``, the columns that put them in order: the last one counts. Without
    it, several changes of one key raise.
    """
    if order_by:
        changes = latest_per_key(changes, [key], order_by).select(*base.columns, op)
    else:
        changes = _one_per_key(changes, key)
    unknown = F.raise_error(F.concat(F.lit("no such op: "), F.coalesce(op, F.lit("null"))))
    known = F.when(F.col(op).isin("I", "U", "D"), F.col(op)).otherwise(unknown.cast("string"))
    changes = changes.withColumn(op, known)
    packed = changes.select(
        F.col(key).alias("change_key"),
        F.col(op).alias("change_op"),
        F.struct(*base.columns).alias("change"),
    )
    joined = base.join(packed, base[key] == packed["change_key"], "left")
    staying = joined.where(F.col("change_op").isNull() | (F.col("change_op") == "U"))
    replaced = F.col("change_op").isNotNull()
    columns = [
        F.when(replaced, F.col("change")[c]).otherwise(base[c]).alias(c) for c in base.columns
    ]
    added = changes.where(F.col(op) == "I").select(*base.columns)
    return staying.select(*columns).unionByName(added)


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The last row per key in the order of ``order_by``.

    List columns that settle ties. Spark keeps one row per key and task before the
    shuffle, so a key with very many rows does not end up in one task.
    """
    newest_first = [F.col(c).desc_nulls_last() for c in order_by]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("recency", rank).where(F.col("recency") == 1).drop("recency")
