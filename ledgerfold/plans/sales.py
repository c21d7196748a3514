"""Sales history per product: products, their order lines, and the lines' orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.operators.gather import push
from ledgerfold.operators.nested import lookup, lookup_unwind, unwind

LINE = ["OrderID", "StockItemID", "Quantity", "UnitPrice"]
ORDER = ["OrderID", "CustomerID", "CityID", "EmployeeID", "InvoiceDate", "OrderDate"]


def _line_with_order(lines: DataFrame, orders: DataFrame, order: list[str]) -> DataFrame:
    """Order lines with their order nested as ``Order``. Keys are never null."""
    return lookup_unwind(
        lines.select(*LINE), orders, "OrderID", "OrderID", "Order", order, null_safe=False
    )


def sales_rows(
    stock: DataFrame, lines: DataFrame, orders: DataFrame, order: list[str] = ORDER
) -> DataFrame:
    """The history as flat rows: ``_id, ItemName`` and one line with its order.

    This is the form to store and to query further; ``sales_history`` nests it.
    ``order`` names the columns kept of an order.
    """
    items = stock.select(F.col("StockItemID").alias("_id"), "ItemName")
    detailed = _line_with_order(lines, orders, order)
    joined = detailed.join(items, detailed["StockItemID"] == items["_id"])
    return joined.select("_id", "ItemName", F.struct(*LINE, "Order").alias("OrderList"))


def sales_history(
    stock: DataFrame, lines: DataFrame, orders: DataFrame, order: list[str] = ORDER
) -> DataFrame:
    """``_id, ItemName, OrderList[]`` per product that has been ordered.

    Lines are joined to their orders, gathered per product, and only then joined
    to the product: the name is not shuffled once per line.
    """
    detailed = _line_with_order(lines, orders, order)
    gathered = push(detailed, ["StockItemID"], [*LINE, "Order"], "OrderList")
    items = stock.select(F.col("StockItemID").alias("_id"), "ItemName")
    joined = gathered.join(items, gathered["StockItemID"] == items["_id"])
    return joined.select("_id", "ItemName", "OrderList")


def sales_history_by_lookup(
    stock: DataFrame, lines: DataFrame, orders: DataFrame, order: list[str] = ORDER
) -> DataFrame:
    """The same result step by step: nest the lines, unwind, add each line's order, regroup."""
    items = stock.select(F.col("StockItemID").alias("_id"), "ItemName", "StockItemID")
    nested = lookup(
        items, lines, "StockItemID", "StockItemID", "OrderList", LINE, left_unique=True
    )
    per_line = unwind(nested, "OrderList")
    with_orders = lookup_unwind(
        per_line, orders, "OrderList.OrderID", "OrderID", "OrderList.Order", order
    )
    flat = with_orders.select("_id", "ItemName", "OrderList.*")
    totals = {"ItemName": F.first("ItemName")}
    return push(flat, ["_id"], [*LINE, "Order"], "OrderList", totals)


def sales_totals(stock: DataFrame, lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines, quantity and order dates per product, without gathering any array.

    Grouped before the product is joined: grouping by the key of a join that has
    just been done would keep a much-sold product's lines in one task.
    """
    totals = (
        _line_with_order(lines, orders, ["OrderDate"])
        .groupBy("StockItemID")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum("Quantity").alias("quantity"),
            F.min("Order.OrderDate").alias("first_order"),
            F.max("Order.OrderDate").alias("last_order"),
        )
    )
    items = stock.select(F.col("StockItemID").alias("_id"), "ItemName")
    joined = totals.join(items, totals["StockItemID"] == items["_id"])
    return joined.select("_id", "ItemName", "n_lines", "quantity", "first_order", "last_order")
