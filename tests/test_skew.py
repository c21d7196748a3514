"""Joins in which a third of the rows share a key are split at run time."""

import pytest
from pyspark.sql import functions as F

from ledgerfold.operators.nested import lookup, lookup_unwind
from ledgerfold.plans import sales
from ledgerfold.session import land

ORDER = ["OrderID", "CustomerID", "OrderDate"]

# Limits scaled down to the size of the test tables.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "32",
}


@pytest.fixture
def small_limits(spark):
    before = {name: spark.conf.get(name) for name in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture(scope="module")
def lines(spark):
    """90,000 lines; order 5 and product 1 have a third of them each."""
    return land(
        spark.range(0, 90000, 1, 16).selectExpr(
            "IF(id % 3 = 0, 5, id % 1000) AS OrderID",
            "IF(id % 3 = 1, 1, id % 500) AS StockItemID",
            "CAST(id AS INT) AS Quantity",
            "CAST(1 AS DECIMAL(18,2)) AS UnitPrice",
        ),
        "lines",
    )


@pytest.fixture(scope="module")
def orders(spark):
    made = "id AS OrderID", "id % 7 AS CustomerID", "CAST(id AS STRING) AS OrderDate"
    return land(spark.range(1000).selectExpr(*made), "orders")


@pytest.fixture(scope="module")
def stock(spark):
    made = "id AS StockItemID", "CAST(id AS STRING) AS ItemName"
    return land(spark.range(500).selectExpr(*made), "stock")


def run(df):
    """Number of rows, and the plan by which all of their columns were made."""
    digest = df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*df.columns)))
    n_rows = digest.collect()[0][0]
    return n_rows, digest._jdf.queryExecution().executedPlan().toString()


def test_lookup_of_a_skewed_left_side(lines, orders, small_limits):
    n_rows, text = run(lookup(lines, orders, "OrderID", "OrderID", "Order"))
    assert n_rows == 90000 and "skew=true" in text


def test_inner_join_with_a_skewed_side(lines, orders, small_limits):
    n_rows, text = run(lookup_unwind(lines, orders, "OrderID", "OrderID", "Order"))
    assert n_rows == 90000 and "skew=true" in text


def test_flat_history(stock, lines, orders, small_limits):
    n_rows, text = run(sales.sales_rows(stock, lines, orders, ORDER))
    assert n_rows == 90000 and text.count("skew=true") == 2


def test_totals_split_the_orders_and_group_before_the_product(stock, lines, orders, small_limits):
    n_rows, text = run(sales.sales_totals(stock, lines, orders))
    assert n_rows == 500 and "skew=true" in text


def test_history_of_heavy_products(stock, lines, orders, small_limits):
    df = sales.sales_history(stock, lines, orders, ORDER)
    documents = df.selectExpr("_id", "size(OrderList) AS n").collect()
    assert sum(r["n"] for r in documents) == 90000 and len(documents) == 500
