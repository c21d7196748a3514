from collections import Counter

import pytest

from ledgerfold.plans import sales
from ledgerfold.session import land


@pytest.fixture(scope="module")
def tables(spark):
    """Five products; a third of the lines on product 1, a third copies of one line."""
    stock = [(i, f"item {i}") for i in range(1, 6)]
    lines = [(o % 40, 1, o, "1.50") for o in range(300)]
    lines += [(5, 2, 3, "9.99")] * 300
    lines += [(o % 50, 3 + o % 2, 1, "2.00") for o in range(300)]
    lines += [(1, 99, 1, "0.10")]
    orders = [(o, o % 7, None, None, "2013-01-01", "2013-01-02") for o in range(45)]
    line_schema = "OrderID INT, StockItemID INT, Quantity INT, price STRING"
    priced = spark.createDataFrame(lines, line_schema).selectExpr(
        "OrderID", "StockItemID", "Quantity", "CAST(price AS DECIMAL(18,2)) AS UnitPrice"
    )
    order_schema = (
        "OrderID INT, CustomerID INT, CityID INT, EmployeeID INT, "
        "InvoiceDate STRING, OrderDate STRING"
    )
    return (
        land(spark.createDataFrame(stock, "StockItemID INT, ItemName STRING"), "stock"),
        land(priced, "lines"),
        land(spark.createDataFrame(orders, order_schema), "orders"),
    )


def brute_force(tables):
    stock, lines, orders = ([r.asDict() for r in t.collect()] for t in tables)
    names = {s["StockItemID"]: s["ItemName"] for s in stock}
    by_id = {o["OrderID"]: o for o in orders}
    return Counter(
        (x["StockItemID"], names[x["StockItemID"]], x["Quantity"], str(x["UnitPrice"]), x["OrderID"], by_id[x["OrderID"]]["CustomerID"])
        for x in lines
        if x["StockItemID"] in names and x["OrderID"] in by_id
    )


def line(product, name, item):
    order = item["Order"]
    assert order["OrderID"] == item["OrderID"] and order["OrderDate"] == "2013-01-02"
    return (product, name, item["Quantity"], str(item["UnitPrice"]), item["OrderID"], order["CustomerID"])


@pytest.mark.parametrize("history", [sales.sales_history, sales.sales_history_by_lookup])
def test_history_equals_brute_force(tables, history):
    documents = history(*tables).collect()
    got = Counter(
        line(d["_id"], d["ItemName"], item) for d in documents for item in d["OrderList"]
    )
    assert got == brute_force(tables)
    # product 5 has no line, product 99 is not in stock
    assert sorted(d["_id"] for d in documents) == [1, 2, 3, 4]


@pytest.mark.parametrize("history", [sales.sales_rows, sales.sales_history, sales.sales_history_by_lookup])
def test_a_missing_order_column_raises(tables, history):
    stock, lines, orders = tables
    with pytest.raises(Exception, match="CityID"):
        history(stock, lines, orders.drop("CityID"))
    history(stock, lines, orders.drop("CityID"), ["OrderID", "OrderDate"])


def test_flat_rows_equal_brute_force(tables):
    rows = sales.sales_rows(*tables).collect()
    assert Counter(line(r["_id"], r["ItemName"], r["OrderList"]) for r in rows) == brute_force(tables)


def test_totals_equal_brute_force(tables):
    want = Counter()
    for (product, _, quantity, *_), n in brute_force(tables).items():
        want[product] += quantity * n
    got = {r["_id"]: r["quantity"] for r in sales.sales_totals(*tables).collect()}
    assert got == dict(want)


def test_totals_build_no_array(tables, plan):
    assert "collect_list" not in plan(sales.sales_totals(*tables))
