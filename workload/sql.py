"""The SQL each query of ``queries.py`` must agree with, on the driver's tables."""

from __future__ import annotations

LINES = """
    SELECT l_orderkey AS OrderID, l_partkey AS StockItemID,
           CAST(l_quantity AS INTEGER) AS Quantity,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS UnitPrice
    FROM lineitem"""

HISTORY = f"""
    SELECT p_partkey AS _id, p_name AS ItemName, OrderID, Quantity, UnitPrice,
           o_custkey AS CustomerID, o_orderdate AS OrderDate
    FROM part JOIN ({LINES}) ON p_partkey = StockItemID
    JOIN orders ON o_orderkey = OrderID"""

SHIPMENTS = """
    SELECT s_name AS name, l_orderkey AS saleid, o_orderdate AS shipped,
           l_shipdate AS delivered, l_orderkey || '-' || l_linenumber AS tracking,
           date_diff('day', o_orderdate, l_shipdate) AS days
    FROM supplier JOIN lineitem ON l_suppkey = s_suppkey
    JOIN orders ON o_orderkey = l_orderkey"""

CARRIER_ID = "substr(sha1(CAST(s_suppkey AS VARCHAR)), 1, 24)"

CUSTOMERS = """
    SELECT c_custkey AS CustomerID, CAST(NULL AS VARCHAR) AS CustomerPrimaryContact,
           c_name AS CustomerName,
           replace(lower(c_name), '#', '.') || '@example.com' AS CustomerEmail,
           lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS CustomerZipCode,
           c_mktsegment = 'BUILDING' AS CustomerIsHeadOffice,
           strftime(DATE '2013-01-01' + CAST(c_custkey % 3650 AS INTEGER), '%Y-%m-%d')
               AS CustomerUpdateAt
    FROM customer"""

NEW_CUSTOMERS = """
    SELECT s_suppkey + 1000000000000 AS CustomerID,
           CAST(NULL AS VARCHAR) AS CustomerPrimaryContact, s_name AS CustomerName,
           'email' AS CustomerEmail, '20913' AS CustomerZipCode,
           FALSE AS CustomerIsHeadOffice, '2023-02-21' AS CustomerUpdateAt
    FROM supplier"""

ORDER_CHANGES = """
    SELECT o_custkey AS key, '22222 PrimaryContact' AS contact,
           CASE WHEN max(o_totalprice) <= 400000
                THEN strftime(max(o_orderdate), '%Y-%m-%d') END AS day
    FROM orders GROUP BY o_custkey"""

LEAVING = """
    SELECT o_custkey FROM orders
    WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000"""

MONTH_FIRST = """
    strftime(o_orderdate, '%b ') || lpad(CAST(day(o_orderdate) AS VARCHAR), 2, ' ')
    || strftime(o_orderdate, ' %Y ')
    || lpad(CAST((hour(o_orderdate) + 11) % 12 + 1 AS VARCHAR), 2, ' ')
    || strftime(o_orderdate, ':%M%p')"""

LATEST_EVENT = """
    SELECT * FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""

# Columns of the tables, all of which are profiled.
PROFILED = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice "
    "l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}


def _profile(table: str, source: str, at: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT TIMESTAMP '{at}' AS snapshot_at, '{table}' AS table_name,
                   '{c}' AS column_name, count(*) AS n_rows,
                   count(*) - count({c}) AS n_nulls, count(DISTINCT {c}) AS n_distinct
            FROM {source}"""
        for c in PROFILED[table].split()
    )


def _customers_with_orders(orders: str) -> str:
    return f"""
    SELECT c_custkey, c_name, count(o_orderkey) AS n_orders,
           md5(coalesce(string_agg(o_orderkey || '/' || strftime(o_orderdate, '%Y-%m-%d'),
               ';' ORDER BY o_orderkey, o_orderdate), '')) AS orders_md5
    FROM customer LEFT JOIN {orders} ON o_custkey IS NOT DISTINCT FROM c_custkey
    GROUP BY c_custkey, c_name"""


def _json(fields: dict[str, str]) -> str:
    """A JSON object text; fields that are null are left out."""
    parts = ", ".join(f"""'"{name}":' || ({value})""" for name, value in fields.items())
    return f"'{{' || concat_ws(',', {parts}) || '}}' AS document"


def _text(column: str) -> str:
    return f"CAST(to_json({column}) AS VARCHAR)"


BRANDS = """
    SELECT DISTINCT CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS BrandID,
           p_brand AS BrandName
    FROM part"""

BASE = f"WITH base AS ({CUSTOMERS}), fresh AS ({NEW_CUSTOMERS}), changes AS ({ORDER_CHANGES})"

UPDATED_COLUMNS = """
    CustomerID,
    CASE WHEN key IS NOT NULL THEN contact ELSE CustomerPrimaryContact END
        AS CustomerPrimaryContact,
    CustomerName, CustomerEmail, CustomerZipCode, CustomerIsHeadOffice,
    CASE WHEN key IS NOT NULL THEN day ELSE CustomerUpdateAt END AS CustomerUpdateAt"""

CUSTOMER_COLUMNS = """
    CustomerID, CustomerPrimaryContact, CustomerName, CustomerEmail, CustomerZipCode,
    CustomerIsHeadOffice, CustomerUpdateAt"""

SQL = {
    "sales_history_by_product": f"""
        SELECT _id, ItemName, count(*) AS n_lines,
               md5(string_agg(OrderID || '/' || Quantity || '/' || UnitPrice || '/'
                   || CustomerID || '/' || strftime(OrderDate, '%Y-%m-%d'),
                   ';' ORDER BY OrderID, Quantity, UnitPrice)) AS lines_md5
        FROM ({HISTORY}) GROUP BY _id, ItemName""",
    "sales_history_nested": HISTORY,
    "sales_rows": HISTORY,
    "sales_totals": f"""
        SELECT _id, first(ItemName) AS ItemName, count(*) AS n_lines,
               CAST(sum(Quantity) AS BIGINT) AS quantity,
               min(OrderDate) AS first_order, max(OrderDate) AS last_order
        FROM ({HISTORY}) GROUP BY _id""",
    "lookup_nested_left": _customers_with_orders("orders"),
    "lookup_with_empty": _customers_with_orders(
        """(SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'
            AND o_orderdate >= TIMESTAMP '2000-01-01')"""
    ),
    "lookup_unwind_null_keys": """
        SELECT o_orderkey, nullif(o_custkey, 0) AS customer, c_name
        FROM orders JOIN customer
          ON nullif(o_custkey, 0) IS NOT DISTINCT FROM nullif(c_custkey, 0)""",
    "carrier_avg_delivery_days": f"""
        SELECT name, avg(days) AS avgDifferenceBetweenDays FROM ({SHIPMENTS}) GROUP BY name""",
    "carrier_shipments": f"""
        SELECT name, avg(days) AS avgDifferenceBetweenDays,
               count(*) AS n_shipments,
               md5(string_agg(saleid || '/' || strftime(shipped, '%Y-%m-%d') || '/'
                   || strftime(delivered, '%Y-%m-%d') || '/' || days,
                   ';' ORDER BY saleid, shipped, delivered)) AS shipments_md5
        FROM ({SHIPMENTS}) GROUP BY name""",
    "carrier_shipment_count": f"""
        SELECT {CARRIER_ID} AS _id, s_name AS name, count(saleid) AS NTransportes
        FROM supplier LEFT JOIN ({SHIPMENTS}) ON name = s_name
        GROUP BY s_suppkey, s_name""",
    "carrier_shipment_count_with_empty": f"""
        SELECT s_name AS name, count(saleid) AS NTransportes
        FROM supplier LEFT JOIN ({SHIPMENTS}) ON name = s_name
        GROUP BY s_suppkey, s_name
        UNION ALL
        SELECT s_name || ' new', 0 FROM supplier""",
    "carrier_list": f"""
        SELECT {CARRIER_ID} AS _id, s_name AS name, TRUE AS dropped FROM supplier""",
    "shipments_flat": f"""
        SELECT saleid, name, strftime(shipped, '%Y-%m-%d') AS shippingDate,
               strftime(delivered, '%Y-%m-%d') AS deliveryDate, tracking AS trackingNumber
        FROM ({SHIPMENTS})""",
    "nested_dates_normalised": f"""
        SELECT name, saleid, shipped AS shippingDate, delivered AS deliveryDate,
               tracking AS trackingNumber
        FROM ({SHIPMENTS})""",
    "orders_dates_normalised": """
        SELECT o_orderkey AS OrderID, o_custkey AS CustomerID,
               o_orderdate AS InvoiceDate, o_orderdate AS OrderDate
        FROM orders""",
    "customer_dates_normalised": """
        SELECT c_custkey AS CustomerID, c_name AS CustomerName,
               CAST(DATE '2013-01-01' + CAST(c_custkey % 3650 AS INTEGER) AS TIMESTAMP)
                   AS CustomerUpdateAt
        FROM customer""",
    "order_dates_rejected": """
        SELECT o_orderkey AS OrderID, 'InvoiceDate' AS field, 'pending' AS text
        FROM orders WHERE o_orderstatus = 'P'
        UNION ALL
        SELECT o_orderkey, 'OrderDate', '2013-02-31'
        FROM orders WHERE o_orderpriority = '5-LOW'""",
    "event_midnights": """
        SELECT user_id, date_diff('day', min(ts), max(ts)) AS days
        FROM events GROUP BY user_id""",
    "event_dates_with_offset": "SELECT event_id, ts FROM events",
    "export_customer": f"""
        SELECT {_json({
            "CustomerID": "CustomerID",
            "BillToCustomerID": "CustomerID",
            "BuyingGroupID": "c_nationkey",
            "CustomerName": _text("CustomerName"),
            "CustomerEmail": _text("CustomerEmail"),
            "CustomerZipCode": _text("CustomerZipCode"),
            "CustomerIsHeadOffice": "CAST(CustomerIsHeadOffice AS VARCHAR)",
            "CustomerUpdateAt": _text("CustomerUpdateAt"),
        })}
        FROM ({CUSTOMERS}) JOIN (SELECT c_custkey, c_nationkey FROM customer)
          ON c_custkey = CustomerID""",
    "export_orders": f"""
        SELECT {_json({
            "OrderID": "o_orderkey",
            "CustomerID": "o_custkey",
            "InvoiceDate": _text(f"({MONTH_FIRST})"),
            "OrderDate": _text("strftime(o_orderdate, '%Y-%m-%d')"),
        })}
        FROM orders""",
    "export_order_list": f"""
        SELECT {_json({
            "OrderID": "OrderID",
            "StockItemID": "StockItemID",
            "Quantity": "Quantity",
            "UnitPrice": "UnitPrice",
        })}
        FROM ({LINES})""",
    "export_stock_item": f"""
        SELECT {_json({
            "StockItemID": "p_partkey",
            "BrandID": "CAST(replace(p_brand, 'Brand#', '') AS INTEGER)",
            "SizeID": "p_size",
            "ItemName": _text("p_name"),
            "IsChillerStock": "CAST(p_type = 'ECONOMY' AS VARCHAR)",
            "UnitPrice": "CAST(p_retailprice AS DECIMAL(18,2))",
            "RecomendedRetailPrice": "CAST(p_retailprice AS DECIMAL(18,2))",
        })}
        FROM part""",
    "export_brand": f"""
        SELECT {_json({
            "BrandID": "CAST(replace(p_brand, 'Brand#', '') AS INTEGER)",
            "BrandName": _text("p_brand"),
        })}
        FROM (SELECT DISTINCT p_brand FROM part)""",
    "export_tax_rate": f"""
        SELECT {_json({"TaxRateID": "CAST(rate AS INTEGER) + 1", "TaxRate": "rate"})}
        FROM (SELECT DISTINCT CAST(l_tax * 100 AS DECIMAL(18,2)) AS rate FROM lineitem)""",
    "json_round_trip": """
        SELECT substr(sha1(CAST(p_partkey AS VARCHAR)), 1, 24) AS _id, p_name AS ItemName,
               CAST(p_retailprice AS DECIMAL(18,2)) AS UnitPrice
        FROM part""",
    "json_array_round_trip": f"""
        SELECT o_orderkey AS OrderID, o_custkey AS CustomerID,
               {MONTH_FIRST} AS InvoiceDate, strftime(o_orderdate, '%Y-%m-%d') AS OrderDate
        FROM orders""",
    "json_array_split_read": LINES,
    "json_array_with_blanks": BRANDS,
    "brand_database": f"SELECT *, 'web_store' AS stored_in FROM ({BRANDS})",
    "delimited_round_trip": """
        SELECT CAST(c_custkey AS VARCHAR) AS Code, c_name || ', ' || c_mktsegment AS Name
        FROM customer""",
    "strip_line_breaks": """
        SELECT doc_id, md5(replace(text, '.' || chr(10), '.')) AS text_md5,
               length(replace(text, '.' || chr(10), '.')) AS n_chars
        FROM documents""",
    "typed_lines": LINES,
    "filter_equal": "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'",
    "filter_equal_ignoring_case": f"""
        SELECT CustomerID, CustomerName, CustomerEmail FROM ({CUSTOMERS})
        WHERE lower(CustomerEmail) = 'customer.000000007@example.com'""",
    "customers_inserted": f"{BASE} SELECT * FROM base UNION ALL SELECT * FROM fresh",
    "customers_updated": f"""
        {BASE} SELECT {UPDATED_COLUMNS} FROM base LEFT JOIN changes ON key = CustomerID""",
    "customers_deleted": f"""
        {BASE} SELECT * FROM base WHERE CustomerID NOT IN ({LEAVING})""",
    "change_round_trip": f"""
        {BASE}
        SELECT {CUSTOMER_COLUMNS}, 'insert' AS step FROM fresh
        UNION ALL
        SELECT {CUSTOMER_COLUMNS}, 'update' FROM fresh
        UNION ALL
        SELECT {CUSTOMER_COLUMNS}, 'delete' FROM fresh
        WHERE CustomerID NOT IN (
            SELECT s_suppkey + 1000000000000 FROM supplier WHERE s_acctbal < 0)""",
    "customers_changed": f"""
        {BASE}, latest AS ({LATEST_EVENT}), whole AS (
            SELECT user_id AS CustomerID, event_type AS CustomerPrimaryContact,
                   'event ' || event_id AS CustomerName,
                   CAST(NULL AS VARCHAR) AS CustomerEmail,
                   CAST(NULL AS VARCHAR) AS CustomerZipCode,
                   TRUE AS CustomerIsHeadOffice,
                   strftime(ts, '%Y-%m-%d') AS CustomerUpdateAt
            FROM latest)
        SELECT {CUSTOMER_COLUMNS} FROM base
        WHERE CustomerID NOT IN (SELECT user_id FROM latest)
        UNION ALL
        SELECT {CUSTOMER_COLUMNS} FROM whole
        WHERE CustomerPrimaryContact = 'purchase'
           OR (CustomerPrimaryContact <> 'error'
               AND CustomerID IN (SELECT c_custkey FROM customer))""",
    "latest_event_per_user": LATEST_EVENT,
    "column_profiles": " UNION ALL ".join(
        _profile(table, table, "2023-02-21 00:00:00") for table in PROFILED
    ),
    "monitoring_latest": " UNION ALL ".join(
        _profile(table, table, "2023-02-21 00:00:00")
        if table != "customer"
        else _profile(
            "customer",
            f"(SELECT * FROM customer WHERE c_custkey NOT IN ({LEAVING}))",
            "2023-02-22 00:00:00",
        )
        for table in PROFILED
    ),
    "storage_profiles": " UNION ALL ".join(
        f"""SELECT TIMESTAMP '2023-02-21 00:00:00' AS snapshot_at, '{table}' AS table_name,
                   TRUE AS has_files, TRUE AS has_bytes, count(*) AS n_rows
            FROM {table}"""
        for table in PROFILED
    ),
    "storage_rows": " UNION ALL ".join(
        f"""SELECT TIMESTAMP '2023-02-21 00:00:00' AS snapshot_at, '{table}' AS table_name,
                   count(*) AS n_rows
            FROM {table}"""
        for table in PROFILED
    ),
    "carriers_read_in_blocks": f"""
        SELECT {CARRIER_ID} AS _id, s_name AS name, l_orderkey AS saleid,
               strftime(o_orderdate, '%Y-%m-%d') AS shippingDate,
               strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS deliveryDate,
               l_orderkey || '-' || l_linenumber AS trackingNumber
        FROM supplier JOIN lineitem ON l_suppkey = s_suppkey
        JOIN orders ON o_orderkey = l_orderkey""",
    "documents_of_any_shape": """
        SELECT o_orderkey AS OrderID,
               CASE WHEN o_orderstatus <> 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END
                   AS OrderDate,
               CASE WHEN o_totalprice > 400000 OR o_custkey % 2 = 0
                    THEN '{' || concat_ws(',',
                        CASE WHEN o_totalprice > 400000
                             THEN '"Alerts":["' || o_orderpriority || '","},{"]' END,
                        CASE WHEN o_custkey % 2 = 0
                             THEN '"Customer":{"ID":' || o_custkey || '}' END) || '}' END AS rest
        FROM orders""",
    "texts_read_in_blocks": """
        SELECT doc_id, source, md5(text) AS text_md5, length(text) AS n_chars FROM documents""",
    "customers_numbered": f"""
        SELECT * FROM ({CUSTOMERS})
        UNION ALL
        SELECT (SELECT max(c_custkey) FROM customer)
               + row_number() OVER (ORDER BY CustomerName) AS CustomerID,
               * EXCLUDE (CustomerID)
        FROM ({NEW_CUSTOMERS})""",
    "profiles_from_sketches": " UNION ALL ".join(
        f"""SELECT * EXCLUDE (n_distinct), TRUE AS is_close
            FROM ({_profile(table, table, "2023-02-21 00:00:00")})"""
        for table in ("customer", "orders", "lineitem", "events", "documents")
    ),
    "monitoring_kept_up": " UNION ALL ".join(
        (
            _profile("events", "events", "2023-02-21 00:00:00"),
            _profile(
                "customer",
                f"(SELECT * FROM customer WHERE c_custkey NOT IN ({LEAVING}))",
                "2023-02-22 00:00:00",
            ),
        )
    ),
    "clustered_lines": f"""
        SELECT *, 'order' AS read_by FROM ({LINES}) WHERE OrderID BETWEEN 100 AND 400
        UNION ALL
        SELECT *, 'item' FROM ({LINES}) WHERE StockItemID BETWEEN 50 AND 60
        UNION ALL
        SELECT *, 'both' FROM ({LINES}) WHERE OrderID <= 1000 AND StockItemID >= 10""",
    "bucketed_join": """
        SELECT o_orderpriority, count(*) AS n_lines,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        GROUP BY o_orderpriority""",
}

# Written out and read back, with the same content.
SQL["customers_changed_in_place"] = SQL["customers_changed"]
SQL["orders_collection_repaired"] = SQL["orders_dates_normalised"]
SQL["shipments_exported"] = f"SELECT *, TRUE AS dropped FROM ({SQL['shipments_flat']})"
