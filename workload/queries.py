"""Every query on the driver's tables, by name. ``sql.py`` has the SQL for each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold import schemas
from ledgerfold.functions.dates import (
    days_between,
    iso_day,
    month_first_text,
    parse_date,
    rejected_dates,
)
from ledgerfold.functions.text import same_text, strip_crlf
from ledgerfold.operators.changes import (
    apply_changes,
    delete_by_key,
    insert_numbered,
    insert_rows,
    latest_per_key,
    update_by_key,
)
from ledgerfold.operators.keyed_store import change_store, create_store, parts_for, read_store
from ledgerfold.operators.nested import (
    lookup,
    lookup_unwind,
    project_elements,
    unwind,
)
from ledgerfold.operators.profiling import storage_profile
from ledgerfold.plans import carriers as delivery
from ledgerfold.plans import sales
from ledgerfold.plans.cleanup import normalise_customers, normalise_orders, normalise_shipments
from ledgerfold.plans.customers import (
    customers_by_email,
    delete_customers,
    insert_customers,
    update_customers,
)
from ledgerfold.plans.exports import export_array_files, export_documents
from ledgerfold.plans.monitoring import (
    keep_latest,
    keep_snapshot,
    last_monitoring,
    last_monitoring_storage,
    monitor,
    monitor_files,
    monitor_storage,
)
from ledgerfold.session import fresh_path, land
from ledgerfold.sinks.collections import (
    create_collection,
    drop_collection,
    list_databases,
    replace_collection,
    use_database,
)
from ledgerfold.sinks.files import write_delimited, write_documents, write_json_array
from ledgerfold.sinks.layout import (
    buckets_for,
    files_for,
    read_clustered,
    write_bucketed,
    write_clustered,
)
from ledgerfold.sources.blocks import read_array_blocks, read_delimited_blocks
from ledgerfold.sources.files import (
    read_delimited,
    read_json_array,
    scan_columns,
    unwrap_id,
    wrap_id,
)
from ledgerfold.sources.variants import read_variant_arrays, typed_view
from workload import tables as t

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Suppliers taken for new customers get keys far above the present ones.
NEW_KEYS = 1_000_000_000_000


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def joined_text(array: str, *fields: str) -> Column:
    """The documents of an array as one text, ``a/b;a/b``, in array order."""

    def one(item: Column) -> Column:
        return F.concat_ws("/", *[item[f].cast("string") for f in fields])

    return F.array_join(F.transform(F.col(array), one), ";")


# --- sales history -----------------------------------------------------------


@query
def sales_history_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = sales.sales_history(
        t.stock_items(spark, sf_dir),
        t.order_list(spark, sf_dir),
        t.dated_orders(spark, sf_dir).withColumn("OrderDate", iso_day(F.col("OrderDate"))),
        t.ORDER,
    )
    flat = history.withColumn(
        "lines",
        F.transform(
            "OrderList",
            lambda x: F.struct(
                x["OrderID"].alias("OrderID"),
                x["Quantity"].alias("Quantity"),
                x["UnitPrice"].alias("UnitPrice"),
                x["Order"]["CustomerID"].alias("CustomerID"),
                x["Order"]["OrderDate"].alias("OrderDate"),
            ),
        ),
    )
    text = joined_text("lines", "OrderID", "Quantity", "UnitPrice", "CustomerID", "OrderDate")
    return flat.select(
        "_id",
        "ItemName",
        F.size("OrderList").cast("bigint").alias("n_lines"),
        F.md5(text).alias("lines_md5"),
    )


@query
def sales_history_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = sales.sales_history_by_lookup(
        t.stock_items(spark, sf_dir),
        t.order_list(spark, sf_dir),
        t.dated_orders(spark, sf_dir),
        t.ORDER,
    )
    return _history_rows(unwind(history, "OrderList"))


@query
def sales_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales.sales_rows(
        t.stock_items(spark, sf_dir),
        t.order_list(spark, sf_dir),
        t.dated_orders(spark, sf_dir),
        t.ORDER,
    )
    return _history_rows(rows)


def _history_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "_id",
        "ItemName",
        F.col("OrderList.OrderID").alias("OrderID"),
        F.col("OrderList.Quantity").alias("Quantity"),
        F.col("OrderList.UnitPrice").alias("UnitPrice"),
        F.col("OrderList.Order.CustomerID").alias("CustomerID"),
        F.col("OrderList.Order.OrderDate").alias("OrderDate"),
    )


@query
def sales_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.sales_totals(
        t.stock_items(spark, sf_dir), t.order_list(spark, sf_dir), t.dated_orders(spark, sf_dir)
    )


# --- lookups -----------------------------------------------------------------


def _customers_with_orders(spark: SparkSession, sf_dir: str, right: DataFrame) -> DataFrame:
    left = t.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    order = ["o_orderkey", "day"]
    nested = lookup(left, right, "c_custkey", "o_custkey", "orders", order, left_unique=True)
    return nested.select(
        "c_custkey",
        "c_name",
        F.size("orders").cast("bigint").alias("n_orders"),
        F.md5(joined_text("orders", "o_orderkey", "day")).alias("orders_md5"),
    )


@query
def lookup_nested_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = iso_day(F.col("o_orderdate"))
    right = t.table(spark, sf_dir, "orders").withColumn("day", day)
    return _customers_with_orders(spark, sf_dir, right)


@query
def lookup_with_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = t.table(spark, sf_dir, "orders").where(
        (F.col("o_orderpriority") == "1-URGENT")
        & (F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
    )
    right = urgent.withColumn("day", iso_day(F.col("o_orderdate")))
    return _customers_with_orders(spark, sf_dir, right)


@query
def lookup_unwind_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null keys match null keys: orders without a customer key meet the keyless customer."""
    known = t.table(spark, sf_dir, "customer").select(
        F.nullif(F.col("c_custkey"), F.lit(0)).alias("key"), "c_name"
    )
    placed = t.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(F.col("o_custkey"), F.lit(0)).alias("customer")
    )
    nested = lookup_unwind(placed, known, "customer", "key", "match", ["c_name"])
    return nested.select("o_orderkey", "customer", F.col("match.c_name").alias("c_name"))


# --- carriers ----------------------------------------------------------------


@query
def carrier_avg_delivery_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.average_delivery_days(t.dated_carriers(spark, sf_dir))


@query
def carrier_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = delivery.delivery_days_with_shipments(t.dated_carriers(spark, sf_dir))
    as_days = project_elements(
        full,
        "transport",
        {
            "saleID": lambda s: s["saleID"],
            "shipped": lambda s: iso_day(s["shippingDate"]),
            "delivered": lambda s: iso_day(s["deliveryDate"]),
            "days": lambda s: s["differenceBetweenDays"],
        },
    )
    return as_days.select(
        "name",
        "avgDifferenceBetweenDays",
        F.size("transport").cast("bigint").alias("n_shipments"),
        F.md5(joined_text("transport", "saleID", "shipped", "delivered", "days")).alias(
            "shipments_md5"
        ),
    )


@query
def carrier_shipment_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = unwrap_id(delivery.shipment_counts(t.dated_carriers(spark, sf_dir)))
    return counts.withColumn("NTransportes", F.col("NTransportes").cast("bigint"))


@query
def carrier_shipment_count_with_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every carrier, and for each a new one that has not delivered anything."""
    known = t.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    new = known.select((F.col("s_suppkey") + NEW_KEYS).alias("s_suppkey"), F.concat("s_name", F.lit(" new")))
    carriers = t.build_carriers(spark, sf_dir, known.union(new))
    counts = delivery.shipment_counts(carriers, strict=True)
    return counts.select("name", F.col("NTransportes").cast("bigint").alias("NTransportes"))


@query
def carrier_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The carrier list, stored as a collection, exported as arrays, dropped, read back."""
    stored = replace_collection(delivery.carrier_list(t.carriers(spark, sf_dir)), "Logistic")
    path = fresh_path(spark, "logistic_export")
    write_json_array(stored, path)
    drop_collection(spark, "Logistic")
    dropped = F.lit(not spark.catalog.tableExists("Logistic")).alias("dropped")
    return unwrap_id(read_json_array(spark, path, schemas.LOGISTIC)).select("*", dropped)


@query
def shipments_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.shipment_list(t.dated_carriers(spark, sf_dir))


@query
def shipments_exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat list, stored as a collection, exported as arrays, dropped, read back."""
    flat = delivery.shipment_list(t.dated_carriers(spark, sf_dir))
    stored = replace_collection(flat, "Transport")
    path = fresh_path(spark, "transport_export")
    write_json_array(stored, path)
    drop_collection(spark, "Transport")
    dropped = F.lit(not spark.catalog.tableExists("Transport")).alias("dropped")
    return read_json_array(spark, path, schemas.TRANSPORT).select("*", dropped)


@query
def brand_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands stored in a database of their own, which is listed; then the former one again."""
    before = spark.catalog.currentDatabase()
    use_database(spark, "web_store")
    stored = replace_collection(t.brands(spark, sf_dir), "web_store.Brand")
    listed = list_databases(spark).where(F.col("namespace") == "web_store")
    use_database(spark, before)
    return stored.join(listed, F.lit(True)).select(
        "BrandID", "BrandName", F.col("namespace").alias("stored_in")
    )


# --- dates -------------------------------------------------------------------


@query
def nested_dates_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    repaired = normalise_shipments(t.carriers(spark, sf_dir))
    return unwind(repaired, "transport").select("name", "transport.*")


@query
def orders_dates_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_orders(t.orders(spark, sf_dir)).drop("CityID", "EmployeeID")


@query
def orders_collection_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A collection created empty, filled, and replaced by its own repaired rows."""
    drop_collection(spark, "Orders")
    create_collection(spark, "Orders", schemas.ORDERS)
    replace_collection(t.orders(spark, sf_dir), "Orders")
    repaired = replace_collection(normalise_orders(spark.table("Orders")), "Orders")
    return repaired.select("OrderID", "CustomerID", "InvoiceDate", "OrderDate")


@query
def customer_dates_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    repaired = normalise_customers(t.customers(spark, sf_dir))
    return repaired.select("CustomerID", "CustomerName", "CustomerUpdateAt")


@query
def order_dates_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    spoiled = t.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("OrderID"),
        F.when(F.col("o_orderstatus") == "P", F.lit("pending"))
        .otherwise(month_first_text(F.col("o_orderdate")))
        .alias("InvoiceDate"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("2013-02-31"))
        .otherwise(iso_day(F.col("o_orderdate")))
        .alias("OrderDate"),
    )
    return rejected_dates(spoiled, "OrderID", ["InvoiceDate", "OrderDate"])


@query
def event_midnights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days from the first to the last event per user: midnights, not 24-hour spans."""
    spans = (
        t.table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    )
    days = days_between(F.col("first_ts"), F.col("last_ts")).cast("bigint")
    return spans.select("user_id", days.alias("days"))


@query
def event_dates_with_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times written as text of a two-hour offset, in many forms, read back as UTC."""
    shifted = F.col("ts") + F.expr("INTERVAL 2 HOURS")
    local = F.date_format(shifted, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    offsets = ["+02:00", "+02", "+2:00", "+0200", "+02:00:00", " UTC+2", "UTC+02:00", " Etc/GMT-2"]
    number = (F.col("event_id") % len(offsets)).cast("int")
    text = F.concat(local, F.array(*map(F.lit, offsets))[number])
    events = t.table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return events.select("event_id", parse_date(F.col("text")).alias("ts"))


# --- exports and files -------------------------------------------------------


@query
def export_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export_documents(t.customers(spark, sf_dir), "Customer")


@query
def export_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export_documents(t.orders(spark, sf_dir), "Orders")


@query
def export_order_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export_documents(t.order_list(spark, sf_dir), "OrderList")


@query
def export_stock_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export_documents(t.stock_items(spark, sf_dir), "StockItem")


@query
def export_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export_documents(t.brands(spark, sf_dir), "Brand")


@query
def export_tax_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export_documents(t.tax_rates(spark, sf_dir), "TaxRate")


@query
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with a wrapped id written as JSON lines and read with a schema."""
    oid = F.substring(F.sha1(F.col("p_partkey").cast("string")), 1, 24)
    items = t.table(spark, sf_dir, "part").select(
        oid.alias("_id"),
        F.col("p_name").alias("ItemName"),
        t.money("p_retailprice").alias("UnitPrice"),
    )
    path = fresh_path(spark, "items_json")
    write_documents(wrap_id(items), path)
    schema = "_id STRUCT<`$oid`: STRING>, ItemName STRING, UnitPrice DECIMAL(18,2)"
    return unwrap_id(spark.read.schema(schema).json(path))


@query
def json_array_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders exported as files of JSON arrays and imported, a file per task."""
    path = fresh_path(spark, "orders_arrays")
    export_array_files(t.orders(spark, sf_dir), "Orders", path)
    return read_json_array(spark, path, schemas.ORDERS).drop("CityID", "EmployeeID")


@query
def json_array_split_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines exported as files of JSON arrays, each read by many tasks."""
    path = fresh_path(spark, "lines_arrays")
    export_array_files(t.order_list(spark, sf_dir), "OrderList", path)
    return read_json_array(spark, path, schemas.ORDER_LIST, split=True)


@query
def carriers_read_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carriers with their shipments exported as JSON arrays, each read by many tasks."""
    path = fresh_path(spark, "carrier_arrays")
    write_json_array(t.carriers(spark, sf_dir), path)
    carriers = read_array_blocks(spark, path, schemas.LOGISTIC_TRANSPORT)
    shipments = unwind(unwrap_id(carriers), "transport")
    return shipments.select("_id", "name", "transport.*")


@query
def documents_of_any_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents whose fields differ: two are declared, the others stay together."""
    orders = t.table(spark, sf_dir, "orders")
    high = F.col("o_totalprice") > 400000
    documents = orders.select(
        F.col("o_orderkey").alias("OrderID"),
        F.when(F.col("o_orderstatus") != "F", iso_day(F.col("o_orderdate"))).alias("OrderDate"),
        F.when(high, F.array("o_orderpriority", F.lit("},{"))).alias("Alerts"),
        F.when(F.col("o_custkey") % 2 == 0, F.struct(F.col("o_custkey").alias("ID"))).alias("Customer"),
    )
    path = fresh_path(spark, "order_documents")
    write_json_array(documents, path)
    stored = land(read_variant_arrays(spark, path), "order_variants")
    typed = typed_view(stored, "OrderID BIGINT, OrderDate STRING")
    return typed.withColumn("rest", F.to_json("rest"))


@query
def json_array_with_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as an array with blanks and line breaks between its documents, read in pieces."""
    documents = export_documents(t.brands(spark, sf_dir), "Brand").withColumn("all", F.lit(1))
    between = F.concat(F.lit("[ "), F.array_join(F.array_sort(F.collect_list("document")), " ,\n "))
    path = fresh_path(spark, "brands_spaced")
    array = documents.groupBy("all").agg(F.concat(between, F.lit("\n]")).alias("value"))
    array.select("value").write.text(path)
    return read_json_array(spark, path, schemas.BRAND, split=True)


@query
def delimited_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = t.table(spark, sf_dir, "customer")
    coded = customers.select(
        F.col("c_custkey").cast("string").alias("Code"),
        F.concat_ws(", ", "c_name", "c_mktsegment").alias("Name"),
    )
    path = fresh_path(spark, "codes_csv")
    write_delimited(coded, path)
    return read_delimited(spark, path, schemas.STATES)


@query
def texts_read_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, line breaks and all, as delimited files that many tasks read."""
    texts = t.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    path = fresh_path(spark, "texts_csv")
    write_delimited(texts, path)
    read = read_delimited_blocks(spark, path, "doc_id BIGINT, source STRING, text STRING")
    length = F.length("text").cast("bigint")
    return read.select("doc_id", "source", F.md5("text").alias("text_md5"), length.alias("n_chars"))


@query
def strip_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with every second kind of line break as CR+LF, stripped of those."""
    with_cr = F.replace(F.col("text"), F.lit(".\n"), F.lit(".\r\n"))
    stripped = strip_crlf(with_cr)
    return t.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(stripped).alias("text_md5"),
        F.length(stripped).cast("bigint").alias("n_chars"),
    )


@query
def typed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"]
    lines = scan_columns(spark, f"{sf_dir}/lineitem.parquet", columns)
    return lines.select(
        F.col("l_orderkey").alias("OrderID"),
        F.col("l_partkey").alias("StockItemID"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        t.money("l_extendedprice").alias("UnitPrice"),
    )


# --- filters and changes -----------------------------------------------------


@query
def filter_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.table(spark, sf_dir, "customer").where(same_text(F.col("c_mktsegment"), "BUILDING"))


@query
def filter_equal_ignoring_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = customers_by_email(
        t.customers(spark, sf_dir), "CUSTOMER.000000007@Example.com", ignore_case=True
    )
    return found.select("CustomerID", "CustomerName", "CustomerEmail")


def _new_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + NEW_KEYS).alias("CustomerID"),
        F.col("s_name").alias("CustomerName"),
        F.lit("email").alias("CustomerEmail"),
        F.lit("20913").alias("CustomerZipCode"),
        F.lit(False).alias("CustomerIsHeadOffice"),
        F.lit("2023-02-21").alias("CustomerUpdateAt"),
    )


def _order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer of an order: the last order day, or null for big spenders."""
    last = (
        t.table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.max("o_orderdate").alias("last_day"), F.max("o_totalprice").alias("highest"))
    )
    day = F.when(F.col("highest") <= 400000, iso_day(F.col("last_day")))
    seen = last.select(
        F.col("o_custkey").alias("CustomerID"),
        F.lit("22222 PrimaryContact").alias("CustomerPrimaryContact"),
        day.alias("CustomerUpdateAt"),
    )
    unknown = _new_customers(spark, sf_dir).select(
        "CustomerID", t.nothing("string").alias("CustomerPrimaryContact"), "CustomerUpdateAt"
    )
    return seen.unionByName(unknown)


def _leaving(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = t.table(spark, sf_dir, "orders").where(
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 400000)
    )
    return urgent.select(F.col("o_custkey").alias("CustomerID")).distinct()


def _customer_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "CustomerID",
        "CustomerPrimaryContact",
        "CustomerName",
        "CustomerEmail",
        "CustomerZipCode",
        "CustomerIsHeadOffice",
        "CustomerUpdateAt",
    )


@query
def customers_inserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = t.customers(spark, sf_dir)
    return _customer_columns(insert_rows(base, _new_customers(spark, sf_dir)))


@query
def customers_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = t.customers(spark, sf_dir)
    changes = _order_changes(spark, sf_dir)
    return _customer_columns(update_by_key(base, changes, "CustomerID"))


@query
def customers_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = t.customers(spark, sf_dir)
    return _customer_columns(delete_by_key(base, _leaving(spark, sf_dir), "CustomerID"))


@query
def change_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert, then update, then delete, and the rows with the new e-mail after each."""
    inserted = insert_customers(t.customers(spark, sf_dir), _new_customers(spark, sf_dir))
    updated = update_customers(inserted, _order_changes(spark, sf_dir))
    in_debt = t.table(spark, sf_dir, "supplier").where(F.col("s_acctbal") < 0)
    gone = in_debt.select((F.col("s_suppkey") + NEW_KEYS).alias("CustomerID"))
    deleted = delete_customers(updated, gone)
    steps = {"insert": inserted, "update": updated, "delete": deleted}
    found = [
        _customer_columns(customers_by_email(df, "email")).withColumn("step", F.lit(step))
        for step, df in steps.items()
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def customers_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change set with many changes per key, the last of which counts."""
    base = _customer_columns(t.customers(spark, sf_dir))
    changes = _event_changes(spark, sf_dir)
    return apply_changes(base, changes, "CustomerID", order_by=["ts", "event_id"])


def _event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = (
        F.when(F.col("event_type") == "error", "D")
        .when(F.col("event_type") == "purchase", "I")
        .otherwise("U")
    )
    return t.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("CustomerID"),
        F.col("event_type").alias("CustomerPrimaryContact"),
        F.concat(F.lit("event "), "event_id").alias("CustomerName"),
        t.nothing("string").alias("CustomerEmail"),
        t.nothing("string").alias("CustomerZipCode"),
        F.lit(True).alias("CustomerIsHeadOffice"),
        iso_day(F.col("ts")).alias("CustomerUpdateAt"),
        op.alias("op"),
        "ts",
        "event_id",
    )


@query
def customers_changed_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes made to customers stored by key: only the parts they touch change."""
    size = storage_profile(spark, f"{sf_dir}/customer.parquet", "customer", "2023-02-21").first()
    path = fresh_path(spark, "customers_by_key")
    parts = max(16, parts_for(size["n_bytes"]))
    create_store(_customer_columns(t.customers(spark, sf_dir)), path, "CustomerID", parts)
    change_store(spark, path, _event_changes(spark, sf_dir), order_by=["ts", "event_id"])
    return read_store(spark, path)


@query
def customers_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers become customers; the table gives their keys, in the order of their names."""
    base = t.customers(spark, sf_dir)
    new = _new_customers(spark, sf_dir).drop("CustomerID")
    return _customer_columns(insert_numbered(base, new, "CustomerID", ["CustomerName"]))


# --- monitoring --------------------------------------------------------------


@query
def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(t.table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


@query
def column_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: t.table(spark, sf_dir, name) for name in t.TABLES}
    return monitor(tables, "2023-02-21 00:00:00", exact=True)


@query
def monitoring_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two kept snapshots, the second after a change; the last one per column."""
    before = {name: t.table(spark, sf_dir, name) for name in t.TABLES}
    leaving = _leaving(spark, sf_dir).withColumnRenamed("CustomerID", "c_custkey")
    after = {"customer": delete_by_key(before["customer"], leaving, "c_custkey")}
    path = fresh_path(spark, "monitoring")
    keep_snapshot(monitor(before, "2023-02-21 00:00:00", exact=True), path)
    keep_snapshot(monitor(after, "2023-02-22 00:00:00", exact=True), path)
    return last_monitoring(spark.read.parquet(path))


@query
def profiles_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles kept up from sketches while tables grow by files: counts are exact, and
    distinct values are shown as whether they are within 5 % of the exact count."""
    names, at = ("customer", "orders", "lineitem", "events", "documents"), "2023-02-21 00:00:00"
    store = fresh_path(spark, "sketches")
    paths = {name: fresh_path(spark, f"grown_{name}") for name in names}
    for half in (0, 1):
        for name, path in paths.items():
            rows = t.table(spark, sf_dir, name)
            mine = rows.where(F.pmod(F.xxhash64(rows[rows.columns[0]]), F.lit(2)) == half)
            mine.write.mode("append").parquet(path)
        kept_up = monitor_files(spark, paths, store, at)
    exact = monitor({name: t.table(spark, sf_dir, name) for name in names}, at, exact=True)
    exact = exact.select("table_name", "column_name", F.col("n_distinct").alias("exact"))
    close = F.abs(F.col("n_distinct") - F.col("exact")) <= F.col("exact") * 0.05
    joined = kept_up.join(exact, ["table_name", "column_name"])
    return joined.withColumn("is_close", close).drop("n_distinct", "exact")


@query
def monitoring_kept_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last snapshot of each table's columns, kept up snapshot by snapshot."""
    drop_collection(spark, "LastMonitoring")
    customers, events = (t.table(spark, sf_dir, name) for name in ("customer", "events"))
    leaving = _leaving(spark, sf_dir).withColumnRenamed("CustomerID", "c_custkey")
    left = delete_by_key(customers, leaving, "c_custkey")
    both = {"customer": customers, "events": events}
    keep_latest(monitor(both, "2023-02-21 00:00:00", exact=True), "LastMonitoring")
    keep_latest(monitor({"customer": left}, "2023-02-22 00:00:00", exact=True), "LastMonitoring")
    # One that comes late changes nothing.
    late = monitor({"events": events.where("false")}, "2023-02-20 00:00:00", exact=True)
    return keep_latest(late, "LastMonitoring")


@query
def storage_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes are shown as whether there are any: SQL on the tables does not see files."""
    paths = {name: f"{sf_dir}/{name}.parquet" for name in t.TABLES}
    path = fresh_path(spark, "monitoring_storage")
    keep_snapshot(monitor_storage(spark, paths, "2023-02-21 00:00:00"), path)
    return last_monitoring_storage(spark.read.parquet(path)).select(
        "snapshot_at",
        "table_name",
        (F.col("n_files") > 0).alias("has_files"),
        (F.col("n_bytes") > 0).alias("has_bytes"),
        "n_rows",
    )


@query
def storage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts taken from the footers of the stored files."""
    paths = {name: f"{sf_dir}/{name}.parquet" for name in t.TABLES}
    return monitor_storage(spark, paths, "2023-02-21 00:00:00").drop("n_files", "n_bytes")


# --- layout ------------------------------------------------------------------


@query
def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines and orders stored in buckets by order, and joined bucket by bucket."""
    lines = t.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    orders = t.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    size = storage_profile(spark, f"{sf_dir}/lineitem.parquet", "lineitem", "2023-02-21").first()
    buckets = buckets_for(size["n_bytes"])
    lines = write_bucketed(lines, "lines_by_order", "l_orderkey", buckets)
    orders = write_bucketed(orders, "orders_by_order", "o_orderkey", buckets)
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    return joined.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
    )


@query
def clustered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines clustered by order and product, read by a range of either."""
    lines = t.order_list(spark, sf_dir)
    size = storage_profile(spark, f"{sf_dir}/lineitem.parquet", "lineitem", "2023-02-21").first()
    path = fresh_path(spark, "lines_clustered")
    write_clustered(lines, path, ["OrderID", "StockItemID"], max(64, files_for(size["n_bytes"])))
    by_order = read_clustered(spark, path, {"OrderID": (100, 400)})
    by_item = read_clustered(spark, path, {"StockItemID": (50, 60)})
    by_both = read_clustered(spark, path, {"OrderID": (None, 1000), "StockItemID": (10, None)})
    found = {"order": by_order, "item": by_item, "both": by_both}
    labelled = [df.withColumn("read_by", F.lit(name)) for name, df in found.items()]
    return labelled[0].unionByName(labelled[1]).unionByName(labelled[2])
