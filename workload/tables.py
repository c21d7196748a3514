"""The driver's tables, renamed and shaped as the collections the library works on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.functions.dates import iso_day, month_first_text
from ledgerfold.operators.nested import lookup
from ledgerfold.plans.cleanup import normalise_shipments

#: Columns that ``dated_orders`` has of an order.
ORDER = ["OrderID", "CustomerID", "OrderDate"]

#: All tables, in the order of their keys.
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def nothing(kind: str) -> Column:
    return F.lit(None).cast(kind)


def stock_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("StockItemID"),
        nothing("int").alias("ColorID"),
        F.substring_index("p_brand", "#", -1).cast("int").alias("BrandID"),
        F.col("p_size").alias("SizeID"),
        nothing("int").alias("SellingPackageID"),
        nothing("int").alias("BuyingPackageID"),
        F.col("p_name").alias("ItemName"),
        nothing("int").alias("LeadTimeDays"),
        nothing("int").alias("QuantityPerOuter"),
        (F.col("p_type") == "ECONOMY").alias("IsChillerStock"),
        nothing("string").alias("BarCode"),
        nothing("int").alias("TaxRateID"),
        money("p_retailprice").alias("UnitPrice"),
        money("p_retailprice").alias("RecomendedRetailPrice"),
        nothing("decimal(18,3)").alias("TypicalWeightPerUnit"),
    )


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select("p_brand").distinct()
    number = F.substring_index("p_brand", "#", -1).cast("int")
    return names.select(number.alias("BrandID"), F.col("p_brand").alias("BrandName"))


def tax_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    percent = (F.col("l_tax") * 100).cast("decimal(18,2)")
    rates = table(spark, sf_dir, "lineitem").select(percent.alias("TaxRate")).distinct()
    return rates.select((F.col("TaxRate").cast("int") + 1).alias("TaxRateID"), "TaxRate")


def order_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("OrderID"),
        F.col("l_partkey").alias("StockItemID"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        money("l_extendedprice").alias("UnitPrice"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their dates as text, in the two forms an export can give."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("OrderID"),
        F.col("o_custkey").alias("CustomerID"),
        nothing("bigint").alias("CityID"),
        nothing("bigint").alias("EmployeeID"),
        month_first_text(F.col("o_orderdate")).alias("InvoiceDate"),
        iso_day(F.col("o_orderdate")).alias("OrderDate"),
    )


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders after date repair."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("OrderID"),
        F.col("o_custkey").alias("CustomerID"),
        F.col("o_orderdate").alias("OrderDate"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    email = F.concat(F.replace(F.lower("c_name"), F.lit("#"), F.lit(".")), F.lit("@example.com"))
    updated = F.date_add(F.lit("2013-01-01").cast("date"), (F.col("c_custkey") % 3650).cast("int"))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CustomerID"),
        F.col("c_custkey").alias("BillToCustomerID"),
        F.col("c_nationkey").cast("bigint").alias("BuyingGroupID"),
        nothing("string").alias("CustomerPrimaryContact"),
        F.col("c_name").alias("CustomerName"),
        email.alias("CustomerEmail"),
        nothing("string").alias("CustomerPassword"),
        F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0").alias("CustomerZipCode"),
        (F.col("c_mktsegment") == "BUILDING").alias("CustomerIsHeadOffice"),
        updated.cast("string").alias("CustomerUpdateAt"),
    )


def build_carriers(spark: SparkSession, sf_dir: str, names: DataFrame) -> DataFrame:
    """Carriers ``s_suppkey, s_name`` with all order lines they delivered as shipments."""
    ordered = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem")
    shipped = lines.join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
    shipment = [
        F.col("l_orderkey").alias("saleid"),
        iso_day(F.col("o_orderdate")).alias("shippingDate"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("deliveryDate"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("trackingNumber"),
    ]
    nested = lookup(
        names, shipped, "s_suppkey", "l_suppkey", "transport", shipment, left_unique=True
    )
    oid = F.substring(F.sha1(F.col("s_suppkey").cast("string")), 1, 24)
    return nested.select(
        F.struct(oid.alias("$oid")).alias("_id"), F.col("s_name").alias("name"), "transport"
    )


def carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the carrier collection, its shipment dates still text."""
    names = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return build_carriers(spark, sf_dir, names)


def dated_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The carrier collection after date repair."""
    return normalise_shipments(carriers(spark, sf_dir))
