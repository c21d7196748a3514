"""Declared schemas of the collections, as they arrive in JSON or delimited files.

Dates arrive as text; ``plans.cleanup`` turns them into timestamps. Field names,
their spelling included, are fixed values: they have to match the files.
"""

CUSTOMER = (
    "CustomerID BIGINT, BillToCustomerID BIGINT, BuyingGroupID BIGINT, "
    "CustomerPrimaryContact STRING, CustomerName STRING, CustomerEmail STRING, "
    "CustomerPassword STRING, CustomerZipCode STRING, CustomerIsHeadOffice BOOLEAN, "
    "CustomerUpdateAt STRING"
)

ORDERS = (
    "OrderID BIGINT, CustomerID BIGINT, CityID BIGINT, EmployeeID BIGINT, "
    "InvoiceDate STRING, OrderDate STRING"
)

ORDER_LIST = "OrderID BIGINT, StockItemID BIGINT, Quantity INT, UnitPrice DECIMAL(18,2)"

STOCK_ITEM = (
    "StockItemID BIGINT, ColorID INT, BrandID INT, SizeID INT, SellingPackageID INT, "
    "BuyingPackageID INT, ItemName STRING, LeadTimeDays INT, QuantityPerOuter INT, "
    "IsChillerStock BOOLEAN, BarCode STRING, TaxRateID INT, UnitPrice DECIMAL(18,2), "
    "RecomendedRetailPrice DECIMAL(18,2), TypicalWeightPerUnit DECIMAL(18,3)"
)

BRAND = "BrandID INT, BrandName STRING"

TAX_RATE = "TaxRateID INT, TaxRate DECIMAL(18,2)"

# Ids come wrapped as {"_id": {"$oid": "..."}}; see sources.files.unwrap_id.
LOGISTIC = "_id STRUCT<`$oid`: STRING>, name STRING"

LOGISTIC_TRANSPORT = (
    "_id STRUCT<`$oid`: STRING>, name STRING, transport ARRAY<STRUCT<saleid: BIGINT, "
    "shippingDate: STRING, deliveryDate: STRING, trackingNumber: STRING>>"
)

TRANSPORT = (
    "saleid BIGINT, name STRING, shippingDate STRING, deliveryDate STRING, "
    "trackingNumber STRING"
)

STATES = "Code STRING, Name STRING"

COLLECTIONS = {
    "Customer": CUSTOMER,
    "TaxRate": TAX_RATE,
    "Brand": BRAND,
    "StockItem": STOCK_ITEM,
    "Orders": ORDERS,
    "OrderList": ORDER_LIST,
    "LogisticTransport": LOGISTIC_TRANSPORT,
}
