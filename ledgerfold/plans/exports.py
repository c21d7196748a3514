"""Column lists of the table exports, and the exports themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerfold.sinks.files import to_documents, write_json_array

# The columns each export has. The customer's password is left out.
EXPORTED = {
    "Customer": [
        "CustomerID",
        "BillToCustomerID",
        "BuyingGroupID",
        "CustomerPrimaryContact",
        "CustomerName",
        "CustomerEmail",
        "CustomerZipCode",
        "CustomerIsHeadOffice",
        "CustomerUpdateAt",
    ],
    "Orders": [
        "OrderID",
        "CustomerID",
        "CityID",
        "EmployeeID",
        "InvoiceDate",
        "OrderDate",
    ],
    "OrderList": ["OrderID", "StockItemID", "Quantity", "UnitPrice"],
    "StockItem": [
        "StockItemID",
        "ColorID",
        "BrandID",
        "SizeID",
        "SellingPackageID",
        "BuyingPackageID",
        "ItemName",
        "LeadTimeDays",
        "QuantityPerOuter",
        "IsChillerStock",
        "BarCode",
        "TaxRateID",
        "UnitPrice",
        "RecomendedRetailPrice",
        "TypicalWeightPerUnit",
    ],
    "Brand": ["BrandID", "BrandName"],
    "TaxRate": ["TaxRateID", "TaxRate"],
}


def export_documents(df: DataFrame, collection: str) -> DataFrame:
    """The export of a table as one JSON document per row.

    JSON writing escapes line breaks inside values, so no raw CR+LF is left that
    ``functions.text.strip_crlf`` would have to take out.
    """
    return to_documents(df, EXPORTED[collection])


def export_array_files(
    df: DataFrame, collection: str, path: str, files: int | None = None
) -> None:
    """The export of a table as files of JSON arrays, ready for import."""
    write_json_array(df.select(*EXPORTED[collection]), path, files)
