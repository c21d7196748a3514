"""Text dates to dates, at top level and inside arrays. Safe to run twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.dates import as_date
from ledgerfold.operators.nested import map_fields, path_type


def normalise_dates(df: DataFrame, columns: list[str], on_error: str = "raise") -> DataFrame:
    """Text in the given columns to dates; columns that are dates already stay."""
    types = {c: df.schema[c].dataType for c in columns}
    return df.withColumns({c: as_date(F.col(c), types[c], on_error) for c in columns})


def normalise_orders(orders: DataFrame, on_error: str = "raise") -> DataFrame:
    return normalise_dates(orders, ["InvoiceDate", "OrderDate"], on_error)


def normalise_customers(customers: DataFrame, on_error: str = "raise") -> DataFrame:
    return normalise_dates(customers, ["CustomerUpdateAt"], on_error)


def normalise_shipments(
    carriers: DataFrame, on_error: str = "raise", null_element: str = "keep"
) -> DataFrame:
    """Dates inside each carrier's ``transport`` array."""
    element = path_type(carriers, "transport").elementType

    def repaired(name: str):
        data_type = element[name].dataType

        def value(shipment: Column) -> Column:
            return as_date(shipment[name], data_type, on_error)

        return value

    fields = {name: repaired(name) for name in ("shippingDate", "deliveryDate")}
    return map_fields(carriers, "transport", fields, null_element)
