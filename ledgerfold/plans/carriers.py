"""Carriers with nested shipments: delivery days, counts, and flat lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.dates import days_between, iso_day
from ledgerfold.operators.gather import push
from ledgerfold.operators.nested import array_count, unwind


def _shipments(carriers: DataFrame, *fields: str) -> DataFrame:
    """One row per shipment with the days from shipping to delivery added to it."""
    wanted = [*fields, "shippingDate", "deliveryDate"]
    rows = unwind(carriers.select("name", "transport"), "transport", wanted)
    days = days_between(F.col("transport.shippingDate"), F.col("transport.deliveryDate"))
    return rows.withColumn("differenceBetweenDays", days)


def average_delivery_days(carriers: DataFrame) -> DataFrame:
    """``name, avgDifferenceBetweenDays``: one partial sum per task is shuffled."""
    average = F.avg("differenceBetweenDays").alias("avgDifferenceBetweenDays")
    return _shipments(carriers).groupBy("name").agg(average)


def delivery_days_with_shipments(carriers: DataFrame) -> DataFrame:
    """The average with the carrier's shipments: ``name, avg..., transport[]``.

    A carrier has one document, whatever the number of its shipments; for very large
    ones take ``average_delivery_days`` and flat rows.
    """
    return push(
        _shipments(carriers, "saleid"),
        ["name"],
        [
            F.col("transport.saleid").alias("saleID"),
            F.col("transport.shippingDate").alias("shippingDate"),
            F.col("transport.deliveryDate").alias("deliveryDate"),
            "differenceBetweenDays",
        ],
        "transport",
        totals={"avgDifferenceBetweenDays": F.avg("differenceBetweenDays")},
    )


def shipment_counts(carriers: DataFrame, strict: bool = False) -> DataFrame:
    """``_id, name, NTransportes`` per carrier document."""
    count = array_count(carriers, "transport", strict)
    return carriers.select("_id", "name", count.alias("NTransportes"))


def carrier_list(carriers: DataFrame) -> DataFrame:
    """``_id, name`` per carrier document."""
    return carriers.select("_id", "name")


def shipment_list(carriers: DataFrame) -> DataFrame:
    """One flat row per shipment, with dates as ``yyyy-MM-dd`` text."""
    rows = unwind(carriers.select("name", "transport"), "transport")
    return rows.select(
        F.col("transport.saleid").alias("saleid"),
        "name",
        iso_day(F.col("transport.shippingDate")).alias("shippingDate"),
        iso_day(F.col("transport.deliveryDate")).alias("deliveryDate"),
        F.col("transport.trackingNumber").alias("trackingNumber"),
    )
