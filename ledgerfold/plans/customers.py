"""Insert, update and delete a customer, and find customers by e-mail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.text import same_text
from ledgerfold.operators.changes import delete_by_key, insert_rows, update_by_key

KEY = "CustomerID"


def insert_customers(customers: DataFrame, rows: DataFrame) -> DataFrame:
    return insert_rows(customers, rows)


def update_customers(customers: DataFrame, changes: DataFrame) -> DataFrame:
    return update_by_key(customers, changes, KEY)


def delete_customers(customers: DataFrame, keys: DataFrame) -> DataFrame:
    return delete_by_key(customers, keys, KEY)


def customers_by_email(
    customers: DataFrame, email: str, ignore_case: bool = False
) -> DataFrame:
    return customers.where(same_text(F.col("CustomerEmail"), email, ignore_case))
