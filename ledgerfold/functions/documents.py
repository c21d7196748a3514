"""Rows to JSON text and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_document(columns: list[str | Column]) -> Column:
    """One JSON object per row. Null fields are left out; decimals keep their scale."""
    return F.to_json(F.struct(*columns))


def from_document(text: Column, schema: str) -> Column:
    """JSON text to a struct of the declared schema; bad JSON raises."""
    return F.from_json(text, schema, {"mode": "FAILFAST"})
