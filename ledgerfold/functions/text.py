"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_crlf(text: Column) -> Column:
    """Remove each CR+LF pair; a lone CR or LF stays."""
    return F.replace(text, F.lit("\r\n"), F.lit(""))


def same_text(column: Column, value: str, ignore_case: bool = False) -> Column:
    """Equality with a text value, as a filter the scan can take over.

    ``ignore_case`` compares under a case-insensitive collation, as a database
    column may; that form is evaluated after the scan.
    """
    if ignore_case:
        return F.collate(column, "UTF8_LCASE") == F.lit(value)
    return column == F.lit(value)
