"""Documents of no fixed shape: kept whole, with a typed view of the fields that are declared.

A collection of a document store has documents whose fields differ. They are kept as
``VARIANT``, in which every value has its own type; declared fields are taken out as
columns, and the others stay together in one column, so nothing is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold.sources.blocks import array_texts


def read_variant_arrays(spark: SparkSession, path: str) -> DataFrame:
    """``document VARIANT`` of files that each hold one JSON array, read by many tasks."""
    return array_texts(spark, path).select(F.parse_json("text").alias("document"))


def read_variant_lines(spark: SparkSession, path: str) -> DataFrame:
    """``document VARIANT`` of files with a document per line; blank lines are none."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    return lines.where(F.trim("value") != "").select(F.parse_json("value").alias("document"))


def _ddl(kind: T.DataType) -> str:
    """A type's text, with names in quotes."""
    if isinstance(kind, T.StructType):
        fields = ", ".join(f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in kind)
        return f"struct<{fields}>"
    if isinstance(kind, T.ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"map<{_ddl(kind.keyType)}, {_ddl(kind.valueType)}>"
    return kind.simpleString()


def _field(document: Column, name: str, kind: T.DataType, strict: bool) -> Column:
    if '"' in name or "\\" in name:
        raise ValueError(f"a declared field has a quote or backslash in its name: {name}")
    get = F.variant_get if strict else F.try_variant_get
    return get(document, f'$["{name}"]', _ddl(kind))


def typed_view(
    documents: DataFrame,
    schema: str,
    document: str = "document",
    rest: str | None = "rest",
    strict: bool = True,
) -> DataFrame:
    """The declared fields of each document as columns, the others in ``rest``.

    A field a document lacks is null. One whose value is of another type raises, or, with
    ``strict=False``, is null. ``rest`` is an object without the declared fields, null
    where there are no others; None leaves it out.
    """
    fields = T.StructType.fromDDL(schema).fields
    column = F.col(document)
    columns = [_field(column, f.name, f.dataType, strict).alias(f.name) for f in fields]
    if rest:
        entries = F.try_variant_get(column, "$", "map<string,variant>")
        names = [f.name for f in fields]
        others = F.map_filter(entries, lambda name, _: ~name.isin(*names))
        columns.append(F.when(F.size(others) > 0, F.to_variant_object(others)).alias(rest))
    return documents.select(*columns)


def variant_text(documents: DataFrame, document: str = "document") -> DataFrame:
    """``document`` as JSON text, its fields in the order of their names."""
    return documents.select(F.to_json(document).alias("document"))
