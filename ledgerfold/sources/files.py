"""JSON-array and delimited files with declared schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json_array(
    spark: SparkSession, path: str, schema: str, split: bool = False
) -> DataFrame:
    """Read files that each hold one JSON array of documents.

    What does not fit the schema raises, such as a flag written as 0 or 1: read that
    as INT and cast it.

    By default a file is one task's work, so many files of moderate size read in
    parallel and one huge file does not. ``split=True`` cuts a file between
    documents, at ``},{``, and reads it in as many tasks as it has blocks. What
    lies between two cuts is read as an array of its own, of one document or, where
    blanks or line breaks stand between documents, of several. A cut at the wrong
    place (a nested array of documents, or ``},{`` inside a text value), text after
    the array, or a second array, raises.
    """
    # Folders below the path only divide the files; their names add no column.
    reader = spark.read.option("recursiveFileLookup", True)
    if not split:
        reader = reader.schema(schema).option("multiLine", True)
        return reader.option("mode", "FAILFAST").json(path)

    pieces = reader.option("lineSep", "},{").text(path)
    value = F.col("value")
    # Only the first and last piece of a file have the array's brackets on them.
    bare = F.regexp_replace(value, r"^\s*\[\s*\{|\}\s*\]\s*$", "")
    filled = pieces.where(~value.rlike(r"^\s*\[\s*\]\s*$") & (F.trim(value) != ""))
    text = F.concat(F.lit("[{"), bare, F.lit("}]"))
    element = T.StructType.fromDDL(schema)
    documents = F.from_json(text, T.ArrayType(element), {"mode": "FAILFAST"})
    complaint = F.raise_error(F.concat(F.lit("malformed array of documents: "), F.left(text, F.lit(200))))
    # inline also parses where no column is asked for, so a bare count raises as well
    checked = F.when(_one_array(text), documents).otherwise(complaint.cast(T.ArrayType(element)))
    return filled.select(F.inline(checked))


def _one_array(text: Column) -> Column:
    """Whether a text's brackets are those of one array and nothing after it.

    A parser stops where the first array ends, and would not see the rest.
    """
    outside = F.regexp_replace(text, r'"(?:[^"\\]|\\.)*"', "")
    brackets = F.regexp_replace(outside, r"[^\[\]{}\"]", "")

    def next_depth(depth: Column, bracket: Column) -> Column:
        opened = depth + F.when(bracket.isin("[", "{"), 1).otherwise(-1)
        # Once the array has ended, or at a stray quote, there is no way back.
        return F.when((depth < 0) | (bracket == '"'), -2).when(opened == 0, -1).otherwise(opened)

    def depth_over(characters: Column) -> Column:
        steps = F.slice(characters, F.lit(2), F.greatest(F.size(characters) - 1, F.lit(0)))
        return F.aggregate(steps, F.lit(1), lambda d, b: F.when(d == -1, -2).otherwise(next_depth(d, b)))

    flat = brackets == "[{}]"
    return flat | (depth_over(F.split(brackets, "")) == -1)


def read_delimited(
    spark: SparkSession, path: str, schema: str, sep: str = ";", header: bool = True
) -> DataFrame:
    """Read a delimited reference file.

    A line that does not fit the schema raises, and so does a header with other names.
    An empty text is quoted, a value that is not there is null. A value may hold line
    breaks within its quotes, so a file is one task's work.
    """
    reader = spark.read.schema(schema).option("sep", sep).option("header", header)
    reader = reader.option("enforceSchema", False).option("multiLine", True)
    reader = reader.option("emptyValue", "").option("nullValue", None).option("escape", '"')
    return reader.option("mode", "FAILFAST").csv(path)


def scan_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Read only the listed columns of a Parquet table."""
    return spark.read.parquet(path).select(*columns)


def unwrap_id(df: DataFrame, column: str = "_id") -> DataFrame:
    """``{"$oid": "..."}`` to a plain string id."""
    return df.withColumn(column, F.col(column).getField("$oid"))


def wrap_id(df: DataFrame, column: str = "_id") -> DataFrame:
    """A plain string id to ``{"$oid": "..."}``."""
    if isinstance(df.schema[column].dataType, T.StructType):
        return df
    return df.withColumn(column, F.struct(F.col(column).alias("$oid")))
