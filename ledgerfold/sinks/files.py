"""Documents written as files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame

from ledgerfold.functions.documents import to_document


def to_documents(df: DataFrame, columns: list[str | Column]) -> DataFrame:
    """One row ``document`` of JSON text per row, from the listed columns."""
    return df.select(to_document(columns).alias("document"))


def write_documents(df: DataFrame, path: str) -> None:
    """One JSON document per line, written by all tasks."""
    df.write.json(path)


def write_json_array(df: DataFrame, path: str, files: int | None = None) -> None:
    """Files that each hold one JSON array.

    By default every task writes an array of the rows it has: nothing is shuffled.
    ``files`` asks for so many of about equal size; 1 gives the one array of a small
    collection, from one task. A collection without rows is one empty array. Each file
    can be imported on its own, or all at once by ``read_json_array``.
    """
    documents = to_documents(df, df.columns)
    if files:
        documents = documents.repartition(files)
    documents.mapInArrow(_array, "value STRING").write.text(path)


def _array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of a task as lines of one array; whole batches are joined to a line."""
    before = "["
    for batch in batches:
        if batch.num_rows:
            joined = pc.binary_join(pa.ListArray.from_arrays([0, batch.num_rows], batch.column(0)), ",")
            yield pa.RecordBatch.from_arrays([pa.array([before + joined[0].as_py()])], ["value"])
            before = ","
    context = TaskContext.get()
    if before == ",":
        yield pa.RecordBatch.from_arrays([pa.array(["]"])], ["value"])
    elif context is None or context.partitionId() == 0:
        yield pa.RecordBatch.from_arrays([pa.array(["[]"])], ["value"])


def write_delimited(df: DataFrame, path: str, sep: str = ";") -> None:
    """Delimited text with a header line, one file per task.

    Values come back from ``read_delimited`` as they are: blanks are kept, an empty
    text is quoted and so is not a null, and so is one with a line break.
    """
    writer = df.write.option("sep", sep).option("header", True)
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.option("nullValue", "").option("emptyValue", '""').option("escape", '"').csv(path)
