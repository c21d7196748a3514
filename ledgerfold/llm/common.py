"""What the operators share: columns that cannot clash, words, folds, text digests.

Every operator takes a DataFrame of documents and the names of its id and text
columns. Inside, a row is ``doc_id``, ``text`` and ``rest``, a struct of all other
columns, so that no column of the caller can clash with one of ours.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.session import importable

#: What separates words: the six ASCII blanks, as ``bytes.split()`` takes them.
WORD = r"[^\x20\x09-\x0D]+"

#: Arrow batches are worked through in slices of about this much text.
SLICE_BYTES = 8 * 1024 * 1024


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id long, text string, rest struct`` of documents of any schema."""
    importable(docs.sparkSession)
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    # A struct needs a field; documents without other columns get an empty one.
    rest = F.struct(*[docs[f"`{c}`"].alias(c) for c in others] or [F.lit(None).cast("int")])
    return docs.select(
        docs[f"`{id_col}`"].cast("long").alias("doc_id"),
        docs[f"`{text_col}`"].cast("string").alias("text"),
        rest.alias("rest"),
    )


def unpacked(
    rows: DataFrame, like: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> list[Column]:
    """The columns of ``like`` out of a frame that ``packed`` gave, in their order."""
    names = {id_col: "doc_id", text_col: "text"}
    types = dict(like.dtypes)
    return [
        (F.col(names[c]).cast(types[c]) if c in names else F.col("rest")[c]).alias(c)
        for c in like.columns
    ]


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text``, so that a scan reads two columns."""
    return packed(docs, id_col, text_col).select("doc_id", "text")


def fold(doc_id: Column, folds: int) -> Column:
    """CRC-32 of the id as text, modulo the number of folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def as_bytes(texts: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of each text."""
    return texts.cast(pa.binary()).to_pylist()


def slices(
    batches: Iterator[pa.RecordBatch], text: int = 1, size: int | None = None
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text, one row at least.

    A Python process works through tasks of many stages, and Arrow keeps what they have
    freed; it is given back before a task's first batch and after each.
    """
    size = size or SLICE_BYTES
    pool = pa.default_memory_pool()
    pool.release_unused()
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(text)).fill_null(0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + size, side="right"))
            stop = max(stop, start + 1)
            yield batch.slice(start, stop - start)
            start = stop
        pool.release_unused()


def binaries(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary array whose i-th value is ``values[offsets[i]:offsets[i + 1]]``, uncopied."""
    data = np.ascontiguousarray(values).view(np.uint8).reshape(-1)
    width = values.dtype.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    ends = np.asarray(offsets, np.int64) * width
    if len(ends) and ends[-1] > np.iinfo(np.int32).max:
        raise OverflowError("a binary array holds 2 GB at the most")
    ends = ends.astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)]
    )


def sample_by_hash(labels: DataFrame, id_col: str, label_col: str, size: int) -> DataFrame:
    """``doc_id, label`` of about ``size`` labelled ids, or all if there are no more.

    Ids are chosen by a hash, so a run that is repeated takes the same ones. An id that
    comes several times is one row, labelled 1 if any of its rows is.
    """
    known = labels.select(
        labels[f"`{id_col}`"].cast("long").alias("doc_id"),
        labels[f"`{label_col}`"].cast("int").alias("label"),
    ).where("doc_id IS NOT NULL AND label IN (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    n = known.count()
    if n <= size:
        return known
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 40))
    return known.where(place < (1 << 40) * size // n)


#: A key that more than one in so many rows ask for is a heavy one; there are fewer than this.
HEAVY = 20_000


def look_up(
    rows: DataFrame, table: DataFrame, keys: list[str], weight: str, heavy: int = HEAVY
) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row per key and, as
    ``weight``, the number of rows that ask for it.

    Keys with more than one in ``heavy`` of all rows are fewer than ``heavy``: they are
    broadcast. For the others the rows are shuffled by key, and no key has more than
    that share. Rows without a partner are left out; ``weight`` is not given back.
    ``table`` should be a stored one, as it is read three times.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    is_heavy = F.col(weight) > F.lit(total // heavy + 1)
    hot = F.broadcast(table.where(is_heavy).drop(weight))
    by_hot = rows.join(hot, keys)
    others = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return by_hot.unionByName(others.join(table.where(~is_heavy).drop(weight), keys))
