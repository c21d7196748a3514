"""Token counts through a cache keyed by digests of content and tokenizer version.

A text's counts are looked up by the SHA-256 of its normalised content and the
digest of the tokenizer file. Only distinct contents the cache lacks are encoded, and
their counts are appended to it, so a later run encodes what is new.

Normalising must not change a count. For this tokenizer, which has no normaliser,
that leaves null to empty text; a caller with a tokenizer that folds case or blanks
may pass its own expression.

Encoding: the byte-level pattern never joins a character and a space that follows
it, so a text may be cut before each space that stands after no other blank, and the
counts of the pieces added up. Pieces repeat, so a task keeps their counts in a table
of bounded size.

Scale: copies of a content are dropped before the shuffle and after it, so one
content held by a third of all rows is one row per task. The last join is on a
digest and may be skewed by copies; it is a plain equi-join, which Spark splits.

Edge cases: null text counts as empty (0 tokens, 0 bytes); texts of any length are
encoded whole, in pieces; a content that the cache holds more than once counts once;
repeated rows each get a row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ledgerfold.llm.common import ids_and_texts, slices
from ledgerfold.session import land

CACHE = "content_digest STRING, tokenizer_digest STRING, n_tokens LONG"

#: Pieces whose counts a task remembers; beyond this it starts anew.
PIECES = 400_000

#: Encoded at once where the remembered counts lack them.
MISSES = 20_000

#: Pieces longer than this many characters are encoded each time.
REMEMBERED = 64

#: Control characters count as blanks here: a cut less never changes a count.
_AFTER_BLANK = re.compile(r"[\s\x00-\x1f] ")
_CUT = re.compile(r"(?<![\s\x00-\x1f])(?= )")

#: Tokenizers of this Python process, by file, with the counts of pieces.
_loaded: dict[str, tuple[object, dict[str, int]]] = {}


def tokenizer_digest(path: str) -> str:
    """The version of a tokenizer: the digest of its file."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def as_it_is(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def _tokenizer(path: str):
    if path not in _loaded:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on each core
        from tokenizers import Tokenizer

        _loaded[path] = (Tokenizer.from_file(path), {})
    return _loaded[path]


def _pieces(text: str) -> list[str]:
    """The text cut before each space that does not stand after another blank."""
    if _AFTER_BLANK.search(text):
        return _CUT.split(text)
    first, *others = text.split(" ")
    return [first, *[" " + piece for piece in others]]


def count_tokens(path: str, texts: list[str]) -> list[int]:
    """Tokens of each text, as the library counts them without added special tokens."""
    tokenizer, known = _tokenizer(path)
    cut = [_pieces(text) for text in texts]
    distinct = {piece for pieces in cut for piece in pieces}
    missing = list(distinct.difference(known))
    if len(known) + len(missing) > PIECES:
        known.clear()
        missing = list(distinct)
    for start in range(0, len(missing), MISSES):
        some = missing[start : start + MISSES]
        encoded = tokenizer.encode_batch_fast(some, add_special_tokens=False)
        known.update(zip(some, map(len, encoded)))
    counts = [sum(map(known.__getitem__, pieces)) for pieces in cut]
    for piece in missing:
        if len(piece) > REMEMBERED:
            del known[piece]
    return counts


def _encoder(path: str, digest: str) -> Callable:
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts = count_tokens(path, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([digest] * len(counts)), pa.array(counts, pa.int64())],
                names=["content_digest", "tokenizer_digest", "n_tokens"],
            )

    return encoded


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; none if nothing has been stored there yet."""
    try:
        return spark.read.schema(CACHE).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    cache_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = as_it_is,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every document; extends the cache on the way."""
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer_path)
    rows = ids_and_texts(docs, id_col, text_col)
    content = normalise(F.col("text"))
    keyed = rows.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        F.sha2(content.cast("binary"), 256).alias("content_digest"),
        content.alias("text"),
    )

    def stored() -> DataFrame:
        mine = read_cache(spark, cache_path).where(F.col("tokenizer_digest") == version)
        return mine.select("content_digest", "n_tokens")

    # Distinct first: a task sends one row of a content, however many copies it has.
    distinct = keyed.select("content_digest", "text").dropDuplicates(["content_digest"])
    misses = distinct.join(stored().select("content_digest"), "content_digest", "left_anti")
    counted = misses.mapInArrow(_encoder(tokenizer_path, version), CACHE)
    counted.write.mode("append").parquet(cache_path)
    # Runs that fill a cache at the same time may store a content twice. What is read is
    # stored as one row each, so the join is one that Spark can split at a hot content.
    one_each = stored().groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))
    counts = land(one_each, "token_counts")
    return keyed.drop("text").join(counts, "content_digest").select("doc_id", "n_bytes", "n_tokens")
