"""Large files read by many tasks where values may hold what separates documents.

Whether a bracket, comma or line break separates depends on all that stands before it:
it may be within a text, or deeper in a document. So a file is looked at twice. Tasks first
say, each for its blocks, what a block does to whoever enters it: whether it leaves him
in or out of a text, and by how many brackets deeper, for both ways to enter. These
effects, a few numbers per block, are composed in the order of the blocks, which gives
the state every block begins in. Then tasks read their blocks again and cut them. What
lies between two cuts of a block is a whole document; what begins in one block and ends in
a later one is put together from its fragments, two per block at most.

Blocks are Spark's file splits; a split ends where the reader's line separator stands,
``}`` for JSON and a line break for delimited text, so no byte is seen by two tasks.
Pieces stay in the tasks that read them. The driver holds one small row per block, as it
does to schedule the blocks: 100 TB in blocks of 128 MB are 800,000 rows of 21 bytes.
The cut texts are stored once, so later queries read no file again. A file in a
compression that cannot be split is one block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerfold.session import importable, land

QUOTE, COMMA, BACKSLASH, LINE = b'",\\\n'
OPEN, CLOSE = b"[]"

#: Bytes that a scan stops at, and by how much each goes deeper.
MARKS = {"json": b'"{}[],', "delimited": b'"\n'}
DEEPER = np.zeros(256, np.int64)
DEEPER[list(b"{[")] = 1
DEEPER[list(b"}]")] = -1

EFFECT = "file LONG, start LONG, flips INT, outside LONG, inside LONG"
CUT = (
    "file LONG, start LONG, opens BOOLEAN, whole BOOLEAN, first BOOLEAN, closings INT, text BINARY"
)
BLANK = b" \t\r\n"

#: Cut texts are handed on when there are so many, or so many bytes of them.
BATCH_ROWS, BATCH_BYTES = 1000, 8 * 1024 * 1024

#: What a value that is not there is parsed as, which no text is; a quoted empty text is none.
MISSING = "\x00\x01missing\x01\x00"


class Malformed(ValueError):
    """A file that is not what it is read as."""


def _pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """``file, start, value``: what lies between separators, in the order of each block."""
    # Folders below the path only divide the files; their names add no column.
    reader = spark.read.option("recursiveFileLookup", True).option("lineSep", separator)
    return reader.text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("value"),
    )


def _chunks(
    batches: Iterator[pa.RecordBatch], separator: bytes
) -> Iterator[tuple[tuple[int, int], bytes]]:
    """The bytes of blocks, some at a time, each piece with its separator behind it."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        new = (file[1:] != file[:-1]) | (start[1:] != start[:-1])
        begins = np.flatnonzero(np.r_[True, new]).tolist()
        for a, b in zip(begins, [*begins[1:], batch.num_rows]):
            values = batch.column(2).slice(a, b - a)
            joined = pc.binary_join(pa.ListArray.from_arrays([0, b - a], values), separator)
            yield (int(file[a]), int(start[a])), joined[0].as_py() + separator


def _marks(data: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the marks of a chunk, and the marks; no escaped quotes."""
    wanted = np.zeros(256, bool)
    wanted[list(MARKS[kind])] = True
    at = np.flatnonzero(wanted[data])
    mark = data[at]
    if kind == "json" and (data == BACKSLASH).any():
        quotes = np.flatnonzero(mark == QUOTE)
        others = np.flatnonzero(data != BACKSLASH)
        place = np.searchsorted(others, at[quotes])
        before = np.where(place > 0, others[place - 1], -1)
        escaped = quotes[(at[quotes] - before) % 2 == 0]
        at, mark = np.delete(at, escaped), np.delete(mark, escaped)
    return at, mark


def _effects(kind: str, separator: bytes) -> Callable:
    def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, done = None, (0, 0, 0)
        for key, raw in _chunks(batches, separator):
            if key != block:
                if block is not None:
                    yield _row(EFFECT_SCHEMA, (*block, *done))
                block, done = key, (0, 0, 0)
            _, mark = _marks(np.frombuffer(raw, np.uint8), kind)
            crossed = np.cumsum(mark == QUOTE)
            steps = DEEPER[mark]
            even = int(steps[crossed % 2 == 0].sum())
            both = (even, int(steps.sum()) - even)
            flips, outside, inside = done
            done = (
                (flips + int(crossed[-1] if len(crossed) else 0)) % 2,
                outside + both[flips],
                inside + both[1 - flips],
            )
        if block is not None:
            yield _row(EFFECT_SCHEMA, (*block, *done))

    return effects


EFFECT_SCHEMA = pa.schema(
    [("file", pa.int64()), ("start", pa.int64()), ("flips", pa.int32()), ("outside", pa.int64()), ("inside", pa.int64())]
)
CUT_SCHEMA = pa.schema(
    [
        ("file", pa.int64()),
        ("start", pa.int64()),
        ("opens", pa.bool_()),
        ("whole", pa.bool_()),
        ("first", pa.bool_()),
        ("closings", pa.int32()),
        ("text", pa.binary()),
    ]
)


def _row(schema: pa.Schema, *rows: tuple) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def block_states(pieces: DataFrame, kind: str, separator: bytes) -> DataFrame:
    """``file, start``, and whether the block begins ``in_text`` and how ``deep``; and, of
    the last block of a file, the state it ends in."""
    effects = land(pieces.mapInArrow(_effects(kind, separator), EFFECT), "block_effects")
    in_order = Window.partitionBy("file").orderBy("start")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    entered = F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2
    known = effects.withColumn("in_text", entered)
    known = known.withColumn("deeper", F.when(F.col("in_text") == 0, F.col("outside")).otherwise(F.col("inside")))
    deep = F.coalesce(F.sum("deeper").over(before), F.lit(0))
    known = known.withColumn("deep", deep)
    is_last = F.lead("start").over(in_order).isNull()
    return known.select(
        "file",
        "start",
        (F.col("in_text") == 1).alias("in_text"),
        F.col("deep").cast("int").alias("deep"),
        F.when(is_last, (F.col("in_text") + F.col("flips")) % 2).alias("end_in_text"),
        F.when(is_last, F.col("deep") + F.col("deeper")).alias("end_deep"),
    )


def _states_for_tasks(spark: SparkSession, states: DataFrame, end_deep: int):
    """The state of each block, for all tasks: one row of 21 bytes per block."""
    states = land(states, "block_states")
    wrong = states.where(f"end_in_text <> 0 OR end_deep <> {end_deep}").count()
    if wrong:
        raise Malformed(f"malformed: {wrong} files end within a text or a document")
    table = states.select("file", "start", "in_text", "deep").toArrow()
    arrays = [table.column(c).to_numpy() for c in ("file", "start", "in_text", "deep")]
    order = np.lexsort((arrays[1], arrays[0]))
    return spark.sparkContext.broadcast([a[order] for a in arrays])


def _state(arrays: list[np.ndarray], key: tuple[int, int]) -> tuple[bool, int]:
    file, start, in_text, deep = arrays
    a, b = np.searchsorted(file, key[0]), np.searchsorted(file, key[0], side="right")
    i = a + np.searchsorted(start[a:b], key[1])
    return bool(in_text[i]), int(deep[i])


class _Cutter:
    """Cuts one block, chunk by chunk; rows are as in ``CUT``."""

    def __init__(self, key: tuple[int, int], state: tuple[bool, int]):
        self.key = key
        self.in_text, self.deep = state
        self.carry: list[bytes] = []
        self.closings = 0
        self.n_cut = 0

    def take(self, segment: bytes, closings: int) -> tuple[bytes, int]:
        text = b"".join([*self.carry, segment])
        closings += self.closings
        self.carry, self.closings = [], 0
        return text, closings

    def row(self, opens: bool, whole: bool, text: bytes, closings: int) -> tuple:
        first = self.key[1] == 0 and opens and self.n_cut == 0
        self.n_cut += 1
        return (*self.key, opens, whole, first, closings, text)


class _JsonCutter(_Cutter):
    def __init__(self, key, state):
        super().__init__(key, state)
        if self.deep < 1 and key[1] > 0 or self.deep < 0:
            raise Malformed("malformed array: brackets close what is not open")
        #: Whether the document at hand began in this block; where the array's end is.
        self.opened = False
        self.ended = False
        self.alone = False

    def feed(self, raw: bytes) -> Iterator[tuple]:
        if self.ended and raw.strip(BLANK):
            raise Malformed("malformed array: there is text after its end")
        data = np.frombuffer(raw, np.uint8)
        at, mark = _marks(data, "json")
        quote = mark == QUOTE
        crossed = np.cumsum(quote) + self.in_text
        free = (crossed % 2 == 0) & ~quote
        at, mark = at[free], mark[free]
        step = DEEPER[mark]
        deep = self.deep + np.cumsum(step)
        if len(deep) and (deep < 0).any():
            # The separator added behind a file's last piece, and nothing else.
            if deep.min() < -1 or deep[-1] != -1 or (deep[:-1] < 0).any() or at[-1] != len(raw) - 1:
                raise Malformed("malformed array: brackets close what is not open")
            raw, at, mark, step, deep = raw[:-1], at[:-1], mark[:-1], step[:-1], deep[:-1]
        is_cut = ((mark == COMMA) & (deep == 1)) | ((step > 0) & (deep == 1)) | ((step < 0) & (deep == 0))
        closes = at[(step < 0) & (deep == 1)]
        n_closed = np.searchsorted(closes, at[is_cut]).tolist()
        begin, closed = 0, 0
        for cut, sign, n in zip(at[is_cut].tolist(), mark[is_cut].tolist(), n_closed):
            text, closings = self.take(raw[begin:cut], n - closed)
            begin, closed = cut + 1, n
            if sign == OPEN:
                if self.ended or self.opened or self.key[1] > 0 or text.strip(BLANK):
                    raise Malformed("malformed array: there is text before or after it")
                self.alone = True
            elif sign != COMMA and sign != CLOSE:
                raise Malformed("malformed array: it does not begin and end in square brackets")
            elif not (sign == CLOSE and self.alone and not text.strip(BLANK)):
                yield self.row(self.opened, self.opened, text, closings)
                self.alone = False
            self.opened = True
            self.ended = sign == CLOSE
            if self.ended and raw[begin:].strip(BLANK):
                raise Malformed("malformed array: there is text after its end")
        self.carry.append(raw[begin:])
        self.closings += len(closes) - closed
        self.in_text = bool(self.in_text) != bool(int(quote.sum()) % 2)
        self.deep = int(deep[-1]) if len(deep) else self.deep

    def end(self) -> Iterator[tuple]:
        if not self.ended:
            text, closings = self.take(b"", 0)
            yield self.row(self.opened, False, text, closings)


class _RecordCutter(_Cutter):
    def __init__(self, key, state, sep: bytes):
        super().__init__(key, state)
        self.sep = sep
        self.opened = not self.in_text

    def feed(self, raw: bytes) -> Iterator[tuple]:
        data = np.frombuffer(raw, np.uint8)
        at, mark = _marks(data, "delimited")
        quote = mark == QUOTE
        crossed = np.cumsum(quote) + self.in_text
        opening = at[quote & (crossed % 2 == 1)]
        after = data[opening[opening > 0] - 1]
        if not np.isin(after, list(self.sep + b'"\n')).all():
            raise Malformed("malformed record: a quote within a value that is not quoted")
        closing = at[quote & (crossed % 2 == 0)]
        if not np.isin(data[closing + 1], list(self.sep + b'"\r\n')).all():
            raise Malformed("malformed record: text behind the quote that ends a value")
        begin = 0
        for cut in at[~quote & (crossed % 2 == 0)].tolist():
            text, _ = self.take(raw[begin:cut], 0)
            begin = cut + 1
            yield self.row(self.opened, self.opened, text.removesuffix(b"\r"), 0)
            self.opened = True
        self.carry.append(raw[begin:])
        self.in_text = bool(crossed[-1] % 2) if len(crossed) else self.in_text

    def end(self) -> Iterator[tuple]:
        text, _ = self.take(b"", 0)
        if text or not self.opened:
            yield self.row(self.opened, False, text, 0)


def _cuts(states, cutter: Callable, separator: bytes) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work, rows, n_bytes = None, [], 0
        for key, raw in _chunks(batches, separator):
            if at_work is None or key != at_work.key:
                if at_work is not None:
                    rows.extend(at_work.end())
                at_work = cutter(key, _state(states.value, key))
            for row in at_work.feed(raw):
                rows.append(row)
                n_bytes += len(row[-1])
                if len(rows) >= BATCH_ROWS or n_bytes >= BATCH_BYTES:
                    yield _row(CUT_SCHEMA, *rows)
                    rows, n_bytes = [], 0
        if at_work is not None:
            rows.extend(at_work.end())
        if rows:
            yield _row(CUT_SCHEMA, *rows)

    return cut


def _texts(cut: DataFrame) -> DataFrame:
    """``text, closings, first`` of whole documents and of those put together."""
    columns = [F.col("text").cast("string").alias("text"), "closings", "first"]
    whole = cut.where("whole").select(*columns)
    # Of a block, what ends in it comes before what begins in it.
    in_order = Window.partitionBy("file").orderBy("start", "opens")
    begun = cut.where("NOT whole").withColumn("number", F.sum(F.col("opens").cast("int")).over(in_order))
    fragment = F.struct("start", "opens", F.col("text").cast("string").alias("text"))
    joined = begun.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(fragment)).alias("fragments"),
        F.sum("closings").cast("int").alias("closings"),
        F.bool_or("first").alias("first"),
    )
    text = F.array_join(F.col("fragments")["text"], "").alias("text")
    return whole.unionByName(joined.select(text, "closings", "first"))


def _malformed(text: Column, what: str, kind: T.DataType) -> Column:
    shown = F.concat(F.lit(f"malformed {what}: "), F.left(text, F.lit(200)))
    return F.raise_error(shown).cast(kind)


def array_texts(spark: SparkSession, path: str) -> DataFrame:
    """``text`` of each document of files that each hold one JSON array of documents.

    Raises on what is not one array of documents: at once where brackets or quotes do not
    close, else when rows are read. The texts are stored when this is called.
    """
    importable(spark)
    pieces = _pieces(spark, path, "}")
    # At the end of a file the last piece is read with a bracket that is not there.
    states = _states_for_tasks(spark, block_states(pieces, "json", b"}"), end_deep=-1)
    cut = land(pieces.mapInArrow(_cuts(states, _JsonCutter, b"}"), CUT), "documents_cut")
    rows = _texts(cut).select(F.btrim("text", F.lit(BLANK.decode())).alias("text"), "closings")
    one = (F.col("closings") == 1) & F.startswith("text", F.lit("{")) & F.endswith("text", F.lit("}"))
    wrong = _malformed(F.col("text"), "document", T.StringType())
    return rows.select(F.when(one, F.col("text")).otherwise(wrong).alias("text"))


def read_array_blocks(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read files that each hold one JSON array of documents of any depth, in parallel.

    Gives the rows of ``read_json_array``, in no order; raises as ``array_texts`` does,
    and on what does not fit the schema.
    """
    document = F.from_json("text", T.StructType.fromDDL(schema), {"mode": "FAILFAST"})
    # As an array, so that also a count parses every document.
    return array_texts(spark, path).select(F.inline(F.array(document)))


def read_delimited_blocks(
    spark: SparkSession, path: str, schema: str, sep: str = ";", header: bool = True
) -> DataFrame:
    """Read delimited files in parallel, line breaks within quoted values included.

    Gives the rows of ``read_delimited``, in no order, with its checks; only line breaks
    within values stay as they are, where that one turns those like the file's own line
    ends into plain ones. A quote is
    allowed where a quoted value begins and ends and, doubled, within it; elsewhere it
    raises, as what it means would depend on what comes before. Lines without a
    character are no records. The records are stored as text when this is called.
    """
    if len(sep.encode()) != 1:
        raise ValueError("a separator is one ASCII character")
    importable(spark)
    pieces = _pieces(spark, path, "\n")
    states = _states_for_tasks(spark, block_states(pieces, "delimited", b"\n"), end_deep=0)
    at_sep = sep.encode()

    def cutter(key, state):
        return _RecordCutter(key, state, at_sep)

    cut = land(pieces.mapInArrow(_cuts(states, cutter, b"\n"), CUT), "records_cut")
    element = T.StructType.fromDDL(schema)
    options = {"sep": sep, "escape": '"', "emptyValue": "", "nullValue": MISSING, "mode": "FAILFAST", "multiLine": "true"}
    records = _texts(cut).where("text <> ''")
    if header:
        names = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(element))])
        found = F.from_csv("text", names.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
        same = F.lit(True)
        for i, name in enumerate(element.names):
            same = same & F.coalesce(F.lower(found[f"c{i}"]) == name.lower(), F.lit(False))
        wrong = _malformed(F.col("text"), "header", T.BooleanType())
        records = records.where(F.when(~F.col("first"), True).when(same, False).otherwise(wrong))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in element)
    return records.select(F.inline(F.array(F.from_csv("text", ddl, options))))
