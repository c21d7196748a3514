"""Packing documents into token sequences of equal cost.

A piece of ``n`` tokens costs ``n + n * n / horizon``: a linear part, and a quadratic
one for attention, which sees one document at a time. Documents in descending order
go to the sequence of lowest cost that has room, and are cut where it is full. As
many sequences are open as the tokens need, so together they are filled but for less
than one sequence.

Scale: a task packs windows of the documents it has scanned, ``window_tokens`` tokens
(four bytes each) at a time, into sequences that are full to the end. The tokens over,
less than one sequence, go to the task's next window, and those of its last one are
shuffled: ``TOGETHER`` tasks' are packed by one, with less than one sequence of padding
for all of them. So padding does not depend on how the input is split. Sequence ids are made of
task and count. The pieces are stored before what is over is packed.

Edge cases: null and empty texts are a document of the end token alone; a document
longer than a sequence is cut into several pieces; ties go to the lower doc_id and
the older sequence; repeated rows are separate documents; an empty table gives no
sequence.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import as_bytes, ids_and_texts, slices
from ledgerfold.session import land

SEQUENCE = 4096
WINDOW_TOKENS = 4 * 1024 * 1024

#: A piece of this many tokens costs as much by its square as by its length.
HORIZON = 2048

#: Parts of words whose ids a task remembers; beyond this it starts anew.
WORDS = 500_000
IDS = 4_000_000
MISSES = 2_000

#: Texts are encoded in slices of about this many bytes: a word of a slice takes about a
#: hundred bytes of numbers while its ids are put together.
ENCODED_TOGETHER = 2 * 1024 * 1024

#: Tasks whose left-over tokens, less than one sequence of each, are packed together.
TOGETHER = 1024

#: Marks that a word of letters may end with; one run of them is one part.
MARKS = ".,;:!?%$#&*|)("

PIECES = (
    "doc_id LONG, start LONG, length LONG, ids_crc32 LONG, doc_tokens LONG, "
    "sequence_id LONG, offset LONG"
)


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


class Held(NamedTuple):
    """Ids of a document from ``start`` on that are not in a sequence yet."""

    doc_id: int | None
    start: int
    doc_tokens: int
    ids: np.ndarray


class WordEncoder:
    """Ids of texts, by way of the ids of their words.

    For tokenizers that drop blanks and never join characters across one, that lower
    the case and take letters, digits and marks apart, and end each such part with a
    token of its own kind, as that of ``word_bpe_49k.json`` does: a text's ids are
    those of its words, one after the other, and a word of letters with marks after it
    has the ids of its letters and then of the marks. These parts are remembered up to
    a bound.
    """

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on each core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        #: Number of each known part; part n has the ids from start n to start n + 1.
        self._number: dict[str, int] = {"": 0}
        self._starts = np.zeros(2, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def _add(self, parts: list[str], ids: list[np.ndarray], sizes: np.ndarray) -> None:
        known = len(self._number)
        self._number.update(zip(parts, range(known, known + len(parts))))
        self._starts = np.concatenate([self._starts, self._starts[-1] + np.cumsum(sizes)])
        self._ids = np.concatenate([self._ids, *ids])

    def _encode_parts(self, parts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        encoded = self._tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        ids = [np.array(one.ids, np.uint32) for one in encoded]
        return ids, np.array([len(one) for one in ids], np.int64)

    def _encode_letters(self, parts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """Many words of letters as one text, cut after the tokens that end a word."""
        joined = self._tokenizer.encode_batch_fast([" ".join(parts)], add_special_tokens=False)
        ids = np.array(joined[0].ids, np.uint32)
        ends = np.flatnonzero(self._ends[ids]) + 1
        if len(ends) != len(parts):  # a letter that lowering the case makes two signs
            return self._encode_parts(parts)
        return [ids], np.diff(ends, prepend=0)

    def _numbers(self, parts: pa.Array, bounded: bool) -> np.ndarray:
        """Numbers of parts, which are learned where they are new."""
        coded = parts.dictionary_encode()
        distinct = coded.dictionary
        names = distinct.to_pylist()
        new = [n for n, name in enumerate(names) if name not in self._number]
        if bounded and (len(self._number) + len(new) > WORDS or len(self._ids) > IDS):
            raise OverflowError
        of_letters = pc.utf8_is_alpha(distinct).to_numpy(zero_copy_only=False)
        for letters, encode in ((True, self._encode_letters), (False, self._encode_parts)):
            some = [names[n] for n in new if of_letters[n] == letters]
            found = [encode(some[at : at + MISSES]) for at in range(0, len(some), MISSES)]
            if found:
                ids = [one for part in found for one in part[0]]
                self._add(some, ids, np.concatenate([part[1] for part in found]))
        known = np.fromiter(map(self._number.__getitem__, names), np.int64, len(names))
        return known[coded.indices.to_numpy()]

    def _learn(self, words: pa.Array, bounded: bool) -> np.ndarray:
        """For each word the numbers of its letters and of the marks after them."""
        core = pc.utf8_rtrim(words, MARKS)
        core = pc.if_else(pc.utf8_is_alpha(core), core, words)
        n_marks = pc.subtract(pc.binary_length(words), pc.binary_length(core)).to_numpy()
        lower = pc.and_(pc.utf8_is_alpha(core), pc.string_is_ascii(core))
        numbers = np.zeros((len(words), 2), np.int64)
        numbers[:, 0] = self._numbers(pc.if_else(lower, pc.ascii_lower(core), core), bounded)
        for n in np.unique(n_marks[n_marks > 0]).tolist():
            rows = np.flatnonzero(n_marks == n)
            # Marks are one byte each.
            marks = pc.utf8_slice_codeunits(words.take(pa.array(rows)), -n)
            numbers[rows, 1] = self._numbers(marks, bounded)
        return numbers

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        cut = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
        words = cut.flatten().dictionary_encode()
        try:
            numbers = self._learn(words.dictionary, bounded=True)
        except OverflowError:
            self._forget()
            if len(words.dictionary) > WORDS and len(texts) > 1:
                half = len(texts) // 2
                return self.encode(texts[:half]) + self.encode(texts[half:])
            if len(words.dictionary) > WORDS:
                whole = self._tokenizer.encode(texts[0].decode(), add_special_tokens=False)
                return [np.array(whole.ids, np.uint32)]
            numbers = self._learn(words.dictionary, bounded=False)
        number = numbers[words.indices.to_numpy()].reshape(-1)
        starts = self._starts[number]
        sizes = self._starts[number + 1] - starts
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        ids = self._ids[np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])]
        # Two parts per word.
        of_texts = ends[2 * (cut.offsets.to_numpy() - cut.offsets[0].as_py())].tolist()
        return [ids[a:b] for a, b in zip(of_texts[:-1], of_texts[1:])]


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """One per Python process, which works through many tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def encoded(
    batches: Iterator[pa.RecordBatch], encoder: WordEncoder, end_id: int
) -> Iterator[tuple[int | None, np.ndarray]]:
    """Id of each document, and the ids of its tokens with the end token."""
    for batch in slices(batches, size=ENCODED_TOGETHER):
        texts = [text or b"" for text in as_bytes(batch.column(1))]
        for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
            yield doc_id, np.append(ids, np.uint32(end_id)).astype("<u4")


def assign(
    lengths: list[int], sequence: int = SEQUENCE, horizon: int = HORIZON
) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` for documents of given lengths.

    ``lengths`` is in descending order. Every token is in exactly one piece.
    """
    n_open = -(-sum(lengths) // sequence)
    heap = [(0.0, number, 0) for number in range(n_open)]
    pieces = []
    for document, length in enumerate(lengths):
        start = 0
        while start < length:
            cost, number, used = heapq.heappop(heap)
            part = min(length - start, sequence - used)
            pieces.append((document, start, part, number, used))
            if used + part < sequence:
                added = part + part * part / horizon
                heapq.heappush(heap, (cost + added, number, used + part))
            start += part
    return pieces


def _held_back(held: list[Held], n_tokens: int) -> list[Held]:
    """Takes so many tokens off the end of ``held``, the last document cut if need be."""
    back = []
    while n_tokens:
        one = held.pop()
        if len(one.ids) > n_tokens:
            cut = len(one.ids) - n_tokens
            held.append(one._replace(ids=one.ids[:cut]))
            one = one._replace(ids=one.ids[cut:], start=one.start + cut)
        back.append(one)
        n_tokens -= len(one.ids)
    return back


def _rows(held: list[Held], first: int, sequence: int, horizon: int) -> pa.RecordBatch:
    """The pieces of ``held`` in sequences numbered from ``first``."""
    pieces = assign([len(one.ids) for one in held], sequence, horizon)
    columns = [
        [held[d].doc_id for d, *_ in pieces],
        [held[d].start + s for d, s, *_ in pieces],
        [n for _, _, n, _, _ in pieces],
        [zlib.crc32(held[d].ids[s : s + n]) for d, s, n, _, _ in pieces],
        [held[d].doc_tokens for d, *_ in pieces],
        [first + number for _, _, _, number, _ in pieces],
        [offset for *_, offset in pieces],
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=NAMES)


def _in_order(held: list[Held]) -> None:
    held.sort(key=lambda one: (-len(one.ids), one.doc_id is None, one.doc_id or 0, one.start))


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence: int = SEQUENCE,
    window_tokens: int = WINDOW_TOKENS,
    horizon: int = HORIZON,
    together: int = TOGETHER,
) -> DataFrame:
    """One row per piece, as ``PIECES`` says: where it comes from and where it goes."""

    def packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer_path)
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        first, n_held = task << 36, 0
        held: list[Held] = []

        def packed() -> pa.RecordBatch:
            """Sequences filled to the end; what is over stays held."""
            nonlocal first, held, n_held
            _in_order(held)
            back = _held_back(held, n_held % sequence)
            rows = _rows(held, first, sequence, horizon)
            first += n_held // sequence
            held, n_held = back, n_held % sequence
            return rows.append_column("ids", pa.nulls(rows.num_rows, pa.binary()))

        for doc_id, ids in encoded(batches, encoder, end_id):
            held.append(Held(doc_id, 0, len(ids), ids))
            n_held += len(ids)
            if n_held >= window_tokens:
                yield packed()
        if n_held >= sequence:
            yield packed()
        if held:
            columns = [
                pa.array([getattr(one, name) for one in held], pa.int64())
                for name in ("doc_id", "start", "doc_tokens")
            ]
            unset = pa.nulls(len(held), pa.int64())
            numbers = pa.array([task] * len(held), pa.int64())
            doc_ids, starts, doc_tokens = columns
            ids = pa.array([one.ids.tobytes() for one in held], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [doc_ids, starts, unset, unset, doc_tokens, numbers, unset, ids], names=[*NAMES, "ids"]
            )

    def left_over(key: tuple, table: pa.Table) -> pa.Table:
        """What some tasks have left, packed together."""
        columns = [table.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids")]
        held = [Held(d, s, n, np.frombuffer(ids, "<u4")) for d, s, n, ids in zip(*columns)]
        _in_order(held)
        first = (1 << 62) + (key[0].as_py() << 36)
        return pa.Table.from_batches([_rows(held, first, sequence, horizon)])

    texts = ids_and_texts(docs, id_col, text_col)
    pieces = land(texts.mapInArrow(packer, f"{PIECES}, ids BINARY"), "pieces")
    placed = pieces.where("ids IS NULL").drop("ids")
    over = pieces.where("ids IS NOT NULL").withColumn("tasks", F.expr(f"sequence_id div {together}"))
    return placed.unionByName(over.groupBy("tasks").applyInArrow(left_over, PIECES))
