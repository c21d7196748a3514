"""Removing repeated passages: bytes that a document with a smaller id has as well.

A byte goes if it lies in a window of 50 bytes that also starts in a document with a
smaller id. Matches are found by suffix arrays (``suffixes``): each task keeps the
logarithmic family of them for a share of all suffixes.

1. Documents are spread over batches by id. A batch finds the suffixes that own its
   windows (one in 17 bytes or so) and sends the hash of each one's first bytes to the
   share it belongs to, five bytes apiece.
2. A share tells each batch, bit by bit, which of its hashes another batch has too.
3. A batch sends those suffixes, and the ones it has twice itself, with their
   surroundings. What several of its documents share, it sends once, for the smallest
   of them: the others are settled where they are.
4. A share adds batch after batch to its family, and sends back the windows found.
5. A batch takes the bytes out.

Scale: the texts are shuffled once and read by steps 1, 3 and 5 (the plan has one
exchange that is used three times). A passage that all documents share is one record
per batch, however many have it. Shares and batches are as many as twice
``spark.sql.shuffle.partitions``, so their size is that setting's choice; each holds
one batch or one share in memory. Exact: hashes only choose candidates, bytes decide.

Edge cases: null text is empty, and stays null in ``text``; texts shorter than a
window stay whole; documents without an id neither match nor are matched; repeated
rows have one id and so do not match each other; a character of which a byte is taken
out is taken out of ``text`` as a whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold.llm.common import as_bytes, binaries, packed
from ledgerfold.llm.suffixes import (
    RECORD,
    WINDOW,
    Family,
    Owners,
    Suffixes,
    alike,
    hashed,
    mixed,
    owners,
    records,
)

KEY_BITS = 40
PER_PARTITION = 2

_HASHES = "share INT, batch INT, hashes BINARY"
_SHARED = "batch INT, share INT, bits BINARY"
_SUFFIXES = (
    "share INT, batch INT, rows BINARY, documents BINARY, places BINARY, settled BINARY"
)
_WINDOWS = "batch INT, windows BINARY"
RESULT = (
    "n_bytes LONG, n_removed LONG, n_spans LONG, kept_sha256 STRING, "
    "spans ARRAY<STRUCT<start: LONG, end: LONG>>"
)


class _Batch:
    """A batch's documents in the order of id and text, and their owning suffixes."""

    def __init__(self, table: pa.Table) -> None:
        ids = table.column("doc_id").to_pylist()
        texts = [text or b"" for text in as_bytes(table.column("text").combine_chunks())]
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
        self.texts = [texts[i] for i in self.order]
        self.ids = np.array([ids[i] or 0 for i in self.order], np.int64)
        self._known = [ids[i] is not None for i in self.order]

    def suffixes(self) -> tuple[np.ndarray, np.ndarray, Owners]:
        """The texts that take part as one array, each byte's start of text, the suffixes."""
        scanned = [text if known else b"" for text, known in zip(self.texts, self._known)]
        self.data = np.frombuffer(b"".join(scanned), np.uint8)
        self.ends = np.cumsum([len(text) for text in scanned], dtype=np.int64)
        self.found = owners(self.data, self.ends)
        self.row = np.searchsorted(self.ends, self.found.start, side="right")
        return self.data, self.ends, self.found

    def keys(self, shares: int) -> np.ndarray:
        """Of each suffix, its share and below that the hash sent there.

        Mixed anew: a suffix owns windows by its hash being small.
        """
        gram = mixed(self.found.gram)
        share = ((gram >> np.uint64(40)) * np.uint64(shares)) >> np.uint64(24)
        return (share << np.uint64(KEY_BITS)) | (gram & np.uint64((1 << KEY_BITS) - 1))


def _share_of(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(KEY_BITS)).astype(np.int64)


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    return np.append(np.flatnonzero(np.diff(values, prepend=-1)), len(values))


def _number(key: tuple) -> int:
    return key[0].as_py()


def _hasher(shares: int):
    def hash_batch(key: tuple, table: pa.Table) -> pa.Table:
        batch = _Batch(table)
        batch.suffixes()
        keys = np.unique(batch.keys(shares))
        share = _share_of(keys)
        runs = _runs(share)
        five = np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :5])
        return pa.table(
            {
                "share": pa.array(share[runs[:-1]], pa.int32()),
                "batch": pa.array([_number(key)] * (len(runs) - 1), pa.int32()),
                "hashes": binaries(five, runs),
            }
        )

    return hash_batch


def _find_shared(key: tuple, table: pa.Table) -> pa.Table:
    """For each batch, one bit per hash it sent: whether another batch has it as well."""
    parts = [np.frombuffer(one, np.uint8) for one in table.column("hashes").to_pylist()]
    wide = np.zeros((sum(map(len, parts)) // 5, 8), np.uint8)
    wide[:, :5] = np.concatenate(parts).reshape(-1, 5)
    hashes = wide.view("<u8").reshape(-1)
    order = np.argsort(hashes)
    ordered = hashes[order]
    shared = np.zeros(len(hashes), bool)
    equal = ordered[1:] == ordered[:-1]
    shared[order[1:][equal]] = True
    shared[order[:-1][equal]] = True
    edges = np.cumsum([0, *[len(part) // 5 for part in parts]])
    batches = table.column("batch").to_pylist()
    replies = [
        (batch, np.packbits(shared[a:b]).tobytes())
        for batch, a, b in zip(batches, edges, edges[1:])
        if shared[a:b].any()
    ]
    return pa.table(
        {
            "batch": pa.array([batch for batch, _ in replies], pa.int32()),
            "share": pa.array([_number(key)] * len(replies), pa.int32()),
            "bits": pa.array([bits for _, bits in replies], pa.binary()),
        }
    )


def _sender(shares: int):
    def send(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _sent(_number(key), [])
        batch = _Batch(table)
        data, _, found = batch.suffixes()
        keys = batch.keys(shares)
        distinct, which, times = np.unique(keys, return_inverse=True, return_counts=True)
        wanted = times > 1
        share = _share_of(distinct)
        for number, bits in zip(
            replies.column("share").to_pylist(), replies.column("bits").to_pylist()
        ):
            a, b = np.searchsorted(share, [number, number + 1])
            wanted[a:b] |= np.unpackbits(np.frombuffer(bits, np.uint8))[: b - a].astype(bool)
        chosen = np.flatnonzero(wanted[which])
        share = _share_of(keys[chosen])
        chosen = chosen[np.argsort(share, kind="stable")]
        share = np.sort(share)
        edges = _runs(share)
        # Shares one after the other in groups of a bounded number of suffixes.
        pieces, a = [], 0
        while a < len(edges) - 1:
            b = int(np.searchsorted(edges, edges[a] + 50_000))
            b = min(max(b, a + 1), len(edges) - 1)
            part = chosen[edges[a] : edges[b]]
            pieces += _per_share(batch, data, found, part, share[edges[a] : edges[b]])
            a = b
        return _sent(_number(key), _settled_apart(pieces, _number(key) % shares))

    def _settled_apart(pieces: list[tuple], own: int) -> list[tuple]:
        """The windows settled here go with one row, to a share that only this batch picks
        for them: a passage that very many have is no burden on the share of its hash."""
        settled = b"".join(piece[4] for piece in pieces)
        rows = {piece[0]: (*piece[:4], b"") for piece in pieces}
        if settled:
            empty = (own, pa.compress(b"", "zstd", asbytes=True), b"", b"", b"")
            rows[own] = (*rows.get(own, empty)[:4], settled)
        return list(rows.values())

    return send


def _per_share(
    batch: _Batch, data: np.ndarray, found: Owners, chosen: np.ndarray, share: np.ndarray
) -> list[tuple]:
    """Records, their smallest documents, their places, and the windows settled here."""
    rows = records(data, found, chosen)
    row = batch.row[chosen]
    document = batch.ids[row]
    key = hashed(rows.view("<u8"))
    order = np.lexsort((document, key, share))
    same = alike(rows, key, order)
    begins = np.flatnonzero(~same)
    runs = np.append(begins, len(order))
    least = np.minimum.reduceat(document[order], begins)
    later = document[order] > np.repeat(least, np.diff(runs))
    begin_of_text = np.concatenate([[0], batch.ends[:-1]])
    window = found.window[chosen] - begin_of_text[row]
    if len(window) and window.max() >= 1 << 32:
        raise OverflowError("a text has 4 GB or more")
    place = np.stack([row, window], axis=1).astype("<u4")
    done = np.column_stack([place, found.count[chosen].astype("<u4")]).astype("<u4")[order[later]]
    record_share = share[order[begins]]
    n_places = np.add.reduceat((~later).astype(np.int64), begins)
    kept_places = place[order[~later]]
    done_share = share[order[later]]
    place_ends = np.cumsum(n_places)
    edges = _runs(record_share)
    pieces = []
    for a, b in zip(edges, edges[1:]):
        number = int(record_share[a])
        first = place_ends[a] - n_places[a]
        x, y = np.searchsorted(done_share, [number, number + 1])
        pieces.append(
            (
                number,
                pa.compress(rows[order[begins[a:b]]].tobytes(), "zstd", asbytes=True),
                np.column_stack([least[a:b], n_places[a:b]]).astype("<i8").tobytes(),
                kept_places[first : place_ends[b - 1]].tobytes(),
                done[x:y].tobytes(),
            )
        )
    return pieces


def _sent(batch: int, pieces: list[tuple]) -> pa.Table:
    columns = list(zip(*pieces)) or [[]] * 5
    return pa.table(
        {
            "share": pa.array(columns[0], pa.int32()),
            "batch": pa.array([batch] * len(pieces), pa.int32()),
            "rows": pa.array(columns[1], pa.binary()),
            "documents": pa.array(columns[2], pa.binary()),
            "places": pa.array(columns[3], pa.binary()),
            "settled": pa.array(columns[4], pa.binary()),
        }
    )


def _match(key: tuple, table: pa.Table) -> pa.Table:
    """All matches among the suffixes of a share, by batch."""
    table = table.sort_by("batch")
    family = Family()
    places, first_place, n_places, sender = [], [], [], []
    for number, rows, documents, place in zip(
        *(table.column(c).to_pylist() for c in ("batch", "rows", "documents", "places"))
    ):
        if not documents:
            continue
        document, times = np.frombuffer(documents, "<i8").reshape(-1, 2).T
        size = len(document) * RECORD
        raw = pa.decompress(rows, size, "zstd", asbytes=True)
        base = sum(map(len, n_places))
        tags = base + np.arange(len(document))
        family.add(Suffixes(np.frombuffer(raw, np.uint8).reshape(-1, RECORD), document, tags))
        before = sum(map(len, places))
        places.append(np.frombuffer(place, "<u4").reshape(-1, 2))
        first_place.append(before + np.cumsum(times) - times)
        n_places.append(times)
        sender.append(np.full(len(document), number))
    if not sender:
        return _with_settled(table, [], [])
    tag, window, count = family.matches().T
    sender, first_place = np.concatenate(sender), np.concatenate(first_place)
    n_places, places = np.concatenate(n_places), np.concatenate(places)
    times = n_places[tag]
    at = np.repeat(first_place[tag] - np.cumsum(times) + times, times) + np.arange(times.sum())
    row, begin = places[at].T.astype(np.int64)
    out = np.column_stack([row, begin + np.repeat(window, times), np.repeat(count, times)])
    batch = np.repeat(sender[tag], times)
    order = np.argsort(batch, kind="stable")
    runs = _runs(batch[order])
    numbers = batch[order][runs[:-1]].tolist()
    found = binaries(out[order].astype("<u4"), runs).to_pylist()
    return _with_settled(table, numbers, found)


def _with_settled(table: pa.Table, numbers: list[int], found: list[bytes]) -> pa.Table:
    """Windows by batch, and those that batches had settled themselves."""
    for number, settled in zip(*(table.column(c).to_pylist() for c in ("batch", "settled"))):
        if settled:
            numbers.append(number)
            found.append(settled)
    return pa.table(
        {"batch": pa.array(numbers, pa.int32()), "windows": pa.array(found, pa.binary())}
    )


def _spans(row: np.ndarray, window: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Maximal runs ``(row, start, end)`` of bytes in the given windows."""
    if not len(row):
        return np.zeros((0, 3), np.int64)
    order = np.lexsort((window, row))
    row, start = row[order], window[order]
    end = start + count[order] + WINDOW - 1
    if row.max() >= 1 << 22:
        raise OverflowError("a batch has over four million documents: use more partitions")
    # Ends so far within a row; rows are set apart by adding what no text reaches.
    apart = row * (1 << 40)
    reached = np.maximum.accumulate(end + apart)
    new = np.ones(len(row), bool)
    new[1:] = (start + apart)[1:] > reached[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    return np.column_stack([row[first], start[first], reached[last] - apart[last]])


def _remover(keep_text: bool):
    def remove(key: tuple, table: pa.Table, windows: pa.Table) -> pa.Table:
        batch = _Batch(table)
        found = b"".join(windows.column("windows").to_pylist())
        spans = _spans(*np.frombuffer(found, "<u4").reshape(-1, 3).T.astype(np.int64))
        edges = np.searchsorted(spans[:, 0], np.arange(len(batch.texts) + 1))
        n_removed, hashes, kept_texts, removed = [], [], [], []
        for text, a, b in zip(batch.texts, edges, edges[1:]):
            kept, at = [], 0
            for start, end in spans[a:b, 1:].tolist():
                kept.append(text[at:start])
                at = end
            kept = b"".join([*kept, text[at:]])
            n_removed.append(len(text) - len(kept))
            hashes.append(hashlib.sha256(kept).hexdigest())
            removed.append([{"start": s, "end": e} for s, e in spans[a:b, 1:].tolist()])
            kept_texts.append(kept.decode("utf-8", "ignore") if keep_text else None)
        table = table.take(pa.array(batch.order, pa.int64()))
        sizes = [len(text) for text in batch.texts]
        span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        columns = {"doc_id": table.column("doc_id")}
        if keep_text:
            null = table.column("text").is_null()
            kept_array = pa.chunked_array([pa.array(kept_texts, pa.string())])
            columns["text"] = pa.compute.if_else(null, pa.scalar(None, pa.string()), kept_array)
            columns["rest"] = table.column("rest")
        columns |= {
            "n_bytes": pa.array(sizes, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "n_spans": pa.array(np.diff(edges), pa.int64()),
            "kept_sha256": pa.array(hashes, pa.string()),
            "spans": pa.array(removed, span_type),
        }
        return pa.table(columns)

    return remove


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True
) -> DataFrame:
    """Every document with what was removed: ``doc_id``, the columns of ``RESULT``, and
    with ``keep_text`` also the ``text`` that is left and ``rest``, the other columns."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = PER_PARTITION * partitions
    rows = packed(docs, id_col, text_col)
    if not keep_text:
        rows = rows.drop("rest")
    # Rows of one id are one batch's; those without an id go anywhere, but not all to one.
    by_id = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id"))
    batch = F.pmod(F.coalesce(by_id, F.xxhash64("text")), F.lit(number)).cast("int")
    # The one exchange of the texts; all steps below read what it has written.
    spread = rows.withColumn("batch", batch).repartition(partitions, "batch")

    hashes = spread.groupBy("batch").applyInArrow(_hasher(number), _HASHES)
    shared = hashes.groupBy("share").applyInArrow(_find_shared, _SHARED)
    sent = (
        spread.groupBy("batch")
        .cogroup(shared.groupBy("batch"))
        .applyInArrow(_sender(number), _SUFFIXES)
    )
    windows = sent.groupBy("share").applyInArrow(_match, _WINDOWS)
    kept = [f for f in rows.schema if keep_text or f.name != "text"]
    result = T.StructType([*kept, *T.StructType.fromDDL(RESULT)])
    return (
        spread.groupBy("batch")
        .cogroup(windows.groupBy("batch"))
        .applyInArrow(_remover(keep_text), result)
    )
