"""SimHash near-duplicates: pigeonhole blocks, and exact distances within them.

A fingerprint's bit is 1 if more than half of the XXH64 values of a text's shingles
have it. Fingerprints are linked at ``max_bits`` or fewer differing bits. The 64 bits
are cut into blocks; ``max_bits`` differing bits leave all but ``max_bits`` of them
untouched, so any two linked fingerprints agree on that many blocks. Each
fingerprint is sent to every choice of so many blocks, and compared with those that
have the same bits there. No link is lost, and nothing is a guess.

Scale: only distinct fingerprints take part, with the smallest id that has each, so a
group of copies is one fingerprint. A task compares what shares a block pair in
memory, as numbers, and hands on a spanning forest instead of all pairs: at most one
link per fingerprint and key. A key that more than ``GROUP`` fingerprints share is
cut into tiles, and every pair of tiles is compared by itself, so that no key is the
work of one task. The more fingerprints there are, the more blocks they are cut into
(``n_blocks``): for 4 bits distance, 15 keys of 21 bits, then 35 of 27, then 70 of 32. So
a key is shared by chance by about ``GROUP`` fingerprints at the most, up to 1e12 of
them; comparing stays quadratic only in what is truly alike.

Edge cases: texts with fewer words than a shingle have one shingle, the whole
sequence; texts without words (null, empty, blank) have fingerprint zero and are
linked like any other; long texts are hashed whole, with 8 bytes a shingle; repeated rows are separate rows of one component; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import as_bytes, ids_and_texts, slices
from ledgerfold.llm.components import components
from ledgerfold.session import land

SHINGLE = 4
MAX_BITS = 4
SEED = 42

#: Fingerprints of one key that are compared in one go.
GROUP = 256

_UPPER = bytes(range(65, 91))
_LOWERED = bytes.maketrans(_UPPER, _UPPER.lower())


def shingles(text: bytes, size: int = SHINGLE) -> list[bytes]:
    """Word shingles of a text with A-Z in lower case, repeats included."""
    words = text.translate(_LOWERED).split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    starts = np.cumsum([0, *[len(word) + 1 for word in words]]).tolist()
    return [joined[a : b - 1] for a, b in zip(starts, starts[size:])]


def fingerprint(text: bytes | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint, unsigned."""
    from xxhash import xxh64_intdigest

    found = shingles(text or b"", size)
    if not found:
        return 0
    hashes = np.array([xxh64_intdigest(one, seed) for one in found], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64) * 2 > len(found)
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, fp`` of every document, ``fp`` the fingerprint's bits as a signed long."""

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [fingerprint(text, size, seed) for text in as_bytes(batch.column(1))]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(signed)], names=["doc_id", "fp"]
            )

    return ids_and_texts(docs, id_col, text_col).mapInArrow(taken, "doc_id LONG, fp LONG")


def n_blocks(n: int, max_bits: int, group: int = GROUP) -> int:
    """Blocks to cut ``n`` fingerprints into: the fewest, and so the fewest keys, by which
    no more than ``group`` of ``n`` random fingerprints share a key."""
    number = max_bits + 2
    while n >> (64 * (number - max_bits) // number) > group and number < 2 * max_bits:
        number += 1
    return number


def blocks(max_bits: int, number: int | None = None) -> list[int]:
    """Bit masks of so many blocks, ``max_bits + 2`` if not said."""
    number = number or max_bits + 2
    edges = [round(64 * i / number) for i in range(number + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _keys(fp: Column, max_bits: int, number: int) -> Column:
    """Every choice of all but ``max_bits`` blocks, with the bits the fingerprint has there."""
    choices = combinations(blocks(max_bits, number), number - max_bits)
    return F.array(
        *[
            F.struct(
                F.lit(place).alias("pair"),
                fp.bitwiseAND(F.lit(_signed(sum(chosen))).cast("long")).alias("bits"),
            )
            for place, chosen in enumerate(choices)
        ]
    )


def forest(ids: np.ndarray, fps: np.ndarray, max_bits: int, apart: int = 0) -> list[tuple]:
    """Links that connect what is within ``max_bits``, fewer than there are fingerprints.

    With ``apart``, the first ``apart`` fingerprints are compared with the others only.
    """
    if len(ids) == 2:
        near = (int(fps[0]) ^ int(fps[1])).bit_count() <= max_bits
        return [(int(ids[0]), int(ids[1]))] if near else []
    label = np.arange(len(ids))
    links = []
    for i in range(apart or 1, len(ids)):
        near = np.flatnonzero(np.bitwise_count(fps[: apart or i] ^ fps[i]) <= max_bits)
        # One link to each component that is near and not yet the own one.
        for other in set(label[near].tolist()) - {int(label[i])}:
            j = near[label[near] == other][0]
            links.append((int(ids[i]), int(ids[j])))
            label[label == other] = label[i]
    return links


def _compared(max_bits: int):
    """Compares the members of each key; rows come sorted by key."""

    def links_of(key: tuple, rows: list[tuple]) -> list[tuple]:
        rows = sorted(set(rows))
        tile = np.array([r[2] for r in rows])
        ids = np.array([r[0] for r in rows], np.int64)
        fps = np.array([r[1] for r in rows], np.int64).view(np.uint64)
        left, right = key[2], key[3]
        if left == right:
            return forest(ids, fps, max_bits)
        order = np.argsort(tile != left, kind="stable")
        return forest(ids[order], fps[order], max_bits, apart=int((tile == left).sum()))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, links = None, [], []
        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            for pair, bits, left, right, node, fp, tile in zip(*columns):
                if (pair, bits, left, right) != key:
                    if len(rows) > 1:
                        links += links_of(key, rows)
                    key, rows = (pair, bits, left, right), []
                rows.append((node, fp, tile))
            if links:
                yield _links(links)
                links = []
        if len(rows) > 1:
            links += links_of(key, rows)
        if links:
            yield _links(links)

    return compared


def _links(links: list[tuple]) -> pa.RecordBatch:
    a, b = zip(*links)
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
    )


def near_links(
    classes: DataFrame, max_bits: int = MAX_BITS, group: int = GROUP, number: int | None = None
) -> DataFrame:
    """Links ``a, b`` that connect all ``classes`` (``node, fp``) within ``max_bits``; in
    ``number`` blocks, or as many as their count asks for."""
    number = number or n_blocks(classes.count(), max_bits, group)
    keyed = classes.select("node", "fp", F.inline(_keys(F.col("fp"), max_bits, number)))
    shared = (
        keyed.groupBy("pair", "bits")
        .agg(F.count(F.lit(1)).alias("members"))
        .where("members > 1")
        .withColumn("tiles", F.ceil(F.col("members") / group).cast("int"))
    )
    member = keyed.join(shared, ["pair", "bits"])
    tile = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    numbers = F.sequence(F.lit(0), F.col("tiles") - 1)
    tiled = member.withColumn("tile", tile).select(
        "pair", "bits", "node", "fp", "tile", F.explode(numbers).alias("other")
    )
    placed = tiled.select(
        "pair",
        "bits",
        F.least("tile", "other").alias("lower"),
        F.greatest("tile", "other").alias("upper"),
        "node",
        "fp",
        "tile",
    )
    key = ["pair", "bits", "lower", "upper"]
    together = placed.repartition(*key).sortWithinPartitions(*key)
    return together.mapInArrow(_compared(max_bits), "a LONG, b LONG").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    max_bits: int = MAX_BITS,
    seed: int = SEED,
    group: int = GROUP,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document.

    ``component_id`` is the smallest id that links lead to, its own included.
    """
    taken = land(fingerprints(docs, id_col, text_col, size, seed), "fingerprints")
    classes = land(taken.groupBy("fp").agg(F.min("doc_id").alias("node")), "classes")
    found = components(near_links(classes.where("node IS NOT NULL"), max_bits, group))
    labelled = classes.join(found, "node", "left").select(
        "fp", F.coalesce("component", "node").alias("component_id")
    )
    hexadecimal = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return taken.join(labelled, "fp").select("doc_id", hexadecimal, "component_id")
