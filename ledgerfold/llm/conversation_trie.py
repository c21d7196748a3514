"""Conversations as a tree of their openings, and what sharing the openings saves.

A node is a sequence of first turns; its members are the conversations that open with
it. A node is known by its depth and the exclusive or of its turns' 64-bit hashes, two
for each place and turn, so that the openings of a conversation are running sums. Totals
over subtrees are rolled up by depth bands of ``BAND`` levels: a node adds its share
to its ancestors within its band only; then, from the deepest band upwards, the
completed totals of a band's roots are added to the ancestors in the band above. A node
is written at most ``BAND`` times, and there are as many rounds as bands.

How it scales. Texts are replaced by digest and word count where they are read. Turns
are put in order by ranges of (conversation, turn), so one conversation may lie in many
tasks; what a task numbers is shifted by the rows of the tasks before it, one row for
each task that begins within a conversation. Openings are summed within blocks of
``BLOCK`` turns, then over the blocks. Nodes are aggregated before the shuffle, so an
opening that many share is one row per task. A parent with very many children is met
through ``common.look_up``. The ids that end in a node are sorted by ranges and written
out in pieces by many tasks; only the hash itself runs over a node's pieces in order,
with a fixed amount of memory. Every round's rows are stored.

Rows. Turns come by ``turn``, nulls first; of one turn, by role and then by the digest of
role and text, so repeated rows are turns of their own. A null role or text is empty.
Rows without a conversation id take no part. Texts of any length are hashed whole. Other
columns are not read, whatever their names. An empty table gives no rows, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerfold.llm.common import WORD, look_up
from ledgerfold.session import importable, land

#: Levels of a band.
BAND = 32

#: Turns of a conversation that are summed together; a multiple of ``BAND``.
BLOCK = 1024

#: Ids in one piece of a node's list.
PIECE = 400

NODE = ["depth", "k1", "k2"]


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with the task's number and their rank among its rows of a conversation."""
    task = TaskContext.get().partitionId()
    last, n = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column(0).to_numpy()
        starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
        lengths = np.diff(np.r_[starts, len(conv)])
        rank = np.arange(len(conv)) - np.repeat(starts, lengths) + 1
        if conv[0] == last:
            rank[: lengths[0]] += n
        last, n = conv[-1], int(rank[-1])
        numbers = [pa.array(np.full(len(conv), task, np.int32)), pa.array(rank)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *numbers, batch.column(1), batch.column(2)],
            names=["conv", "task", "rank", "item", "words"],
        )


def ordered_turns(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """``conv, k, item, words``, turn ``k`` (from 1) of each conversation with the digest
    and word count of its text; and ``conv, n_turns``."""
    importable(conversations.sparkSession)

    def named(column: str) -> Column:
        return conversations[f"`{column}`"]

    role, text = (F.coalesce(named(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.select(
        named(conv_col).cast("long").alias("conv"),
        F.md5(content.cast("binary")).alias("item"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        named(turn_col).alias("turn"),
        role.alias("role"),
        # Rows that are the same in all else are told apart, or they could fill one range.
        F.monotonically_increasing_id().alias("row"),
    ).where("conv IS NOT NULL")
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "item", "row"]
    in_order = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    turns = in_order.select("conv", "item", "words").mapInArrow(
        _numbered, "conv LONG, task INT, rank LONG, item STRING, words LONG"
    )
    turns = land(turns, "turns")

    spans = land(turns.groupBy("conv", "task").agg(F.count(F.lit(1)).alias("n")), "spans")
    earlier = Window.partitionBy("conv").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task at most: the others begin with a conversation's first turn.
    shifts = spans.withColumn("shift", F.sum("n").over(earlier)).where("shift > 0").drop("n")
    placed = turns.join(F.broadcast(shifts), ["conv", "task"], "left")
    k = (F.col("rank") + F.coalesce("shift", F.lit(0))).alias("k")
    sizes = spans.groupBy("conv").agg(F.sum("n").alias("n_turns"))
    return placed.select("conv", k, "item", "words"), sizes


def grafted(turns: DataFrame, sizes: DataFrame, every: int, most: int) -> DataFrame:
    """``conv, depth, item, words, is_end``: each conversation c with its first h turns, h
    below ``most`` by the CRC-32 of c, replaced by those of conversation c - c % every.

    Every conversation has a row of depth 0 as well, the opening without turns.
    """
    heads = turns.where((F.col("conv") % every == 0) & (F.col("k") < most))
    head = F.struct("k", "item", "words")
    heads = heads.groupBy(F.col("conv").alias("base")).agg(
        F.array_sort(F.collect_list(head)).alias("heads")
    )
    own = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = sizes.withColumns({"base": F.col("conv") - F.col("conv") % every, "h": own})
    taken = F.slice(F.coalesce("heads", F.array().cast("array<struct<k:long,item:string,words:long>>")), 1, F.col("h"))
    convs = convs.join(heads, "base", "left").withColumn("heads", taken)
    length = F.size("heads") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))
    shift = F.col("h") - F.size("heads")
    convs = convs.select("conv", "n_turns", "h", "heads", shift.alias("shift"), length.alias("length"))
    convs = land(convs, "grafts")

    # A conversation is met block by block, so a very long one is no single key.
    blocks = F.sequence(F.lit(0).cast("long"), F.expr(f"n_turns div {BLOCK}"))
    by_block = convs.select("conv", "h", "shift", "length", F.explode(blocks).alias("block"))
    kept = turns.withColumn("block", F.expr(f"k div {BLOCK}")).join(by_block, ["conv", "block"])
    depth = F.col("k") - F.col("shift")
    kept = kept.where("k > h").select("conv", depth.alias("depth"), "item", "words", "length")
    grafts = convs.select("conv", "length", F.inline("heads")).withColumnRenamed("k", "depth")
    roots = convs.select(
        "conv",
        F.lit(0).cast("long").alias("depth"),
        F.lit("").alias("item"),
        F.lit(0).cast("long").alias("words"),
        "length",
    )
    rows = kept.unionByName(grafts).unionByName(roots)
    return rows.withColumn("is_end", F.col("depth") == F.col("length")).drop("length")


def _keyed(sequences: DataFrame, band: int, block: int) -> DataFrame:
    """Each opening of each conversation: its key, its parent's, and ``path``, the keys of
    its ancestors within its band and its own."""

    def hashed(seed: int) -> Column:
        return F.when(F.col("depth") > 0, F.xxhash64(F.lit(seed), "depth", "item")).otherwise(0)

    rows = sequences.withColumns(
        {"x1": hashed(1), "x2": hashed(2), "block": F.expr(f"depth div {block}")}
    )
    rows = land(rows.drop("item"), "openings")
    within = Window.partitionBy("conv", "block").orderBy("depth")
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    recent = within.rowsBetween(1 - band, 0)
    summed = rows.withColumns({"y1": F.bit_xor("x1").over(upto), "y2": F.bit_xor("x2").over(upto)})
    summed = summed.withColumns(
        {
            "p1": F.lag("y1").over(within),
            "p2": F.lag("y2").over(within),
            "path": F.collect_list(F.struct(F.col("y1").alias("k1"), F.col("y2").alias("k2"))).over(recent),
        }
    )
    # Of the conversations that go on beyond a block: what comes before each later block.
    deep = rows.where(F.col("depth") >= block).select("conv").distinct()
    totals = rows.join(deep, "conv", "left_semi").groupBy("conv", "block").agg(
        F.bit_xor("x1").alias("t1"), F.bit_xor("x2").alias("t2")
    )
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "conv", "block", F.bit_xor("t1").over(earlier).alias("s1"), F.bit_xor("t2").over(earlier).alias("s2")
    ).where("block > 0")
    placed = summed.join(starts, ["conv", "block"], "left")

    def whole(number: int, value: Column) -> Column:
        start = F.coalesce(F.col(f"s{number}"), F.lit(0).cast("long"))
        return F.coalesce(value, F.lit(0).cast("long")).bitwiseXOR(start)

    in_band = (F.col("depth") % band + 1).cast("int")
    path = F.transform(
        F.slice("path", -in_band, in_band),
        lambda p: F.struct(whole(1, p["k1"]).alias("k1"), whole(2, p["k2"]).alias("k2")),
    )
    return placed.select(
        "conv",
        "depth",
        whole(1, F.col("y1")).alias("k1"),
        whole(2, F.col("y2")).alias("k2"),
        whole(1, F.col("p1")).alias("p1"),
        whole(2, F.col("p2")).alias("p2"),
        path.alias("path"),
        "words",
        "is_end",
    )


def _to_ancestors(rows: DataFrame, values: list[str]) -> DataFrame:
    """``values`` of nodes summed over the nodes that have them in their subtree and band."""
    each = rows.select("depth", F.size("path").alias("n"), F.posexplode("path"), *values)
    depth = (F.col("depth") - F.col("n") + 1 + F.col("pos")).alias("depth")
    sent = each.select(depth, F.col("col.k1").alias("k1"), F.col("col.k2").alias("k2"), *values)
    return sent.groupBy(*NODE).agg(*[F.sum(v).alias(v) for v in values])


def rolled_up(nodes: DataFrame, values: list[str], band: int = BAND) -> list[DataFrame]:
    """Frames of node and ``values`` whose sums by node are the totals over its subtree.

    ``nodes`` have ``depth, k1, k2``, the parent's key ``p1, p2``, and ``path``.
    """
    parts = [land(_to_ancestors(nodes, values), "in_bands")]
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    if deepest < band:
        return parts
    # What the rounds look at: a band's roots, and the last level above them, by depth.
    edges = nodes.where((F.col("depth") % band).isin(0, band - 1))
    edges = land(edges.select(*NODE, "p1", "p2", "path").repartitionByRange("depth", "k1"), "band_edges")
    root_totals = parts[0].where(F.col("depth") % band == 0).repartitionByRange("depth", "k1")
    root_totals = land(root_totals, "band_roots")
    below = None
    for depth in range(deepest - deepest % band, 0, -band):
        complete = root_totals.where(F.col("depth") == depth)
        if below is not None:
            complete = complete.unionByName(below.where(F.col("depth") == depth))
        sums = complete.groupBy(*NODE).agg(*[F.sum(v).alias(v) for v in values])
        roots = edges.where(F.col("depth") == depth).select(*NODE, "p1", "p2")
        of_parents = roots.join(sums, NODE).groupBy("p1", "p2")
        of_parents = of_parents.agg(*[F.sum(v).alias(v) for v in values])
        parents = edges.where(F.col("depth") == depth - 1).drop("p1", "p2")
        parents = parents.withColumnsRenamed({"k1": "p1", "k2": "p2"}).join(of_parents, ["p1", "p2"])
        below = land(_to_ancestors(parents, values), "band_totals")
        parts.append(below)
    return parts


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of nodes as comma-joined text, some at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        depth, k1, k2, conv = (column.to_numpy() for column in batch.columns)
        new = (depth[1:] != depth[:-1]) | (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
        starts = np.flatnonzero(np.r_[True, new])
        ends = np.r_[starts[1:], len(conv)]
        cuts = np.concatenate([np.arange(a, b, PIECE) for a, b in zip(starts, ends)])
        stops = np.r_[cuts[1:], len(conv)]
        texts = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(cuts, stops)]
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(c[cuts]) for c in (depth, k1, k2, conv)], pa.array(texts)],
            names=[*NODE, "first", "ids"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which come in order."""

    def rows(done: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = [pa.array(c, kind) for c, kind in zip(zip(*done), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=[*NODE, "ends"])

    key, sha = None, None
    for batch in batches:
        done = []
        for *node, _, ids in zip(*[column.to_pylist() for column in batch.columns]):
            if node == key:
                sha.update(b"," + ids.encode())
                continue
            if key is not None:
                done.append((*key, sha.hexdigest()))
            key, sha = node, hashlib.sha256(ids.encode())
        if done:
            yield rows(done)
    if key is not None:
        yield rows([(*key, sha.hexdigest())])


def _ends(keyed: DataFrame) -> DataFrame:
    """``depth, k1, k2, ends``: the digest of the ids of the conversations that end in a node."""
    order = ["k1", "k2", "depth", "conv"]
    ending = keyed.where("is_end").select(*NODE, "conv")
    pieces = (
        ending.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_pieces, "depth LONG, k1 LONG, k2 LONG, first LONG, ids STRING")
    )
    together = pieces.repartition(*NODE).sortWithinPartitions("k1", "k2", "depth", "first")
    return together.mapInArrow(_digests, "depth LONG, k1 LONG, k2 LONG, ends STRING")


def prefix_trie(sequences: DataFrame, band: int = BAND, block: int = BLOCK) -> DataFrame:
    """Every node of the tree of ``sequences`` (as ``grafted`` gives them): ``conv_id`` (the
    smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    if block % band:
        raise ValueError("a block holds whole bands")
    keyed = _keyed(sequences, band, block)
    members = [
        F.min("conv").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.count_if("is_end").alias("n_ends"),
        F.any_value(F.struct("p1", "p2", "path", "words")).alias("own"),
    ]
    nodes = keyed.groupBy(*NODE).agg(*members)
    nodes = nodes.select(
        *NODE,
        "conv_id",
        "n_convs",
        "own.p1",
        "own.p2",
        "own.path",
        # A member that goes on is in a child; a node without children has only ends.
        (F.col("n_ends") == F.col("n_convs")).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("own.words")).alias("saved_tokens"),
    )
    nodes = land(nodes, "nodes")
    totals = rolled_up(nodes, ["n_leaves", "saved_tokens"], band)
    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")
    )
    parts = [
        nodes.select(*NODE, "conv_id", "n_convs", "p1", "p2"),
        children.agg(F.count(F.lit(1)).alias("n_children")),
        *totals,
        _ends(keyed),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    sums = ["n_children", "n_leaves", "saved_tokens"]
    ones = ["conv_id", "n_convs", "p1", "p2", "ends"]
    whole = rows.groupBy(*NODE).agg(
        *[F.max(c).alias(c) for c in ones],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
    )
    whole = land(whole, "trie")
    parents = whole.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"),
        F.col("k1").alias("p1"),
        F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
        F.col("n_children").alias("asked"),
    )
    found = look_up(whole.where("depth > 0"), parents, ["depth", "p1", "p2"], "asked")
    root = whole.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    nothing = hashlib.sha256(b"").hexdigest()
    return found.unionByName(root).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        *sums,
        F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"),
    )
