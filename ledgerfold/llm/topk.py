"""Exact top-k by inner product: best-first search in M-trees.

Vectors are whole numbers. Copies of a vector are one entry with the few smallest
ids it can be found by: with equal scores, no other id can come in. Entries are dealt
to the nearest of some pivots, a sample of the entries, and each cell becomes an M-tree
of pages, which are stored. A query is searched for in the cell nearest to it; what
that finds bounds its result, and the query goes on only to cells whose ball is
within that bound. Answers are merged.

Scale: cells are as many as keep them at ``CELL`` entries, up to ``MAX_CELLS``; what
every task is sent is a pivot and a radius of each (34 MB at the most with 64
coordinates). Beyond ``MAX_CELLS`` times ``CELL`` entries, cells grow. The queries are
a share of the rows; those of a cell meet its tree in blocks of ``QUERIES``, each in a
task of its own, so a cell that many ask for is no large task.

Numbers have 64 bits: a component that does not fit them raises, and so does a score
among the answers.

Edge cases: vectors that are null, empty, or hold a null, NaN or infinite component
take no part, nor do vectors with other than the most frequent number of components;
rows without an id take no part; a repeated id is one candidate per different vector
it comes with, and never its own answer; fewer candidates than ``k`` give fewer rows;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerfold.llm.mtree import Best, Page, build, room, search
from ledgerfold.session import importable, land

CELL = 8192
MAX_CELLS = 65_536

#: Queries that meet a cell's tree at once, about.
QUERIES = 4096

_PAGES = (
    "cell INT, page INT, leaf BOOLEAN, vectors BINARY, radius BINARY, to_parent BINARY, "
    "below BINARY, ids ARRAY<ARRAY<LONG>>, centre BINARY, reach DOUBLE"
)
_FOUND = "query LONG, vec_id LONG, score LONG"


def whole_vectors(
    embeddings: DataFrame,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id, vector`` of whole numbers, ``floor(scale * x)``, as little-endian bytes."""
    importable(embeddings.sparkSession)
    vector = embeddings[f"`{vector_col}`"].cast("array<double>").alias("vector")
    rows = embeddings.select(embeddings[f"`{id_col}`"].cast("long").alias("vec_id"), vector)
    usable = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == np.inf))
    rows = rows.where("vec_id IS NOT NULL AND vector IS NOT NULL").where(usable)
    common = (
        rows.groupBy(F.size("vector").alias("size"))
        .count()
        .where("size > 0")
        .orderBy(F.desc("count"), F.desc("size"))
        .first()
    )
    rows = rows.where(F.size("vector") == (common["size"] if common else 0))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            numbers = np.floor(values * scale)
            if (np.abs(numbers) >= 2.0**63).any():
                raise OverflowError("a component does not fit 64 bits")
            numbers = numbers.astype("<i8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([one.tobytes() for one in numbers], pa.binary())],
                names=["vec_id", "vector"],
            )

    return rows.mapInArrow(whole, "vec_id LONG, vector BINARY")


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), "<i8").reshape(len(vectors), -1).astype(np.float64)


def _cell_finder(pivots: np.ndarray, columns: int):
    """Adds the number of the nearest pivot; vectors are the first column."""
    norms = (pivots * pivots).sum(axis=1)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column(0).to_pylist())
            cell = np.concatenate(
                [
                    (norms - 2 * (values[at : at + 512] @ pivots.T)).argmin(axis=1)
                    for at in range(0, len(values), 512)
                ]
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int32()), *batch.columns],
                names=["cell", *batch.schema.names[:columns]],
            )

    return dealt


def _builder(longest: float):
    def pages(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("vector")
        ids = table.column("ids").to_pylist()
        found, centre, reach = build(_matrix(table.column("vector").to_pylist()), longest)
        rows = [
            {
                "cell": key[0].as_py(),
                "page": page.number,
                "leaf": page.leaf,
                "vectors": page.vectors.astype("<i8").tobytes(),
                "radius": page.radius.tobytes(),
                "to_parent": page.to_parent.tobytes(),
                "below": page.below.astype("<i8").tobytes(),
                "ids": [ids[i] for i in page.below] if page.leaf else [],
                "centre": table.column("vector")[centre].as_py() if not page.number else None,
                "reach": reach if not page.number else None,
            }
            for page in found
        ]
        schema = pa.schema(
            [
                ("cell", pa.int32()),
                ("page", pa.int32()),
                ("leaf", pa.bool_()),
                *[(name, pa.binary()) for name in ("vectors", "radius", "to_parent", "below")],
                ("ids", pa.list_(pa.list_(pa.int64()))),
                ("centre", pa.binary()),
                ("reach", pa.float64()),
            ]
        )
        return pa.Table.from_pylist(rows, schema)

    return pages


def _read_pages(table: pa.Table) -> tuple[dict[int, Page], list[list[int]]]:
    pages, ids = {}, []
    for row in table.drop_columns(["centre", "reach", "block"]).to_pylist():
        radius = np.frombuffer(row["radius"])
        vectors = np.frombuffer(row["vectors"], "<i8").reshape(len(radius), -1)
        below = np.frombuffer(row["below"], "<i8")
        if row["leaf"]:
            below = np.arange(len(ids), len(ids) + len(radius))
            ids += row["ids"]
        to_parent = np.frombuffer(row["to_parent"])
        pages[row["page"]] = Page(
            row["page"], row["leaf"], vectors.astype(np.float64), radius, to_parent, below
        )
    return pages, ids


def _searcher(longest: float, size: int):
    """Searches a cell's tree for its queries; ``floor`` is a score they have beaten."""

    def found(key: tuple, tree: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if tree.num_rows and queries.num_rows:
            pages, ids = _read_pages(tree)
            vectors = _matrix(queries.column("vector").to_pylist())
            asked = zip(queries.column("query").to_pylist(), queries.column("floor").to_pylist())
            for (query, floor), vector in zip(asked, vectors):
                best = Best(size, -np.inf if floor is None else floor)
                search(pages, vector, best, ids, longest)
                if any(abs(score) >= 2**63 for score, _ in best.found):
                    raise OverflowError("a score does not fit 64 bits")
                out += [(query, i, -score) for score, i in best.found]
        columns = list(zip(*out)) or [[], [], []]
        return pa.table(
            {
                name: pa.array(column, pa.int64())
                for name, column in zip(("query", "vec_id", "score"), columns)
            }
        )

    return found


def _other_cells(cells: list[tuple[int, np.ndarray, float]], longest: float):
    """For each query, the cells beside its own that its bound reaches."""
    numbers = np.array([c[0] for c in cells])
    centres = np.array([c[1] for c in cells])
    reach = np.array([c[2] for c in cells])

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(1).to_pylist())
            floor = batch.column(3).to_numpy(zero_copy_only=False).astype(np.float64)
            norm = (vectors * vectors).sum(axis=1)
            to_centre = norm[:, None] + longest - 2 * (vectors @ centres.T)
            lower = np.sqrt(np.maximum(to_centre, 0.0)) - reach
            bound = np.sqrt(np.maximum(norm + longest - 2 * floor, 0.0)) * (1 + 1e-9)
            bound += 2 * room(longest)
            bound[np.isnan(floor)] = np.inf
            own = batch.column(2).to_numpy()
            row, column = np.nonzero((lower <= bound[:, None]) & (numbers != own[:, None]))
            picked = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers[column], pa.int32()),
                    picked.column(0),
                    picked.column(1),
                    picked.column(3),
                ],
                names=["cell", "query", "vector", "floor"],
            )

    return reached


def _searched(index: DataFrame, asked: DataFrame, searcher) -> DataFrame:
    """Answers to ``asked`` (``cell, query, vector, floor``), a block of a cell's at a time."""
    sizes = asked.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    # One small row per cell, of which there are MAX_CELLS at most.
    blocks = F.broadcast(sizes.select("cell", F.expr(f"(n - 1) div {QUERIES} + 1").alias("blocks")))
    block = F.pmod(F.xxhash64("query"), F.col("blocks")).alias("block")
    dealt = asked.join(blocks, "cell").select("cell", block, "query", "vector", "floor")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    trees = index.join(blocks, "cell").select(*index.columns, each)
    return trees.groupBy("cell", "block").cogroup(dealt.groupBy("cell", "block")).applyInArrow(
        searcher, _FOUND
    )


def top_k(vectors: DataFrame, asked: Column, k: int = 5, cell: int = CELL) -> DataFrame:
    """``query_id, rank, vec_id, score``: the best ``k`` other rows for each asked one.

    ``vectors`` is as ``whole_vectors`` gives it; ``asked`` a condition on ``vec_id``.
    """
    spark = vectors.sparkSession
    rows = land(vectors, "vectors")
    first_ids = Window.partitionBy("vector").orderBy("vec_id")
    entries = (
        rows.distinct()
        .withColumn("place", F.row_number().over(first_ids))
        .where(F.col("place") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    entries = land(entries, "entries")
    n_cells = max(1, min(MAX_CELLS, -(-entries.count() // cell)))
    pivots = [r["vector"] for r in entries.orderBy(F.xxhash64("vector")).limit(n_cells).collect()]
    empty = spark.createDataFrame([], "query_id LONG, rank INT, vec_id LONG, score LONG")
    if not pivots:
        return empty
    longest = entries.mapInArrow(_longest, "longest DOUBLE").agg(F.max("longest")).first()[0]

    centres = _matrix(pivots)
    dealt = entries.mapInArrow(_cell_finder(centres, 2), "cell INT, vector BINARY, ids ARRAY<LONG>")
    index = land(dealt.groupBy("cell").applyInArrow(_builder(longest), _PAGES), "mtree_pages")
    roots = index.where("page = 0").select("cell", "centre", "reach").collect()
    cells = [(r["cell"], _matrix([r["centre"]])[0], r["reach"]) for r in roots]

    questions = rows.where(asked).groupBy("vector").agg(F.min("vec_id").alias("query"))
    near = questions.select("vector", "query").mapInArrow(
        _cell_finder(centres, 2), "cell INT, vector BINARY, query LONG"
    )
    near = land(near, "questions")
    searcher = _searcher(longest, k + 1)
    no_floor = F.lit(None).cast("long").alias("floor")
    first = near.select("cell", "query", "vector", no_floor)
    home = land(_searched(index, first, searcher), "answers")

    bounds = home.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    floor = F.when(F.col("n") > k, F.col("least")).alias("floor")
    bounded = near.join(bounds, "query", "left").select("query", "vector", "cell", floor)
    others = bounded.mapInArrow(
        _other_cells(cells, longest), "cell INT, query LONG, vector BINARY, floor LONG"
    )
    away = _searched(index, others, searcher)

    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    answers = (
        home.unionByName(away)
        .withColumn("place", F.row_number().over(ranked))
        .where(F.col("place") <= k + 1)
        .drop("place")
    )
    # Every asked row has the answers of its vector, without itself.
    asking = rows.where(asked).select(F.col("vec_id").alias("query_id"), "vector").distinct()
    keyed = asking.join(questions, "vector").select("query_id", "query")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        keyed.join(answers, "query")
        .where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(own).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = _matrix(batch.column(0).to_pylist())
        if len(values):
            longest = float((values * values).sum(axis=1).max())
            yield pa.RecordBatch.from_arrays([pa.array([longest])], names=["longest"])
