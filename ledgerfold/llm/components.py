"""Connected components of links between documents, labelled by the smallest id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.session import land


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node that ``links`` (``a long, b long``) names.

    Large-star and small-star rounds: each node's larger neighbours are tied to the
    smallest node it knows, then its smaller ones, until every node is tied to its
    component's smallest one. Rounds grow with the logarithm of the longest chain. A
    round is two shuffles of links, aggregated before the shuffle; each round's links
    are written, which cuts the lineage and survives lost executors.
    """
    ordered = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links = land(ordered.distinct(), "links")
    before = None
    while True:
        links = land(_small_star(_large_star(links)), "links")
        now = links.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == before or not now["n"]:
            break
        before = now
    centres = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        centres
    )


def _smallest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Ties each larger neighbour of a node to the smallest of the node and its neighbours."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    larger = both.where("v > u").join(_smallest(both), "u")
    return larger.select(F.col("v").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the smallest of them."""
    down = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    tied = down.join(_smallest(down), "u")
    moved = tied.where("v <> least").select(F.col("v").alias("a"), F.col("least").alias("b"))
    own = tied.select(F.col("u").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(own).distinct()
