"""A corpus made ready for training, in stages that are each written and read again.

Toxic documents go, one document stays of each group of near-duplicates, repeated
passages are cut out of what is left, sources are mixed to target weights, and the
chosen documents are packed into sequences. Every stage but the last gives rows with
the columns of ``documents``.

Nulls and odd rows are as each operator's docstring says. A document without an id can be
judged by its text, and is a copy of another like any; passages are not cut from it. Rows
that repeat an id and its text are one document after the second stage. A text that repeats a whole earlier one is empty after the third stage,
and has no words for the fourth to choose.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.llm import mixing, packing, simhash, suffix_dedup, toxicity
from ledgerfold.llm.common import fold, unpacked
from ledgerfold.llm.queries import table, tokenizer
from ledgerfold.session import land

#: A document goes if its toxicity is this or more.
TOXIC = 0.7

#: Four fifths of all words, by domain, language and source; no document comes twice.
MIX = mixing.Mix(
    domains={
        "web": (6, ("src0", "src1", "src2", "src3", "src4", "src5", "src6")),
        "reference": (3, ("src7", "src8", "src9", "src10", "src11", "src12")),
        "forum": (2, ("src13", "src14", "src15", "src16", "src17", "src18", "src19")),
    },
    languages={"en": 5, "de": 2, "fr": 2, "es": 1},
    share=(4, 5),
    max_epochs=1,
    split_ties=True,
)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar does not call toxic."""
    labels = table(spark, sf_dir, "labels")
    grammar = toxicity.train(docs, labels.where(fold(F.col("doc_id"), 3) != 1))
    kept = toxicity.score_rows(docs, grammar).where(F.col("score") < TOXIC)
    return kept.select(*unpacked(kept, docs))


def _without_repeated_rows(docs: DataFrame) -> DataFrame:
    """One row of each id and text; texts are only shuffled where rows repeat."""
    key = ["doc_id", "text_digest"]
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    keyed = docs.withColumn("text_digest", digest)
    counts = keyed.where("doc_id IS NOT NULL").groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    repeated = land(counts.where("n > 1").select(*key), "repeated_rows")
    once = keyed.join(repeated, key, "left_anti").select(*docs.columns)
    row = F.struct(*docs.columns)
    first = keyed.join(repeated, key).groupBy(*key).agg(F.min(row).alias("row"))
    return once.unionByName(first.select("row.*"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Documents without an id have a number each, above all ids, while groups are looked
    for, so one of a group stays only where none of it has an id. Of rows that repeat an
    id and its text one stays.
    """
    stand_in = F.monotonically_increasing_id() + (1 << 62)
    nameless = docs.where("doc_id IS NULL").withColumn("stand_in", stand_in)
    nameless = land(nameless, "nameless")
    named = docs.where("doc_id IS NOT NULL")
    texts = named.select("doc_id", "text").unionByName(
        nameless.select(F.col("stand_in").alias("doc_id"), "text")
    )
    found = simhash.near_duplicates(texts)
    gone = land(found.where("doc_id <> component_id").select("doc_id").distinct(), "copies")
    kept = _without_repeated_rows(named.join(gone, "doc_id", "left_anti"))
    alone = nameless.join(gone.withColumnRenamed("doc_id", "stand_in"), "stand_in", "left_anti")
    return kept.select(*docs.columns).unionByName(alone.select(*docs.columns))


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier ones have; ``n_chars`` follows."""
    cut = suffix_dedup.remove_repeats(docs)
    changed = F.col("n_removed") > 0
    columns = unpacked(cut, docs)
    rows = cut.select(*columns, changed.alias("passages_cut"))
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    n_chars = F.when(F.col("passages_cut"), length).otherwise(F.col("n_chars"))
    return rows.withColumn("n_chars", n_chars).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen to target weights."""
    return mixing.mixed_like(docs, MIX)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"), end_id=2)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("simhash", simhash_stage),
    ("suffix_dedup", suffix_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Toxicity, SimHash components and packing cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
