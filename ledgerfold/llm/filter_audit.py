"""How filters on texts work together, in every order they could be applied in.

A document's mask has a bit per filter that it fails. All but one filter look at the
text alone; the last one fails a document whose text an earlier one (by id) has too. The
files of a table are read as a stream, in micro-batches until none is left. A text is a
key, and its state is the smallest id seen so far, with the rows that have it. Every
document is counted in its part as a copy; the rows of the smallest id are counted back
as none, and when a smaller one comes in a later batch, the earlier ones' counts are
retracted. Called again with the same ``store``, only files that have come since are read.

States and counters are tables in the shared folder, to which a batch adds what it has
changed, under its number: a batch that is run again replaces its own and reads those
before it only. (Spark's own state store, by ``applyInPandasWithState``, gave the same
results at five times the CPU time, most of it the call per text.)

How it scales. Texts stay in the task that reads them: a digest, the mask and the part go
on, and labels join these. The smallest id of a text is combined before the shuffle, so
a text that a third of all documents share is one row per task; what is joined by id has
no hot key. The state is one small row per text; a batch reads the states once and
changes those of its own texts. From the counters' sums per set of filters all orders
follow, part by part, without reading documents again. ``rounds`` says into how many
batches the files are divided; each reads labels and states once.

Rows. A null text is empty and a null part is the empty one. Rows without an id are
counted, are no one's copy, and make no one a copy; rows that repeat the smallest id of
a text are none either. Ids in ``labels`` may repeat: a document has a label if any row
says so. Long texts are taken whole. Other columns are not read, whatever their names.
A table without rows gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.llm.common import WORD
from ledgerfold.session import fresh_path, land

#: Whether a text fails: of the text and its words, in order.
Filter = Callable[[Column, Column], Column]

#: What a document is counted by.
KIND = ["part", "mask", "good", "toxic"]

COUNTERS = "part STRING, mask INT, good INT, toxic INT, n LONG"

#: The rows that made ``doc_id`` the smallest of a text, or were added to it.
STATE = f"digest BINARY, doc_id LONG, {COUNTERS}"


def labelled(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, good, toxic``: one row per document that has one of the labels."""
    good = F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good")
    toxic = F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    rows = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), "quality", "toxic")
    return rows.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id").agg(good, toxic)


def masked(
    docs: DataFrame, filters: Mapping[str, Filter], id_col: str, text_col: str, part_col: str
) -> DataFrame:
    """``doc_id, part, digest, mask`` of each document, by the filters on its text."""
    rows = docs.select(
        docs[f"`{id_col}`"].cast("long").alias("doc_id"),
        F.coalesce(docs[f"`{part_col}`"].cast("string"), F.lit("")).alias("part"),
        F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("text"),
    ).withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    mask = F.lit(0)
    for bit, fails in enumerate(filters.values()):
        mask = mask + F.when(fails(F.col("text"), F.col("words")), 1 << bit).otherwise(0)
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    return rows.select("doc_id", "part", digest.alias("digest"), mask.alias("mask"))


def _count(spark: SparkSession, rows: DataFrame, number: int, copy_bit: int, store: str) -> None:
    """Takes a batch's ``rows`` into the states and the counters of ``store``."""
    as_copy = F.when(F.col("doc_id").isNotNull(), F.col("mask").bitwiseOR(copy_bit))
    counted = rows.withColumn("mask", F.coalesce(as_copy, "mask"))
    counted = counted.groupBy(*KIND).agg(F.count(F.lit(1)).alias("n"))

    states = spark.read.schema(f"{STATE}, batch LONG").parquet(f"{store}/states")
    states = states.where(F.col("batch") < number).drop("batch")
    smallest = F.min("doc_id").alias("new_id")
    found = rows.where("doc_id IS NOT NULL").groupBy("digest").agg(smallest)
    before = states.groupBy("digest").agg(F.min("doc_id").alias("old_id"))
    firsts = found.join(before, "digest", "left").where("old_id IS NULL OR new_id <= old_id")
    firsts = land(firsts, "firsts")

    new = rows.join(firsts.select("digest", F.col("new_id").alias("doc_id")), ["digest", "doc_id"])
    new = new.groupBy("digest", "doc_id", *KIND).agg(F.count(F.lit(1)).alias("n"))
    new.select("digest", "doc_id", *KIND, "n").write.mode("overwrite").parquet(
        f"{store}/states/batch={number}"
    )
    new = spark.read.schema(STATE).parquet(f"{store}/states/batch={number}")
    beaten = firsts.where("new_id < old_id").select("digest", F.col("old_id").alias("doc_id"))
    old = states.join(beaten, ["digest", "doc_id"])
    changes = [counted]
    for moved, sign in ((new, 1), (old, -1)):
        changes.append(moved.select(*KIND, (F.col("n") * sign).alias("n")))
        is_copy = F.col("mask").bitwiseOR(copy_bit)
        changes.append(moved.withColumn("mask", is_copy).select(*KIND, (F.col("n") * -sign).alias("n")))
    sums = changes[0]
    for change in changes[1:]:
        sums = sums.unionByName(change)
    sums = sums.groupBy(*KIND).agg(F.sum("n").alias("n")).where("n <> 0")
    sums.write.mode("overwrite").parquet(f"{store}/counters/batch={number}")


def audit(
    spark: SparkSession,
    path: str,
    labels: DataFrame,
    filters: Mapping[str, Filter],
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
    rounds: int = 4,
    store: str | None = None,
) -> DataFrame:
    """``part, mask, good, toxic, n``: documents of the Parquet files at ``path`` by part,
    failed filters (bit 0 is the first of ``filters``, the copies' bit the highest) and
    labels.

    ``store`` is the folder of the stream's progress, states and counters. Where it is
    given it stays, and a later call goes on from it with the files that are new.
    """
    copy_bit = 1 << len(filters)
    store, path = store or fresh_path(spark, "filter_audit"), path.rstrip("/")
    for kind, schema in (("states", STATE), ("counters", COUNTERS)):
        none = spark.createDataFrame([], schema)
        none.write.mode("overwrite").parquet(f"{store}/{kind}/batch=-1")

    table = spark.read.parquet(path)
    flags = land(labelled(labels), "label_flags")
    files = len(table.inputFiles())
    reader = spark.readStream.schema(table.schema)
    reader = reader.option("maxFilesPerTrigger", max(1, -(-files // rounds)))
    # As a pattern, as a stream takes a plain path for a folder's; a table may be one file.
    docs = reader.parquet(f"{path[:-1]}[{path[-1]}]")

    def count(batch: DataFrame, number: int) -> None:
        judged = fresh_path(spark, "masks")
        batch.write.parquet(judged)
        rows = spark.read.schema(batch.schema).parquet(judged).join(flags, "doc_id", "left")
        zero = F.lit(0)
        rows = rows.withColumns({c: F.coalesce(c, zero) for c in ("good", "toxic")})
        _count(spark, rows, number, copy_bit, store)

    query = (
        masked(docs, filters, id_col, text_col, part_col)
        .writeStream.option("checkpointLocation", f"{store}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(count)
        .start()
    )
    query.awaitTermination()
    kept = spark.read.schema(COUNTERS).parquet(f"{store}/counters")
    sums = kept.groupBy(*KIND).agg(F.sum("n").alias("n"))
    return sums.where("n <> 0")


def orders_report(counters: DataFrame, letters: str) -> DataFrame:
    """What each filter does at its step of each order: ``part, filter_order, step, kept,
    removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.

    ``letters`` name the filters, the lowest bit first.
    """
    k = len(letters)
    mask = F.col("mask")

    def passing(which: Column | None) -> Column:
        """Per set of filters, how many fail none of it."""
        n = F.col("n") if which is None else F.when(which, F.col("n"))
        sums = [
            F.coalesce(F.sum(F.when(mask.bitwiseAND(s) == 0, n)), F.lit(0)) for s in range(1 << k)
        ]
        return F.array(*[s.cast("long") for s in sums])

    alone = [F.coalesce(F.sum(F.when(mask == 1 << b, F.col("n"))), F.lit(0)) for b in range(k)]
    parts = counters.groupBy("part").agg(
        passing(None).alias("passing"),
        passing(F.col("good") == 1).alias("good_passing"),
        passing(F.col("toxic") == 1).alias("toxic_passing"),
        F.array(*[a.cast("long") for a in alone]).alias("alone"),
    )

    def share(bit: int) -> Column:
        """Removed by a filter, summed over all orders: sets of earlier ones, times
        the orders that have them before it and the others behind."""
        total = F.lit(0).cast("long")
        for s in range(1 << k):
            if not s >> bit & 1:
                times = factorial(s.bit_count()) * factorial(k - 1 - s.bit_count())
                removed = F.col("passing")[s] - F.col("passing")[s | 1 << bit]
                total = total + removed * times
        return total

    parts = parts.withColumn("shares", F.array(*[share(b) for b in range(k)]))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(letters)])
    rows = parts.withColumn("filter_order", F.explode(orders))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k))))
    place = [F.instr(F.col("filter_order"), letter) for letter in letters]

    def bits(chosen: Callable[[Column], Column]) -> Column:
        total = F.lit(0)
        for b in range(k):
            total = total + F.when(chosen(place[b]), 1 << b).otherwise(0)
        return total

    step = F.col("step")
    rows = rows.withColumns({"before": bits(lambda p: p < step), "own": bits(lambda p: p == step)})
    rows = rows.withColumn("after", F.col("before") + F.col("own"))
    rows = rows.withColumn("number", F.instr(F.lit(letters), F.substr("filter_order", "step", F.lit(1))) - 1)

    def lost(name: str) -> Column:
        return F.col(name)[F.col("before")] - F.col(name)[F.col("after")]

    removed = lost("passing")
    failing = F.col("passing")[0] - F.col("passing")[F.col("own")]
    return rows.select(
        "part",
        "filter_order",
        "step",
        F.col("passing")[F.col("after")].alias("kept"),
        removed.alias("removed"),
        (failing - removed).alias("redundant"),
        F.col("alone")[F.col("number")].alias("unique_fails"),
        lost("good_passing").alias("good_lost"),
        lost("toxic_passing").alias("toxic_lost"),
        F.col("shares")[F.col("number")].alias("shapley"),
    )
