"""Mixing documents to target weights over a tree of domain, language and source.

Everything is DataFrame code. A budget of tokens is handed down the tree. At every
node the children share it by weight; a child that cannot use its share (its
subtree holds fewer tokens, times the epochs allowed) takes what it can, and what it
leaves goes to its siblings by their weights. As a child's capacity is that of its
whole subtree, a shortage reaches a node's siblings only when its own children
cannot take it up: siblings first, then ancestors.

A leaf then takes whole epochs of its documents and of one more epoch a prefix, in
an order seeded by epoch, whose tokens stay within the rest of the budget.

Scale: per leaf only sums travel. The tables of leaves are stored, and by their size
Spark sends them to all tasks or joins them by a shuffle that it can split. The order
of an epoch is a digest; its first digits are a bucket. Sums per (leaf, bucket) find the
bucket in which a leaf's prefix ends, and sums per place in that bucket the place: a
window orders one row without text per place, however many rows share it. No task ever
holds a leaf, however large. The tables of leaves and buckets have at most
(leaves x 16^digits) rows.

Edge cases: null language or source is a child named ``""``; an unlisted name has
weight 1, a name of weight 0 takes nothing; null or empty texts have 0 tokens and
come with the prefix they stand in; a leaf without a budget gives nothing; an empty
table gives an empty result. Rows that share an id, or have none, are separate documents
with the same place in the order: they are taken or left together, as in the SQL of
``op3_mixing``; with ``split_ties`` only those of one text are. What integer division leaves of
a budget, less than a token per child, is not handed out.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerfold.llm.common import WORD, packed, unpacked
from ledgerfold.session import land

PATH = ["domain", "lang", "source"]


@dataclass(frozen=True)
class Mix:
    """Weights are whole numbers. ``domains`` maps a domain to its weight and sources."""

    domains: Mapping[str, tuple[int, tuple[str, ...]]]
    languages: Mapping[str, int] = field(default_factory=dict)
    sources: Mapping[str, int] = field(default_factory=dict)
    #: The budget: this share of all tokens, as a fraction of whole numbers.
    share: tuple[int, int] = (1, 1)
    max_epochs: int = 1
    seed: int = 42
    bucket_digits: int = 3
    #: Rows without an id have a place by their text's digest, those of one id come in its order.
    split_ties: bool = False


def _by_name(name: Column, values: Mapping[str, object], default: object) -> Column:
    chosen = F.lit(default)
    for key, value in values.items():
        chosen = F.when(name == key, F.lit(value)).otherwise(chosen)
    return chosen


def _shared(children: DataFrame, parent: list[str], name: str, budget: str, out: str) -> DataFrame:
    """Share ``budget`` of each parent among its children by ``weight`` up to ``cap``.

    Children in the order of cap / weight: those at the front are full as long as
    their cap is below what is left, shared by the weights that are left.
    """
    group = Window.partitionBy(*parent)
    fill = F.col("cap") / F.nullif(F.col("weight"), F.lit(0))
    order = group.orderBy(fill.asc_nulls_last(), name)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    ranked = children.withColumns(
        {
            "before": F.sum("cap").over(upto) - F.col("cap"),
            "weights_left": F.sum("weight").over(onward),
        }
    )
    full = F.col("cap") * F.col("weights_left") <= (F.col(budget) - F.col("before")) * F.col(
        "weight"
    )
    marked = ranked.withColumn("full", full & (F.col("weight") > 0))
    rest = marked.withColumns(
        {
            "full_caps": F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(group),
            "open_weights": F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(group),
        }
    )
    part = F.expr(f"(({budget} - full_caps) * weight) div open_weights")
    given = F.when(F.col("full"), F.col("cap")).when(F.col("open_weights") > 0, part).otherwise(0)
    scratch = ["before", "weights_left", "full", "full_caps", "open_weights", "weight", "cap"]
    return rest.withColumn(out, given.cast("long")).drop(*scratch)


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``domain, lang, source, tokens`` of each leaf, with its ``budget``."""
    weights = {
        "domain": _by_name(F.col("domain"), {d: w for d, (w, _) in mix.domains.items()}, 1),
        "lang": _by_name(F.col("lang"), mix.languages, 1),
        "source": _by_name(F.col("source"), mix.sources, 1),
    }
    # Weight 0 anywhere on the path takes a leaf's capacity out of its ancestors'.
    usable = (weights["domain"] > 0) & (weights["lang"] > 0) & (weights["source"] > 0)
    room = F.when(usable, F.col("tokens") * mix.max_epochs).otherwise(F.lit(0)).cast("long")
    total = F.sum("tokens").over(Window.partitionBy())
    level = leaves.withColumn("room", room).withColumn("all_tokens", total)
    target = F.expr(f"(all_tokens * {mix.share[0]}L) div {mix.share[1]}L")
    level = level.withColumn("given_0", target).drop("all_tokens")
    for depth, name in enumerate(PATH):
        parent, node = PATH[:depth], PATH[: depth + 1]
        children = level.groupBy(*node).agg(
            F.sum("room").alias("cap"), F.first(f"given_{depth}").alias("given")
        )
        shared = _shared(
            children.withColumn("weight", weights[name].cast("long")),
            parent,
            name,
            "given",
            f"given_{depth + 1}",
        ).drop("given")
        level = level.join(shared, node)
    return level.select(*PATH, "tokens", F.col("given_3").alias("budget"))


def mix_documents(
    docs: DataFrame,
    mix: Mix,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """The chosen documents: ``doc_id, text, rest``, the leaf, ``n_tokens`` and ``epoch``.

    A document comes once per epoch it is chosen in.
    """
    domain_of = {s: d for d, (_, sources) in mix.domains.items() for s in sources}
    rows = packed(docs, id_col, text_col).withColumns(
        {
            "lang": F.coalesce(F.col("rest")[lang_col].cast("string"), F.lit("")),
            "source": F.coalesce(F.col("rest")[source_col].cast("string"), F.lit("")),
            "n_tokens": F.coalesce(
                F.regexp_count(F.col("text"), F.lit(WORD)).cast("long"), F.lit(0).cast("long")
            ),
        }
    )
    rows = rows.withColumn("domain", _by_name(F.col("source"), domain_of, "other"))

    leaves = rows.groupBy(*PATH).agg(F.sum("n_tokens").alias("tokens"))
    # No prefix is left of a leaf without a budget, or that is taken in all its epochs.
    spent = (F.col("budget") == 0) | (F.col("budget") == F.col("tokens") * mix.max_epochs)
    some = F.col("budget") > 0
    budgets = leaf_budgets(leaves, mix).select(
        *PATH,
        F.when(some, F.expr("budget div tokens")).otherwise(0).cast("int").alias("whole"),
        F.when(spent, -1).otherwise(F.expr("budget % tokens")).cast("long").alias("prefix"),
    )

    # Small tables are stored: their real size then decides on sending them to all tasks,
    # and the texts are not shuffled to meet them.
    budgets = land(budgets, "leaf_budgets")

    # Documents with the place they have in the epoch that their leaf takes in part.
    def digest(of: Column) -> Column:
        return F.md5(F.concat_ws("-", F.lit(mix.seed), "whole", of).cast("binary"))

    place = digest(F.col("doc_id"))
    if mix.split_ties:
        by_text = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
        place = F.concat(F.when(F.isnull("doc_id"), digest(by_text)).otherwise(place), by_text)
    placed = (
        rows.join(budgets, PATH)
        .withColumn("place", place)
        .withColumn("bucket", F.substring("place", 1, mix.bucket_digits))
    )
    sums = placed.groupBy(*PATH, "prefix", "bucket").agg(F.sum("n_tokens").alias("tokens"))
    by_bucket = Window.partitionBy(*PATH).orderBy("bucket")
    running = sums.withColumn("until", F.sum("tokens").over(by_bucket))
    over = F.when(F.col("until") > F.col("prefix"), F.col("bucket"))
    before = F.when(F.col("until") <= F.col("prefix"), F.col("tokens"))
    ends = running.groupBy(*PATH).agg(
        F.min(over).alias("last_bucket"), F.coalesce(F.sum(before), F.lit(0)).alias("before")
    )
    ends = land(ends, "prefix_ends")

    # The last bucket's places in order, one small row each; the texts stay where they are.
    in_last = placed.join(ends, PATH).where(F.col("bucket") == F.col("last_bucket"))
    places = in_last.groupBy(*PATH, "prefix", "before", "place").agg(
        F.sum("n_tokens").alias("tokens")
    )
    in_order = Window.partitionBy(*PATH).orderBy("place")
    until = F.col("before") + F.sum("tokens").over(in_order)
    fits = places.withColumn("until", until).where("until <= prefix")
    cuts = fits.groupBy(*PATH).agg(F.max("place").alias("last_place"))
    cuts = ends.join(cuts, PATH, "left").drop("before")
    marked = placed.join(land(cuts, "prefix_cuts"), PATH)

    def epochs(in_prefix: Column) -> Column:
        last = F.col("whole") - F.when(in_prefix, 0).otherwise(1)
        return F.explode(F.when(last >= 0, F.sequence(F.lit(0), last)))

    at_end = (F.col("bucket") == F.col("last_bucket")) & (F.col("place") <= F.col("last_place"))
    inside = (
        F.col("last_bucket").isNull() | (F.col("bucket") < F.col("last_bucket")) | at_end
    )
    return marked.select(
        "doc_id", "text", "rest", *PATH, "n_tokens", epochs(inside).alias("epoch")
    )


def mixed_like(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text"):
    """The chosen documents with the columns of ``docs`` only."""
    chosen = mix_documents(docs, mix, id_col, text_col)
    return chosen.select(*unpacked(chosen, docs, id_col, text_col))
