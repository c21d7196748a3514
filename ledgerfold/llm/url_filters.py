"""URLs judged by rules, and by two character language models where no rule fits.

The URLs that a rule allows and those that one blocks are the accepted and the rejected
examples. For each side a Markov model of variable order gives the probability of a
character after the ones before it: the counts of the longest context that was seen,
smoothed by those of the shorter ones (Witten and Bell), down to an even share of
``ALPHABET`` characters. A URL's score is the difference of its log-likelihoods by the
two models, over its length. One fold of the examples is kept out of the counts, and
the score that tells its two sides apart best is the limit of the others.

How it scales. Models are tables of character strings, counted over every distinct
address, and grow with them; nothing of them is collected or broadcast whole. Strings
are counted once at full length; shorter ones are sums over the distinct longer ones.
A context's followers are as many as there are characters, so windows and joins of the
models have no hot key. The characters of the addresses meet the models in
``common.look_up``: strings that hold more than one in ``HEAVY`` of all characters are
fewer than that and sent to all tasks, the rest is joined by a shuffle in which no key
has more than that share. Copies of an address are one address until the end.

Rows. A null URL, or one without ``://``, has an empty host and path. An address is
host and path; an empty one has only its end to be judged by. Long ones are taken
whole. Repeated rows are judged alike; a null id stays null. Without examples of both
sides scores and the limit are 0, and what no rule fits is allowed; an empty table gives
no rows. Other columns stay in ``rest`` and may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerfold.llm.common import look_up, packed, unpacked
from ledgerfold.session import land

#: Characters before the one that is judged.
ORDER = 5

#: Characters that a model without any counts takes as equally likely.
ALPHABET = 256

#: One fold in this many is kept to find the limit.
FOLDS = 5

#: Log-likelihoods are summed in steps of 1 / UNIT, so that sums do not depend on order.
UNIT = 1 << 20

#: The limit is looked for in steps of 1 / STEPS between the scores -BOUND and BOUND.
STEPS, BOUND = 256, 32

#: Outside any address: what stands before its first character, and its end.
START, END = "\x02", "\x03"

#: ``(verdict, host and path)``; a rule holds for its host and all subdomains.
Rules = Sequence[tuple[str, str]]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Rules) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        site, slash, rest = text.partition("/")
        there = (host == site) | F.endswith(host, F.lit(f".{site}"))
        fits = there & F.startswith(path, F.lit(slash + rest))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def _strings(address: Column, order: int) -> Column:
    """For each character, and the end, the ``order`` ones before it and itself."""
    padded = F.split(F.concat(F.lit(START * order), address, F.lit(END)), "")
    # The array beside itself, moved on by one each time: linear in the length, as a lambda
    # that looks into the array would not be.
    moved = [F.slice(padded, k + 1, F.length(address) + 1) for k in range(order + 1)]
    return F.transform(
        F.arrays_zip(*moved), lambda s: F.concat(*[s[str(k)] for k in range(order + 1)])
    )


def _characters(addresses: DataFrame, order: int) -> DataFrame:
    """A row ``gram`` per character of each address."""
    grams = F.explode(_strings(F.col("address"), order)).alias("gram")
    return addresses.select("digest", "side", grams)


def counts(addresses: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, n, accepted, rejected``: strings of full length in all addresses, and in
    the examples of each side."""
    return (
        _characters(addresses, order)
        .groupBy("gram")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("side") == 1).alias("accepted"),
            F.count_if(F.col("side") == 0).alias("rejected"),
        )
    )


def ratios(counted: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, n, ratio``: by how much likelier, in steps of 1 / UNIT of its logarithm,
    the last character is among the accepted than among the rejected."""
    shorter = None
    for k in range(order + 1):
        gram = F.substring("gram", order + 1 - k, k + 1).alias("gram")
        level = counted.groupBy(gram).agg(
            *[F.sum(c).alias(c) for c in ("n", "accepted", "rejected")]
        )
        of_context = Window.partitionBy(F.substring("gram", 1, k))
        level = level.withColumns(
            {
                **{f"{c}_seen": F.sum(c).over(of_context) for c in ("accepted", "rejected")},
                **{
                    f"{c}_kinds": F.count_if(F.col(c) > 0).over(of_context)
                    for c in ("accepted", "rejected")
                },
            }
        )
        if shorter is None:
            even = F.lit(1.0 / ALPHABET)
            level = level.withColumns({"accepted_less": even, "rejected_less": even})
        else:
            level = level.withColumn("tail", F.substring("gram", 2, k)).join(shorter, "tail")
        chances = {
            f"{c}_chance": F.when(
                F.col(f"{c}_seen") > 0,
                (F.col(c) + F.col(f"{c}_kinds") * F.col(f"{c}_less"))
                / (F.col(f"{c}_seen") + F.col(f"{c}_kinds")),
            ).otherwise(F.col(f"{c}_less"))
            for c in ("accepted", "rejected")
        }
        level = level.withColumns(chances)
        shorter = level.select(
            F.col("gram").alias("tail"),
            F.col("accepted_chance").alias("accepted_less"),
            F.col("rejected_chance").alias("rejected_less"),
        )
    difference = F.ln("accepted_chance") - F.ln("rejected_chance")
    return level.select("gram", "n", F.round(difference * UNIT).cast("long").alias("ratio"))


def limit(scored: DataFrame) -> float:
    """The score that parts the kept examples (``score, example``) with the fewest errors,
    each side weighing the same: the middle of the gap; of several the one nearest 0."""
    step = F.floor(F.least(F.greatest("score", F.lit(-BOUND)), F.lit(BOUND)) * STEPS).cast("int")
    # At most 2 * BOUND * STEPS + 1 rows.
    by_step = scored.groupBy(step.alias("step")).agg(
        F.count_if(F.col("example") == 1).alias("accepted"),
        F.count_if(F.col("example") == 0).alias("rejected"),
    )
    ordered = Window.partitionBy(F.lit(0)).orderBy("step")
    everywhere = Window.partitionBy(F.lit(0))
    below = ordered.rowsBetween(Window.unboundedPreceding, -1)
    known = by_step.where("accepted + rejected > 0").withColumns(
        {
            "rights": (
                1
                - F.coalesce(F.sum("accepted").over(below), F.lit(0))
                / F.nullif(F.sum("accepted").over(everywhere), F.lit(0))
                + F.coalesce(F.sum("rejected").over(below), F.lit(0))
                / F.nullif(F.sum("rejected").over(everywhere), F.lit(0))
            ),
            "before": F.lag("step").over(ordered),
        }
    )
    middle = (F.col("step") + F.coalesce(F.col("before") + 1, F.col("step"))) / 2 / STEPS
    best = (
        known.where("rights IS NOT NULL")
        .select("rights", middle.alias("middle"))
        .orderBy(F.desc("rights"), F.abs("middle"), "middle")
        .first()
    )
    return best["middle"] if best else 0.0


def judge_rows(
    pages: DataFrame,
    rules: Rules,
    id_col: str = "page_id",
    url_col: str = "url",
    order: int = ORDER,
) -> DataFrame:
    """Every row as ``doc_id, text, rest`` (id, URL, other columns), with ``host``,
    ``path``, ``rule``, ``verdict``, ``score`` and the ``score_limit`` it is held to."""
    rows = packed(pages, id_col, url_col)
    rows = rows.withColumns({"host": host_of(F.col("text")), "path": path_of(F.col("text"))})
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    address = F.concat("host", "path")
    rows = rows.withColumns({"rule": rule, "action": action, "digest": F.md5(address.cast("binary"))})

    # Examples: 1 accepted, 0 rejected. Those of the kept fold have no side in the counts.
    example = F.when(F.col("action") == "allow", 1).when(F.col("action") == "block", 0)
    addresses = rows.groupBy("digest").agg(
        F.any_value(address).alias("address"),
        F.any_value(example).alias("example"),
        F.count(F.lit(1)).alias("pages"),
    )
    kept_out = F.crc32(F.col("address").cast("binary")) % FOLDS == 0
    addresses = land(addresses.withColumn("side", F.when(~kept_out, F.col("example"))), "addresses")

    counted = land(counts(addresses, order), "url_strings")
    models = land(ratios(counted, order), "url_models")
    sides = addresses.agg(F.count_if(F.col("side") == 1), F.count_if(F.col("side") == 0)).first()
    told = F.lit(float(all(sides)))
    sums = look_up(_characters(addresses, order), models, ["gram"], "n").groupBy("digest")
    mean = F.sum("ratio") / (F.count(F.lit(1)) * UNIT) * told
    scored = addresses.join(sums.agg(mean.alias("score")), "digest")
    scored = land(scored.select("digest", "pages", "example", "side", "score"), "url_scores")
    least = limit(scored.where("side IS NULL AND example IS NOT NULL"))

    judged = look_up(rows, scored.select("digest", "pages", "score"), ["digest"], "pages")
    model = F.when(F.col("score") >= least, "allow").otherwise("block")
    return judged.select(
        "doc_id",
        "text",
        "rest",
        "host",
        "path",
        "rule",
        F.coalesce("action", model).alias("verdict"),
        "score",
        F.lit(least).alias("score_limit"),
    )


def allowed(
    pages: DataFrame,
    rules: Rules,
    id_col: str = "page_id",
    url_col: str = "url",
    order: int = ORDER,
) -> DataFrame:
    """The pages whose URL is allowed, with their columns as they were."""
    kept = judge_rows(pages, rules, id_col, url_col, order).where("verdict = 'allow'")
    return kept.select(*unpacked(kept, pages, id_col, url_col))
