"""Quality rules under weak supervision.

Each rule votes good or bad on a document, or abstains. Which rules are to be
believed is estimated without labels: expectation-maximisation over the votes of all
documents finds how often each rule votes each way on good documents and on each kind
of junk, and a document is kept if good is the likelier explanation of its votes. One
rule's bad vote may be overruled, and another's not.

Scale: one pass over the texts gives counts, votes and digests, which are stored;
digests are made distinct per task before the shuffle, which brings 16 bytes a text,
and there are at most 3 ** rules patterns (6,561), whatever the number of documents.
EM runs on the patterns' counts on the driver.

Edge cases: null, empty and blank texts have no words and fail the base; every row is
judged, but copies of one text are one text to EM, so they cannot move what is believed
of a rule; an empty table gives an empty result; with few documents the prior counts
keep EM near the rules' initial reading.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import as_bytes, ids_and_texts, slices
from ledgerfold.session import land

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\r\x0b\x0c"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

GOOD, BAD, ABSTAIN = "g", "b", "-"

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))


@dataclass(frozen=True)
class Counts:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_lines: int
    n_distinct: int
    top_word: int
    n_upper: int
    n_lower: int
    n_ends: int


def _without(text: bytes, characters: bytes) -> int:
    return len(text.translate(None, characters))


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of words found twice or more, the first one included.

    Windows are numbered by pairs of equal shorter windows, so equality is exact.
    """
    if len(words) <= window:
        return 0
    known: dict[bytes, int] = {}
    number = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    span = 1
    while span < window:
        pairs = number[:-span] * (int(number.max()) + 1) + number[span:]
        values, number, times = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(values) == len(pairs):
            return 0
        span *= 2
    starts = np.flatnonzero(times[number] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def count(text: bytes | None) -> Counts:
    text = text or b""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.split()]
    times: dict[bytes, int] = {}
    for word in words:
        times[word] = times.get(word, 0) + 1
    n_chars = len(text.decode("utf-8", "replace"))
    return Counts(
        n_words=len(words),
        word_chars=n_chars - (len(text) - _without(text, BLANKS)),
        n_symbols=len(text) - _without(text, SYMBOLS),
        n_dup_lines=len(lines) - len(set(lines)),
        n_repeat_words=repeat_words(words),
        n_lines=len(lines),
        n_distinct=len(times),
        top_word=max(times.values(), default=0),
        n_upper=len(text) - _without(text, _UPPER),
        n_lower=len(text) - _without(text, _LOWER),
        n_ends=sum(word[-1:] in (b".", b"!", b"?") for word in words),
    )


def between(value: float, good: float, bad: float) -> str:
    """Good up to one bound, bad from the other on, no opinion in between."""
    return GOOD if value <= good else BAD if value >= bad else ABSTAIN


def _symbols(c: Counts) -> str:
    return between(c.n_symbols / c.n_words, 0.05, 0.3)


def _capitals(c: Counts) -> str:
    letters = c.n_upper + c.n_lower
    return between(c.n_upper / letters, 0.2, 0.5) if letters >= 20 else ABSTAIN


def _lines(c: Counts) -> str:
    return between(c.n_dup_lines / c.n_lines, 0.0, 0.3) if c.n_lines >= 2 else ABSTAIN


def _windows(c: Counts) -> str:
    return between(c.n_repeat_words / c.n_words, 0.1, 0.25)


def _vocabulary(c: Counts) -> str:
    if not 30 <= c.n_words <= 2000:
        return ABSTAIN
    return between(1 - c.n_distinct / c.n_words, 0.7, 0.85)


def _top_word(c: Counts) -> str:
    return between(c.top_word / c.n_words, 0.15, 0.3) if c.n_words >= MIN_WORDS else ABSTAIN


def _word_length(c: Counts) -> str:
    mean = c.word_chars / c.n_words
    return GOOD if 3 <= mean <= 10 else BAD if mean < 2 or mean > 15 else ABSTAIN


def _sentences(c: Counts) -> str:
    if c.n_words < 2 * MIN_WORDS:
        return ABSTAIN
    per_word = c.n_ends / c.n_words
    return GOOD if 0.01 <= per_word <= 0.4 else BAD if per_word > 0.6 else ABSTAIN


RULES: list[Callable[[Counts], str]] = [
    _symbols,
    _capitals,
    _lines,
    _windows,
    _vocabulary,
    _top_word,
    _word_length,
    _sentences,
]


def votes(counts: Counts) -> str:
    """One character per rule."""
    if not counts.n_words:
        return ABSTAIN * len(RULES)
    return "".join(rule(counts) for rule in RULES)


BASE = "n_words LONG, word_chars LONG, n_symbols LONG, n_dup_lines LONG, n_repeat_words LONG"


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the base counts, the ``votes`` and the text's ``digest`` of every document."""
    names = [part.split()[0] for part in BASE.split(", ")]

    def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = as_bytes(batch.column(1))
            found = [count(text) for text in texts]
            columns = [pa.array([getattr(c, n) for c in found], pa.int64()) for n in names]
            cast = pa.array([votes(c) for c in found], pa.string())
            digests = [blake2b(text or b"", digest_size=16).digest() for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, cast, pa.array(digests, pa.binary())],
                names=["doc_id", *names, "votes", "digest"],
            )

    rows = ids_and_texts(docs, id_col, text_col)
    return rows.mapInArrow(counting, f"doc_id LONG, {BASE}, votes STRING, digest BINARY")


#: How many documents' worth of belief there is in the start, for each one seen.
STARTED = 2.0


@dataclass(frozen=True)
class Beliefs:
    """What EM has found: kind 0 is good, the others are kinds of junk."""

    table: np.ndarray  # kind, rule: how often a vote of the rule is bad
    share: np.ndarray  # of each kind
    kind: np.ndarray  # pattern, kind: posterior probability
    fit: float  # log-likelihood of all votes


def _fitted(
    n: np.ndarray, bad: np.ndarray, cast: np.ndarray, start: np.ndarray, share: np.ndarray,
    firm: np.ndarray, prior: float, rounds: int,
) -> Beliefs:
    """EM from rates ``start`` and shares ``share``: shares, and rates marked ``firm``, are
    believed as if ``STARTED`` times the documents had shown them, others as ``prior`` are."""
    shown = STARTED * n.sum() * share
    belief = prior + firm * shown[:, None]
    table, shares = start, share
    for _ in range(rounds):
        likely = bad @ np.log(table).T + (cast - bad) @ np.log(1 - table).T + np.log(shares)
        top = likely.max(axis=1, keepdims=True)
        kind = np.exp(likely - top)
        whole = kind.sum(axis=1, keepdims=True)
        kind /= whole
        weight = kind * n[:, None]
        table = (weight.T @ bad + belief * start) / (weight.T @ cast + belief)
        shares = weight.sum(axis=0) + shown + prior * share
        shares /= shares.sum()
    fit = float((n * (top[:, 0] + np.log(whole[:, 0]))).sum())
    return Beliefs(table, shares, kind, fit)


def estimate(
    patterns: list[str], times: list[int], rounds: int = 200, prior: float = 10.0
) -> dict[str, float]:
    """Posterior probability of good for each pattern of votes.

    Documents are good, or bad in one of several kinds: junk of one kind need not show in
    the other rules. EM finds each kind's share, and how often a rule that votes calls a
    document of the kind bad; for good documents that is how often the rule errs.
    Abstaining says nothing. It starts with a kind for each rule, in which that rule is
    right on 9 of 10 and the others call 1 of 50 bad. What other rules make of a kind is
    left to the votes: ``prior`` documents' worth of the start stand against them. But
    votes alone cannot tell whether what one rule finds, and no other, is a kind of junk
    or its mistake; so kinds' shares, a rule's rate on its own kind, and how often it errs
    on good documents, as ``mistakes`` has it, are believed ``STARTED`` times as firmly
    as the votes.

    A kind that has nothing but its own rule's bad votes explains them no better than
    errors of the rule do. So kinds are taken out again, the one that is missed least
    first, while that costs less likelihood than its numbers are worth (Bayesian
    information criterion). Only a rule that another kind shows together with others,
    in half its documents or more, can lose its own: what a rule finds is its mistake where
    the rules that usually find the same do not. A rule that never votes with others has
    nothing to be compared with, and the start's belief in it stands.
    """
    n = np.array(times, np.float64)
    bad = np.array([[vote == BAD for vote in p] for p in patterns], np.float64)
    cast = np.array([[vote != ABSTAIN for vote in p] for p in patterns], np.float64)
    n_rules = bad.shape[1]
    start = np.full((1 + n_rules, n_rules), 0.02)
    start[0] = mistakes(n, bad, cast, prior)
    start[np.arange(n_rules) + 1, np.arange(n_rules)] = 0.9
    share = np.array([0.86] + [0.14 / n_rules] * n_rules)
    firm = np.concatenate([np.ones((1, n_rules)), np.eye(n_rules)])

    def fitted(kinds: list[int]) -> Beliefs:
        shares = share[kinds] / share[kinds].sum()
        return _fitted(n, bad, cast, start[kinds], shares, firm[kinds], prior, rounds)

    worth = (n_rules + 1) * np.log(n.sum()) / 2
    kinds = list(range(1 + n_rules))
    beliefs = fitted(kinds)
    while True:
        without = []
        for place, kind in enumerate(kinds[1:], 1):
            others = np.delete(beliefs.table[1:, kind - 1], place - 1)
            if others.size and others.max() >= 0.5:
                left = [k for k in kinds if k != kind]
                without.append((left, fitted(left)))
        left, fewer = max(without, key=lambda one: one[1].fit, default=(None, None))
        if left is None or fewer.fit + worth < beliefs.fit:
            return dict(zip(patterns, beliefs.kind[:, 0].tolist()))
        kinds, beliefs = left, fewer


def mistakes(n: np.ndarray, bad: np.ndarray, cast: np.ndarray, prior: float) -> np.ndarray:
    """How often each rule is taken to call good documents bad, before EM.

    A rule that errs does so whatever the others say: its rate of bad votes is the same
    with another rule's bad vote as without. The rate is lowered by as much as the two
    differ, either way: a kind of junk that only one rule finds shows without the others,
    and one that several find shows with them. Where no other rule finds anything there
    is nothing to compare with, and the rate is the least, 1 of 100.
    """
    others = bad.sum(axis=1, keepdims=True) > bad

    def rate(rows: np.ndarray) -> np.ndarray:
        weight = n[:, None] * rows
        found, voted = (weight * bad).sum(axis=0), (weight * cast).sum(axis=0)
        return (found + prior * 0.01) / (voted + prior)

    alone, along = rate(~others), rate(others)
    return np.clip(alone * np.minimum(alone / along, along / alone), 0.01, 0.9)


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts, ``base_failed``, ``votes``, ``probability`` of good, and ``kept``."""
    rows = land(counted(docs, id_col, text_col), "votes")
    spark = docs.sparkSession
    # At most 3 ** rules rows.
    found = rows.select("votes", "digest").distinct().groupBy("votes").count().collect()
    good = estimate([r["votes"] for r in found], [r["count"] for r in found]) if found else {}
    known = spark.createDataFrame(list(good.items()), "votes STRING, probability DOUBLE")
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return rows.join(F.broadcast(known), "votes").select(
        "doc_id",
        *[part.split()[0] for part in BASE.split(", ")],
        base_failed.alias("base_failed"),
        (~base_failed & (F.col("probability") >= 0.5)).alias("kept"),
        "votes",
        "probability",
    )
