"""Toxicity by a grammar of weighted finite-state transducers over clauses.

A text is cut into clauses. Every token is read as one of a few symbols: an insult or
harm (with a weight), a target, a modal, a negation, a word of speech, or anything
else. Transducers read the symbols side by side, each keeping a small state, and their
composition gives a clause its weight:

* insult: a term weighs as learned, and more next to another one in its clause;
* threat: harm that follows a modal weighs in full, harm alone little, whether its
  weight is learned or fixed;
* target: a clause that names someone weighs more;
* negation: a term shortly after a negation weighs less;
* reported speech: a term after a word of speech, or within quotes, weighs less.

Terms and their weights are learned from labelled texts: words, and beginnings of
words, that toxic texts have far more often than others. A text's score is a logistic
function of its clauses' total weight and of that weight's share of its length, fitted
on the labelled texts, each of them scored without its own share in the statistics.

Scale: learning takes a sample of labelled documents (``SAMPLE``, by a hash of the id,
one row per id, so it can be broadcast) and counts terms per task before the shuffle; at most ``MAX_TERMS`` terms are sent to
all tasks. The fit works on counts in a grid of fixed size. Scoring is a scan.

Edge cases: null, empty and blank texts match nothing and get the score of such texts;
long texts are read whole, clause by clause; an id that ``labels`` repeats counts once;
ties between terms go to the first by name; with no labels of one of the classes, no
term is learned; repeated rows are separate documents; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold.llm.common import ids_and_texts, packed, sample_by_hash, slices

#: Labelled documents that are learned from, about.
SAMPLE = 20_000
MAX_TERMS = 20_000

#: Beginnings of words that may be terms have these lengths.
BEGINNINGS = (4, 5, 6, 7)

#: A term is in so many toxic texts at least, and so many times likelier there.
MIN_TEXTS = 3
MIN_RATIO = 4.0

# Fixed word lists of the grammar, in the languages of the documents.
TARGETS = frozenset("you your he she they this that him her them il elle vous tu er sie du".split())
MODALS = frozenset("will shall gonna must going should werde muss voy debe vais dois".split())
HARM = frozenset("kill hurt destroy beat burn shoot stab crush murder tuer töten matar".split())
NEGATIONS = frozenset("not no never nobody isn aren pas jamais nicht kein keine nunca".split())
SPEECH = frozenset("said says wrote called quoted reported dit sagte schrieb dijo".split())

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n\"“”«»]")
_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE_END = frozenset(".!?;\n")
_QUOTE = frozenset("\"“”«»")

INSULT, HARMS, TARGET, MODAL, NEGATION, SPOKEN, QUOTE, OTHER = range(8)


@dataclass(frozen=True)
class Transducer:
    """``arcs`` maps state and symbol to the next state and the factor put out.

    A pair that is not listed stays in its state, or goes to ``fades`` of it, with
    factor 1.
    """

    arcs: dict[tuple[int, int], tuple[int, float]]
    fades: dict[int, int]

    def step(self, state: int, symbol: int) -> tuple[int, float]:
        found = self.arcs.get((state, symbol))
        return found if found else (self.fades.get(state, state), 1.0)


#: An insult within two tokens after another insult weighs more: terms are heaped.
HEAPED = Transducer(
    arcs={(0, INSULT): (2, 1.0), **{(s, INSULT): (2, 1.2) for s in (1, 2)}},
    fades={2: 1, 1: 0},
)
#: Harm weighs in full after a modal, which is forgotten after three more tokens.
THREAT = Transducer(
    arcs={
        **{(s, MODAL): (3, 1.0) for s in range(4)},
        (0, HARMS): (0, 0.2),
        **{(s, HARMS): (0, 1.0) for s in (1, 2, 3)},
    },
    fades={3: 2, 2: 1, 1: 0},
)
#: Within two tokens after a negation, a term weighs a third less.
NEGATED = Transducer(
    arcs={
        **{(s, NEGATION): (2, 1.0) for s in range(3)},
        **{(s, t): (s - 1, 0.67) for s in (1, 2) for t in (INSULT, HARMS)},
    },
    fades={2: 1, 1: 0},
)
#: After a word of speech, and between quotes, a term weighs a third less.
REPORTED = Transducer(
    arcs={
        (0, SPOKEN): (1, 1.0),
        **{(s, QUOTE): (2, 1.0) for s in (0, 1)},
        (2, QUOTE): (0, 1.0),
        **{(s, t): (s, 0.67) for s in (1, 2) for t in (INSULT, HARMS)},
    },
    fades={},
)
#: What follows a target in the clause weighs more.
TARGETED = Transducer(
    arcs={
        **{(s, TARGET): (1, 1.0) for s in (0, 1)},
        **{(1, t): (1, 1.25) for t in (INSULT, HARMS)},
    },
    fades={},
)
GRAMMAR = (HEAPED, THREAT, NEGATED, REPORTED, TARGETED)

#: Weight of harm, which is a fixed word list, on the scale of learned weights.
HARM_WEIGHT = 3.0


class Composition:
    """Transducers that read one input side by side; the factors multiply.

    The states reached are numbered as they are met, each step is worked out once.
    """

    def __init__(self, parts: tuple[Transducer, ...] = GRAMMAR) -> None:
        self._parts = parts
        self._steps: dict[tuple[tuple[int, ...], int], tuple[tuple[int, ...], float]] = {}
        self.start = (0,) * len(parts)

    def step(self, state: tuple[int, ...], symbol: int) -> tuple[tuple[int, ...], float]:
        found = self._steps.get((state, symbol))
        if not found:
            each = [part.step(s, symbol) for part, s in zip(self._parts, state)]
            found = (tuple(s for s, _ in each), math.prod(factor for _, factor in each))
            self._steps[state, symbol] = found
        return found


_SYMBOLS = {
    **dict.fromkeys(TARGETS, TARGET),
    **dict.fromkeys(MODALS, MODAL),
    **dict.fromkeys(HARM, HARMS),
    **dict.fromkeys(NEGATIONS, NEGATION),
    **dict.fromkeys(SPEECH, SPOKEN),
    **dict.fromkeys(_QUOTE, QUOTE),
}


def terms_of(text: str | None) -> set[str]:
    """Words of a text, and beginnings of longer words marked by a star."""
    words = set(_WORD.findall((text or "").lower()))
    return words | {w[:n] + "*" for w in words for n in BEGINNINGS if len(w) > n}


@dataclass(frozen=True)
class Lexicon:
    """Terms with the numbers of toxic and other texts that have them."""

    terms: dict[str, tuple[int, int]]
    n_toxic: int
    n_other: int

    def weight(self, term: str, label: int | None = None) -> float:
        """Log ratio of the shares of texts; without one text of ``label``, if given."""
        toxic, other = self.terms[term]
        toxic, other = toxic - (label == 1), other - (label == 0)
        share = (toxic + 0.2) / (self.n_toxic + 1)
        return math.log(share / ((other + 0.2) / (self.n_other + 1))) if toxic > 0 else 0.0


def matched(text: str | None, lexicon: Lexicon, label: int | None = None) -> tuple[float, int]:
    """Total weight of a text's clauses, and its number of words.

    With ``label``, as if the text had not been learned from.
    """
    lowered = (text or "").lower()
    words = _WORD.findall(lowered)
    weights: dict[str, float] = {}
    for word in set(words):
        found = [word, *[word[:n] + "*" for n in BEGINNINGS if len(word) > n]]
        known = [lexicon.weight(term, label) for term in found if term in lexicon.terms]
        if known and max(known) > 0:
            # The whole word counts if it is known, else its most telling beginning.
            weights[word] = known[0] if word in lexicon.terms else max(known)
    if not weights and not HARM.intersection(words):
        return 0.0, len(words)
    total = 0.0
    met: dict[str, int] = {}
    machine = Composition()
    state, clause = machine.start, 0.0
    for token in _TOKEN.findall(lowered):
        if token in _CLAUSE_END:
            total += clause
            state, clause = machine.start, 0.0
            continue
        weight = weights.get(token, 0.0)
        # A word of the lists keeps its role, also where the labels give it a weight.
        symbol = _SYMBOLS.get(token, INSULT if weight else OTHER)
        state, factor = machine.step(state, symbol)
        if weight or symbol == HARMS:
            # A term that is repeated over and over adds less each time.
            met[token] = met.get(token, 0) + 1
            clause += (weight or HARM_WEIGHT) * factor / met[token]
    return total + clause, len(words)


def features(weight: float, n_words: int) -> tuple[float, float]:
    """Total weight and weight per word, on scales that a logistic can use."""
    return math.log1p(weight), math.log1p(200 * weight / max(n_words, 20))


@dataclass(frozen=True)
class Grammar:
    """The lexicon and the logistic on ``features``."""

    lexicon: Lexicon
    logistic: tuple[float, float, float]

    def score(self, text: str | None) -> float:
        a, b = features(*matched(text, self.lexicon))
        bias, by_weight, by_share = self.logistic
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, bias + by_weight * a + by_share * b))))


#: Bins per feature in the grid that the logistic is fitted on, and their width.
BINS, WIDTH = 64, 0.125


def _logistic(cells: list[tuple[int, int, int, int]], ridge: float = 1.0) -> tuple:
    """Newton's method on ``(bin, bin, label, n)``; ``ridge`` holds weights near 1."""
    if not cells:
        return (0.0, 1.0, 1.0)
    grid = np.array(cells, np.float64)
    x = np.column_stack([np.ones(len(grid)), (grid[:, 0] + 0.5) * WIDTH, (grid[:, 1] + 0.5) * WIDTH])
    x[:, 1:][grid[:, :2] == 0] = 0.0
    y, n = grid[:, 2], grid[:, 3]
    centre, hold = np.array([-2.0, 1.0, 1.0]), ridge * np.array([0.1, 1.0, 1.0])
    beta = centre.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -50, 50)))
        gradient = x.T @ (n * (y - p)) - hold * (beta - centre)
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(hold)
        step = np.linalg.solve(curve, gradient)
        beta = beta + step * min(1.0, 3.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return tuple(beta.tolist())


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
    max_terms: int = MAX_TERMS,
) -> Grammar:
    """Learns from documents that ``labels`` (one row per document) marks 0 or 1."""
    chosen = sample_by_hash(labels, id_col, label_col, sample)
    rows = ids_and_texts(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")
    rows = rows.select("label", "text")

    def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times: dict[str, list[int]] = {}
        for batch in slices(batches):
            for label, text in zip(*(c.to_pylist() for c in batch.columns)):
                for term in terms_of(text):
                    times.setdefault(term, [0, 0])[label] += 1
        if times:
            other, toxic = zip(*times.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(times)), pa.array(toxic, pa.int64()), pa.array(other, pa.int64())],
                names=["term", "toxic", "other"],
            )

    size = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n_toxic, n_other = size.get(1, 0), size.get(0, 0)
    counted = rows.mapInArrow(counting, "term STRING, toxic LONG, other LONG")
    terms = counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    ratio = (F.col("toxic") / (n_toxic + 1)) / ((F.col("other") + 0.2) / (n_other + 1))
    telling = terms.where((F.col("toxic") >= MIN_TEXTS) & (ratio >= MIN_RATIO))
    best = telling.orderBy(F.desc("toxic"), "term").limit(max_terms).collect()
    lexicon = Lexicon({r["term"]: (r["toxic"], r["other"]) for r in best}, n_toxic, n_other)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            label, text = (c.to_pylist() for c in batch.columns)
            found = [features(*matched(t, lexicon, y)) for y, t in zip(label, text)]
            cells = [[min(int(x / WIDTH), BINS - 1) for x in both] for both in found]
            a, b = zip(*cells)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(a, pa.int32()), pa.array(b, pa.int32())],
                names=["label", "a", "b"],
            )

    grid = rows.mapInArrow(binned, "label INT, a INT, b INT").groupBy("a", "b", "label").count()
    return Grammar(lexicon, _logistic([tuple(r) for r in grid.collect()]))


def score(
    docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, score`` of every document."""
    return _scored(ids_and_texts(docs, id_col, text_col), grammar).drop("text")


def score_rows(
    docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, text, rest, score`` of every document."""
    return _scored(packed(docs, id_col, text_col), grammar)


def _scored(rows: DataFrame, grammar: Grammar) -> DataFrame:
    """``rows`` with a score beside them; the text is the second column."""
    sent = rows.sparkSession.sparkContext.broadcast(grammar)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = sent.value
        for batch in slices(batches):
            scores = [grammar.score(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "score"],
            )

    return rows.mapInArrow(scored, T.StructType([*rows.schema]).add("score", "double"))
