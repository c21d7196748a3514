"""Quality classifier: regularised quadratic discriminant over document statistics.

A document becomes a dozen statistics, put on scales on which they are near normal.
Per class, mean and covariance are learned; a covariance is shrunk towards that of
both classes, and then towards a multiple of the identity. A score is the logistic of
the difference of log densities, in which the squared Mahalanobis distances come from
Cholesky factors computed once and sent to all tasks.

Scale: learning takes sums of the statistics and of their products, per class, from a
sample of labelled documents (``SAMPLE``, chosen by a hash of the id; the table of
their labels is what is sent to all tasks, some 12 bytes each). Scoring is a scan.

Edge cases: null, empty and blank texts have all statistics zero, and a score like any
other; texts of any length are read whole; labels that are null are not learned from;
an id that ``labels`` repeats counts once; with no labels of one of the classes, scores are the share of the other
(0.5 without any); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import as_bytes, ids_and_texts, sample_by_hash, slices
from ledgerfold.llm.quality_rules import count

#: Labelled documents that are learned from, about.
SAMPLE = 20_000

STATISTICS = [
    "length",
    "symbols",
    "capitals",
    "repeated_windows",
    "repeated_lines",
    "vocabulary",
    "top_word",
    "word_length",
    "sentence_ends",
    "lines",
    "digits",
    "marks",
]

_DIGITS = b"0123456789"
_MARKS = b"!?,;:()[]{}\"'"


def statistics(text: bytes | None) -> list[float]:
    """The statistics of a text, in the order of ``STATISTICS``."""
    text = text or b""
    c = count(text)
    if not c.n_words:
        return [0.0] * len(STATISTICS)
    # Shares are taken as if twenty usual words and one line stood there besides, so
    # that a text of few words is not far from all others.
    words, lines, letters = c.n_words + 20, c.n_lines + 1, c.n_upper + c.n_lower + 100
    digits = len(text) - len(text.translate(None, _DIGITS))
    marks = len(text) - len(text.translate(None, _MARKS))
    return [
        np.log1p(c.n_words),
        np.log1p(20 * c.n_symbols / words),
        np.log1p(10 * c.n_upper / letters),
        np.log1p(10 * c.n_repeat_words / words),
        np.log1p(10 * c.n_dup_lines / lines),
        np.log((c.n_distinct + 15) / words),
        np.log((c.top_word + 2) / words),
        np.log((c.word_chars + 100) / words),
        np.log1p(20 * (c.n_ends + 2) / words),
        np.log1p(100 * lines / words),
        np.log1p(20 * digits / words),
        np.log1p(20 * marks / words),
    ]


@dataclass(frozen=True)
class Discriminant:
    """Means and Cholesky factors of both classes, and the log odds of class 1."""

    means: tuple[np.ndarray, np.ndarray] | None
    factors: tuple[np.ndarray, np.ndarray] | None
    log_odds: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        difference = np.full(len(x), self.log_odds)
        if self.means is not None:
            for sign, mean, factor in zip((-1, 1), self.means, self.factors):
                z = np.linalg.solve(factor, (x - mean).T)
                log_density = -0.5 * (z * z).sum(axis=0) - np.log(np.diag(factor)).sum()
                difference += sign * log_density
        return 1 / (1 + np.exp(-np.clip(difference, -500, 500)))


def fitted(
    sums: dict[int, tuple[float, np.ndarray, np.ndarray]],
    to_pooled: float = 0.1,
    to_identity: float = 0.01,
) -> Discriminant:
    """From per class count, sums, and sums of products."""
    n = [sums.get(c, (0.0,))[0] for c in (0, 1)]
    log_odds = float(np.log((n[1] + 0.5) / (n[0] + 0.5)))
    if not all(n):
        return Discriminant(None, None, log_odds)
    size = len(STATISTICS)
    means = [sums[c][1] / sums[c][0] for c in (0, 1)]
    scatter = [sums[c][2] - sums[c][0] * np.outer(m, m) for c, m in zip((0, 1), means)]
    pooled = (scatter[0] + scatter[1]) / (n[0] + n[1])
    factors = []
    for c in (0, 1):
        # A class with few documents leans on both classes together.
        own = to_pooled + (1 - to_pooled) * size / (size + n[c])
        shrunk = (1 - own) * scatter[c] / n[c] + own * pooled
        level = np.trace(shrunk) / size + 1e-6
        shrunk = (1 - to_identity) * shrunk + to_identity * level * np.eye(size)
        factors.append(np.linalg.cholesky(shrunk))
    return Discriminant((means[0], means[1]), (factors[0], factors[1]), log_odds)


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
) -> Discriminant:
    """Learns from documents that ``labels`` (one row per document) marks 0 or 1."""
    chosen = sample_by_hash(labels, id_col, label_col, sample)
    rows = ids_and_texts(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text=0):
            x = np.array([statistics(t) for t in as_bytes(batch.column(0))])
            columns = [pa.array(column) for column in x.reshape(-1, len(STATISTICS)).T]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), *columns], names=["label", *STATISTICS]
            )

    schema = ", ".join(["label INT", *[f"{name} DOUBLE" for name in STATISTICS]])
    x = rows.select("text", "label").mapInArrow(measured, schema)
    size = range(len(STATISTICS))
    products = [
        F.sum(F.col(STATISTICS[i]) * F.col(STATISTICS[j])).alias(f"p_{i}_{j}")
        for i in size
        for j in size
        if i <= j
    ]
    totals = [F.sum(name).alias(f"s_{i}") for i, name in enumerate(STATISTICS)]
    found = x.groupBy("label").agg(F.count(F.lit(1)).alias("n"), *totals, *products).collect()
    sums = {}
    for row in found:
        product = [[row[f"p_{min(i, j)}_{max(i, j)}"] for j in size] for i in size]
        total = np.array([row[f"s_{i}"] for i in size])
        sums[row["label"]] = (float(row["n"]), total, np.array(product))
    return fitted(sums)


def score(
    docs: DataFrame, model: Discriminant, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, score`` of every document."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = np.array([statistics(text) for text in as_bytes(batch.column(1))])
            x = x.reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.scores(x))], names=["doc_id", "score"]
            )

    return ids_and_texts(docs, id_col, text_col).mapInArrow(scored, "doc_id LONG, score DOUBLE")
