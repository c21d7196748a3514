"""Language identification by prediction by partial matching.

Per language, a context tree over bytes: how often each byte followed each context of
up to ``ORDER`` bytes. A byte seen in its context costs the logarithm of its share;
one not seen costs an escape to the next shorter context (method C: an escape counts
once per distinct byte seen in the context), down to one chance in 256. A context the
language has never seen costs nothing to leave. The statistics are frozen: a text's
code length is the sum over its bytes, and the language with the shortest one wins.

Scale: every training text is counted, whole; counts of distinct byte strings are
combined per task before the shuffle. A tree of up to ``MAX_GRAMS`` leaves is sent to
all tasks, and scoring is a scan. A larger one is a stored table of costs: the distinct
strings of the texts are joined to it level by level, and the strings of each text,
counted, to what was found, which gives the same code lengths. A shorter order is only
taken where the caller asks for a tree of a certain size.

Edge cases: texts that are null or have no letter are ``und`` with score 0, and so is
every text if there is nothing to learn from; equal code lengths go to the language
first by name; texts of any length are read whole; repeated rows count as often as they
come; an empty table gives an empty result. ``held_out`` of the query is null without an id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import as_bytes, ids_and_texts, packed, slices
from ledgerfold.session import land

ORDER = 3
MAX_GRAMS = 4_000_000

#: A model that would take more bytes than this in a task is stored as well.
SENT_BYTES = 256 * 1024 * 1024

#: Bytes looked up in one go.
CHUNK = 1 << 20

_LETTERLESS = "und"


def byte_strings(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """At each byte, it and the ``order`` bytes before it as a number, and the text it is in.

    Before a text's first byte there are zero bytes.
    """
    data = np.frombuffer(bytes(order).join([b"", *texts]), np.uint8)
    numbers = data.astype(np.uint32)
    for back in range(1, order + 1):
        numbers[back:] |= data[:-back].astype(np.uint32) << np.uint32(8 * back)
    sizes = np.array([len(text) for text in texts], np.int64)
    row = np.repeat(np.arange(len(texts)), sizes)
    return numbers[np.arange(len(row)) + (row + 1) * order], row


def gram_counts(
    docs: DataFrame, order: int, lang_col: str, id_col: str, text_col: str
) -> DataFrame:
    """``lang, gram, n``: how often each string of ``order + 1`` bytes ends in a language."""
    rows = packed(docs, id_col, text_col)
    rows = rows.select(F.col("rest")[lang_col].cast("string").alias("lang"), "text")
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")

    def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in slices(batches):
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                numbers, _ = byte_strings(texts, order)
                parts = held.setdefault(lang, [])
                parts.append(np.unique(numbers, return_counts=True))
                if len(parts) == 8:
                    held[lang] = [_added(parts)]
        for lang, parts in held.items():
            grams, n = _added(parts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(grams), pa.string()),
                    pa.array(grams, pa.int64()),
                    pa.array(n, pa.int64()),
                ],
                names=["lang", "gram", "n"],
            )

    counted = rows.mapInArrow(counting, "lang STRING, gram LONG, n LONG")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(where, np.concatenate([n for _, n in parts])).astype(np.int64)


@dataclass
class _Level:
    """Strings of one length: costs of the last byte, and of leaving the bytes before it."""

    grams: np.ndarray
    costs: np.ndarray  # gram, language
    contexts: np.ndarray
    escapes: np.ndarray  # context, language


class Model:
    """Code lengths of bytes in all languages, from counts of strings of ``order + 1`` bytes."""

    def __init__(self, order: int, counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        self.languages = sorted(counts)
        self.order = order
        self._levels: list[_Level] = []
        for length in range(order + 1):
            self._levels.append(self._level(length, counts))

    def _level(self, length: int, counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> _Level:
        mask = np.uint32((1 << (8 * (length + 1))) - 1)
        ends = {
            lang: _added([((grams.astype(np.uint32) & mask), n)])
            for lang, (grams, n) in counts.items()
        }
        grams = np.unique(np.concatenate([g for g, _ in ends.values()]))
        contexts, context = np.unique(grams >> np.uint32(8), return_inverse=True)
        # What a byte costs that has not been seen in its context.
        if length:
            costs = self._costs(grams & (mask >> np.uint32(8)), length - 1)
        else:
            costs = np.full((len(grams), len(ends)), 8.0)
        escapes = np.zeros((len(contexts), len(ends)))
        for column, lang in enumerate(self.languages):
            own, n = ends[lang]
            at = np.searchsorted(grams, own)
            times = np.bincount(context[at], n, len(contexts))
            kinds = np.bincount(context[at], minlength=len(contexts))
            seen = times > 0
            total = (times + kinds)[seen]
            escapes[seen, column] = np.log2(total / kinds[seen])
            costs[:, column] += escapes[context, column]
            costs[at, column] = np.log2((times + kinds)[context[at]] / n)
        return _Level(grams, costs, contexts, escapes)

    def _costs(self, grams: np.ndarray, length: int) -> np.ndarray:
        if length < 0:
            return np.full((len(grams), len(self.languages)), 8.0)
        level = self._levels[length]
        at = np.searchsorted(level.grams, grams)
        at[at == len(level.grams)] = 0
        known = level.grams[at] == grams
        costs = level.costs[at]
        if not known.all():
            new = grams[~known]
            shorter = self._costs(new & np.uint32((1 << (8 * length)) - 1), length - 1)
            before = new >> np.uint32(8)
            at = np.searchsorted(level.contexts, before)
            at[at == len(level.contexts)] = 0
            left = np.where((level.contexts[at] == before)[:, None], level.escapes[at], 0.0)
            costs[~known] = shorter + left
        return costs

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language."""
        numbers, row = byte_strings(texts, self.order)
        bits = np.zeros((len(texts), len(self.languages)))
        for at in range(0, len(numbers), CHUNK):
            costs = self._costs(numbers[at : at + CHUNK], self.order)
            first = int(row[at])
            here = row[at : at + CHUNK] - first
            for column in range(len(self.languages)):
                sums = np.bincount(here, costs[:, column])
                bits[first : first + len(sums), column] += sums
        return bits


def _end(column: Column, length: int) -> Column:
    """The last ``length + 1`` bytes of a string."""
    return column.bitwiseAND(F.lit((1 << (8 * (length + 1))) - 1))


def _shorter(counts: DataFrame, length: int) -> DataFrame:
    """Counts of the last ``length + 1`` bytes."""
    ends = counts.select("lang", _end(F.col("gram"), length).alias("gram"), "n")
    return ends.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class StoredModel:
    """A tree too large to send. Per length of string, costs by gram and escapes by context,
    each a map from the languages that have seen it."""

    languages: list[str]
    order: int
    levels: list[tuple[DataFrame, DataFrame]]


def stored(counts: DataFrame, order: int) -> StoredModel:
    """The model of counts of strings of ``order + 1`` bytes, as tables."""

    def by_lang(bits: Column) -> Column:
        return F.map_from_entries(F.collect_list(F.struct("lang", bits)))

    levels = []
    for length in range(order + 1):
        own = counts if length == order else _shorter(counts, length)
        own = own.withColumn("context", F.shiftright("gram", 8))
        ends = own.groupBy("lang", "context").agg(
            F.sum("n").alias("times"), F.count("*").alias("kinds")
        )
        ends = land(ends, "contexts")
        total = F.col("times") + F.col("kinds")
        costs = own.join(ends, ["lang", "context"]).groupBy("gram")
        costs = costs.agg(by_lang(F.log2(total / F.col("n"))).alias("cost"))
        escapes = ends.groupBy("context").agg(
            by_lang(F.log2(total / F.col("kinds"))).alias("escape")
        )
        levels.append((land(costs, "costs"), land(escapes, "escapes")))
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    return StoredModel(languages, order, levels)


def train(
    docs: DataFrame,
    lang_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    max_grams: int | None = None,
    sent_grams: int = MAX_GRAMS,
) -> Model | StoredModel | None:
    """The model of all documents that have a language; none if there are none.

    ``max_grams`` asks for the longest order, up to ``order``, with no more strings than
    that. A tree of more than ``sent_grams``, or ``SENT_BYTES``, is stored, not sent.
    """
    counts = land(gram_counts(docs, order, lang_col, id_col, text_col), "grams")
    n_grams = counts.count()
    while max_grams is not None and order > 1 and n_grams > max_grams:
        order -= 1
        counts = land(_shorter(counts, order), "grams")
        n_grams = counts.count()
    # What is sent has a cost of eight bytes for each string in each language.
    sizes = counts.agg(F.count_distinct("gram"), F.count_distinct("lang")).first()
    if n_grams > sent_grams or sizes[0] * sizes[1] * 8 > SENT_BYTES:
        return stored(counts, order)
    found = counts.toArrow().combine_chunks()
    langs = found.column("lang").to_numpy(zero_copy_only=False)
    grams, n = (found.column(c).to_numpy() for c in ("gram", "n"))
    by_lang = {
        str(lang): (grams[langs == lang].astype(np.uint32), n[langs == lang])
        for lang in set(langs.tolist())
    }
    return Model(order, by_lang) if by_lang else None


def _named(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def _string_costs(rows: DataFrame, model: StoredModel) -> DataFrame:
    """``gram, bits``: what each distinct string of the texts costs in each language."""
    order = model.order

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [text.encode() for text in batch.column(1).to_pylist() if _named(text)]
            if not texts:
                continue
            grams = np.unique(byte_strings(texts, order)[0])
            yield pa.RecordBatch.from_arrays([pa.array(grams, pa.int64())], names=["gram"])

    found = rows.mapInArrow(distinct, "gram LONG").distinct()
    for length, (costs, escapes) in enumerate(model.levels):
        end = _end(F.col("gram"), length)
        found = found.withColumns({"end": end, "before": F.shiftright(end, 8)})
        costs = costs.select(F.col("gram").alias("end"), F.col("cost").alias(f"cost_{length}"))
        escapes = escapes.select(
            F.col("context").alias("before"), F.col("escape").alias(f"escape_{length}")
        )
        found = found.join(costs, "end", "left").join(escapes, "before", "left")
        found = found.drop("end", "before")

    def bits(lang: Column) -> Column:
        out = F.lit(8.0)
        for length in range(order + 1):
            left = F.coalesce(F.try_element_at(f"escape_{length}", lang), F.lit(0.0))
            out = F.coalesce(F.try_element_at(f"cost_{length}", lang), out + left)
        return out

    languages = F.array(*map(F.lit, model.languages))
    return found.select("gram", F.transform(languages, bits).alias("bits"))


def _identified_by_tables(rows: DataFrame, model: StoredModel) -> DataFrame:
    """``identify`` by joins: no task holds the tree."""
    order = model.order

    def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            texts = batch.column(2).to_pylist()
            which = np.flatnonzero([_named(text) for text in texts])
            if not len(which):
                continue
            numbers, row = byte_strings([texts[i].encode() for i in which], order)
            pairs = row.astype(np.uint64) << np.uint64(32) | numbers
            pairs, n = np.unique(pairs, return_counts=True)
            for at in range(0, len(pairs), CHUNK):
                part = pairs[at : at + CHUNK]
                of = pa.array(which[(part >> np.uint64(32)).astype(np.int64)])
                grams = (part & np.uint64(0xFFFFFFFF)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(of), batch.column(1).take(of)]
                    + [pa.array(grams), pa.array(n[at : at + CHUNK], pa.int64())],
                    names=["place", "doc_id", "gram", "n"],
                )

    def letterless(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = [_named(text) for text in batch.column(1).to_pylist()]
            yield batch.filter(pa.array(np.logical_not(named))).select(["doc_id"])

    # Ids may repeat or be null: a row is known by its place in the scan.
    placed = rows.select(F.monotonically_increasing_id().alias("place"), "doc_id", "text")
    counted = placed.mapInArrow(counting, "place LONG, doc_id LONG, gram LONG, n LONG")
    judged = counted.join(_string_costs(rows, model), "gram")
    names = [f"bits_{i}" for i in range(len(model.languages))]
    sums = judged.groupBy("place", "doc_id").agg(
        *[F.sum(F.col("n") * F.col("bits")[i]).alias(name) for i, name in enumerate(names)]
    )
    bits = sums.select("doc_id", F.array(*names).alias("bits"))
    bits = bits.withColumn("least", F.array_min("bits"))
    chances = F.transform(
        "bits", lambda b: F.pow(F.lit(2.0), F.greatest(F.col("least") - b, F.lit(-1000.0)))
    )
    languages = F.array(*map(F.lit, model.languages))
    named = bits.select(
        "doc_id",
        F.element_at(languages, F.array_position("bits", F.col("least")).cast("int")).alias(
            "lang_pred"
        ),
        (1 / F.aggregate(chances, F.lit(0.0), lambda a, b: a + b)).alias("score"),
    )
    unnamed = rows.mapInArrow(letterless, "doc_id LONG").select(
        "doc_id", F.lit(_LETTERLESS).alias("lang_pred"), F.lit(0.0).alias("score")
    )
    return named.unionByName(unnamed)


def identify(
    docs: DataFrame,
    model: Model | StoredModel | None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, lang_pred, score``; the score is the language's posterior probability."""
    rows = ids_and_texts(docs, id_col, text_col)
    if isinstance(model, StoredModel):
        return _identified_by_tables(rows, model)
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            named = [bool(model) and _named(text) for text in texts]
            lang, score = [_LETTERLESS] * len(texts), np.zeros(len(texts))
            which = np.flatnonzero(named)
            if len(which):
                bits = model.code_lengths([texts[i].encode() for i in which])
                best = bits.argmin(axis=1)
                least = bits.min(axis=1, keepdims=True)
                score[which] = 1 / np.exp2(np.maximum(least - bits, -1000)).sum(axis=1)
                for i, j in zip(which, best):
                    lang[i] = model.languages[j]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score)],
                names=["doc_id", "lang_pred", "score"],
            )

    return rows.mapInArrow(identified, "doc_id LONG, lang_pred STRING, score DOUBLE")


