import hashlib
import random

import numpy as np
import pytest
from llm_helpers import repeats as brute

from ledgerfold.llm import suffixes
from ledgerfold.llm.common import unpacked
from ledgerfold.llm.suffix_dedup import remove_repeats

W = suffixes.WINDOW


def random_rows(seed, n=120):
    rng = random.Random(seed)
    parts = ["".join(rng.choice("ab ") for _ in range(rng.randint(0, 250))) for _ in range(40)]
    parts += ["For " * 40, "é" * 40, "x" * 70, "\0" * 60]
    rows = []
    for i in range(n):
        text = ""
        for _ in range(rng.randint(0, 5)):
            part = rng.choice(parts)
            at = rng.randint(0, len(part))
            text += part[at : at + rng.randint(0, 150)]
        rows.append((rng.randint(0, 10**6), text))
    return rows


def found(df):
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(make_docs, seed):
    rows = random_rows(seed)
    got = found(remove_repeats(make_docs(rows).repartition(4), keep_text=False))
    assert got == brute([(i, t.encode()) for i, t in rows])


def test_odd_rows_and_clashing_names(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    cut = remove_repeats(docs)
    assert found(cut) == brute([(i, (t or "").encode()) for i, t in odd_rows])
    kept = cut.select(*unpacked(cut, docs)).collect()
    assert cut.select(*unpacked(cut, docs)).dtypes == docs.dtypes
    assert {(r.batch, r.rest, r["a b.c"]) for r in kept} == {(7, "r", "x")}
    texts = {r.doc_id: r.text for r in kept}
    assert texts[8] is None and texts[7] == "" and texts[12] == ""
    assert texts[19].endswith("tail of its own") and len(texts[19]) < 60


def test_spans_say_what_was_removed(make_docs, odd_rows):
    by_id = {i: (t or "").encode() for i, t in odd_rows}
    for row in remove_repeats(make_docs(odd_rows)).collect():
        assert sum(s.end - s.start for s in row.spans) == row.n_removed
        left, at = b"", 0
        for span in row.spans:
            left += by_id[row.doc_id][at : span.start]
            at = span.end
        left += by_id[row.doc_id][at:]
        assert hashlib.sha256(left).hexdigest() == row.kept_sha256


def test_empty_table(make_docs):
    assert remove_repeats(make_docs([])).collect() == []


def test_texts_are_read_from_one_shuffle(spark, make_docs, plan):
    df = remove_repeats(make_docs(random_rows(3)), keep_text=False)
    df.collect()
    assert plan(df).split("Initial Plan")[0].count("ReusedExchange") == 2


def test_owners_cover_every_window_once_across_chunks(monkeypatch):
    rng = np.random.default_rng(5)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    ends = np.array([40, 90, 90, 2500, 5000])
    whole = suffixes.owners(data, ends)
    monkeypatch.setattr(suffixes, "CHUNK", 64)
    pieces = suffixes.owners(data, ends)
    assert np.array_equal(whole.start, pieces.start) and np.array_equal(whole.count, pieces.count)
    assert whole.count.sum() == 1 + (2500 - 90 - W + 1) + (2500 - W + 1)
    assert ((whole.start - whole.window >= 0) & (whole.start - whole.window <= W - 16)).all()


def test_family_of_many_levels_equals_one_merge():
    rng = np.random.default_rng(6)
    pool = rng.integers(0, 2, (60, suffixes.RECORD)).astype(np.uint8)
    pool[:, suffixes.BEFORE : suffixes.BEFORE + 16] = pool[0, 34:50]
    pool[:, suffixes.SPAN] = 10
    pool[:, suffixes.SPAN + 1] = 7
    pool[:, suffixes.SPAN + 2 :] = 0
    parts = []
    for number in range(30):
        rows = pool[rng.choice(60, 5, replace=False)]
        parts.append(
            suffixes.Suffixes(rows, rng.permutation(1000)[:5], np.arange(5) + 5 * number)
        )

    def windows(batch):
        family = suffixes.Family(batch)
        for part in parts:
            family.add(part)
        return {(t, w + i) for t, w, n in family.matches().tolist() for i in range(n)}

    assert windows(1) == windows(12) == windows(10**6) != set()


def test_rows_with_one_hash_are_told_apart():
    rows = np.array([[1], [2], [1], [2], [3]], np.uint8)
    order = np.arange(5)
    same = suffixes.alike(rows, np.zeros(5, np.uint64), order)
    assert rows[order][:, 0].tolist() == [1, 1, 2, 2, 3]
    assert same.tolist() == [False, True, False, True, False]
