"""The registered queries on the driver's tables, against plain versions or their SQL."""

import zlib
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from llm_helpers import base_counts, fingerprint, labels, repeats
from tokenizers import Tokenizer

from ledgerfold.llm.queries import QUERIES, SQL, tokenizer
from workload.check import connect, differs

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")


def read(sf_dir, name, columns):
    return duckdb.connect().execute(f"SELECT {columns} FROM '{sf_dir}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module")
def texts():
    return dict(read(SMALL, "documents", "doc_id, text"))


def result(spark, name, sf_dir=SMALL):
    return QUERIES[name](spark, sf_dir).collect()


def held_out(doc_id, folds, fold):
    return zlib.crc32(str(doc_id).encode()) % folds == fold


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
@pytest.mark.parametrize("sf_dir", [SMALL, LARGER])
def test_equals_its_sql(spark, name, sf_dir, monkeypatch):
    import workload.check as check

    monkeypatch.setattr(check, "QUERIES", QUERIES)
    monkeypatch.setattr(check, "SQL", SQL)
    assert differs(spark, connect(sf_dir), sf_dir, name) == ""


def test_op1(spark, texts):
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    got = sorted((tuple(r[c] for c in columns) for r in result(spark, "op1_suffix_dedup")), key=repr)
    assert got == repeats([(i, (t or "").encode()) for i, t in texts.items()])


def test_op2(spark, texts):
    library = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for p in result(spark, "op2_packing"):
        pieces[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    assert set(pieces) == set(texts)
    n_tokens = 0
    for i, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for p in sorted(pieces[i], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            at += p.length
            assert p.ids_crc32 == zlib.crc32(ids[p.start : at].tobytes())
        assert at == len(ids)
        n_tokens += at
    for members in sequences.values():
        at = 0
        for p in sorted(members, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096
    assert len(sequences) == -(-n_tokens // 4096)


def test_op4(spark, texts):
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = result(spark, "op4_quality_rules")
    assert {r.doc_id: tuple(r[c] for c in columns) for r in rows} == {
        i: base_counts(t) for i, t in texts.items()
    }
    quality = dict(read(SMALL, "labels", "doc_id, quality"))
    clean = [r.kept for r in rows if quality.get(r.doc_id) == 1 and not r.base_failed]
    junk = [r.kept for r in rows if quality.get(r.doc_id) == 0]
    assert np.mean(clean) > 0.97 and np.mean(junk) < 0.3


def test_op5(spark, texts):
    ids = sorted(texts)
    fps = [fingerprint(texts[i]) for i in ids]
    want = labels(ids, fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in result(spark, "op5_simhash")}
    assert got == {i: (f"{fps[k]:016x}", want[k]) for k, i in enumerate(ids)}


def test_op8(spark, texts):
    library = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    got = {r.doc_id: tuple(r)[1:] for r in result(spark, "op8_token_counts")}
    for i, text in texts.items():
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert got.pop(i) == (len((text or "").encode()), n, n > 1024)
    assert not got


def test_op7(spark):
    lang = dict(read(LARGER, "documents", "doc_id, lang"))
    rows = result(spark, "op7_language_id", LARGER)
    assert len(rows) == len(lang)
    assert all(r.held_out == held_out(r.doc_id, 3, 1) and 0 <= r.score <= 1 for r in rows)
    unseen = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out and lang[r.doc_id]]
    assert np.mean(unseen) > 0.98


@pytest.mark.parametrize(
    ("name", "label", "folds", "fold", "bar"),
    [("op9_toxicity", "toxic", 3, 1, 0.7), ("op10_quality_classifier", "quality", 5, 0, 0.3)],
)
def test_op9_and_op10(spark, name, label, folds, fold, bar):
    known = dict(read(LARGER, "labels", f"doc_id, {label}"))
    rows = result(spark, name, LARGER)
    assert len(rows) == len(read(LARGER, "documents", "doc_id"))
    assert all(r.held_out == held_out(r.doc_id, folds, fold) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= bar) for r in rows)
    unseen = [(known[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in known]
    assert np.mean([y == p for y, p in unseen]) > 0.93
    # Clean documents are left alone.
    clean = 0 if label == "toxic" else 1
    assert np.mean([p == clean for y, p in unseen if y == clean]) > 0.97
