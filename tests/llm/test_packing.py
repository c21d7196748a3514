import random
import subprocess
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerfold.llm import packing
from ledgerfold.llm.common import slices
from ledgerfold.llm.queries import tokenizer

PATH = tokenizer("word_bpe_49k.json")


@given(st.lists(st.integers(1, 9000), max_size=60))
@settings(max_examples=60, deadline=None)
def test_every_token_is_in_one_piece_and_little_is_padding(lengths):
    lengths = sorted(lengths, reverse=True)
    pieces = packing.assign(lengths)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for document, start, length, sequence, offset in pieces:
        assert length > 0
        by_doc[document].append((start, length))
        by_sequence[sequence].append((offset, length))
    for document, length in enumerate(lengths):
        assert _ends(by_doc[document]) == length
    filled = [_ends(parts) for parts in by_sequence.values()]
    assert all(n <= packing.SEQUENCE for n in filled)
    assert len(filled) == -(-sum(lengths) // packing.SEQUENCE)


def _ends(parts):
    at = 0
    for start, length in sorted(parts):
        assert start == at
        at += length
    return at


def test_costs_are_balanced():
    pieces = packing.assign(sorted([100] * 400 + [2000] * 20, reverse=True))
    cost = defaultdict(float)
    for _, _, n, sequence, _ in pieces:
        cost[sequence] += n + n * n / packing.HORIZON
    # In order of arrival, some sequences would hold long documents only.
    assert max(cost.values()) < 1.6 * np.mean(list(cost.values()))


def test_ids_are_the_librarys(make_docs, odd_rows):
    library = Tokenizer.from_file(PATH)
    rows = [(k, t) for k, (_, t) in enumerate(odd_rows)]
    rows += [(100, "a <|endoftext|>b <|startoftext|>"), (101, "ΑΣ ΑΣ. İstanbul ﬁ 123abc's")]
    want = {
        i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        for i, t in rows
    }
    got = defaultdict(list)
    for p in packing.pack(make_docs(rows), PATH, end_id=2).collect():
        got[p.doc_id].append(p)
    assert set(got) == set(want)
    for i, pieces in got.items():
        assert _ends([(p.start, p.length) for p in pieces]) == len(want[i])
        for p in pieces:
            part = want[i][p.start : p.start + p.length]
            assert (p.ids_crc32, p.doc_tokens) == (zlib.crc32(part.tobytes()), len(want[i]))


def test_windows_and_repeated_rows(make_docs, odd_rows):
    whole = packing.pack(make_docs(odd_rows).repartition(3), PATH, 2, window_tokens=500).collect()
    sequences = defaultdict(list)
    for p in whole:
        sequences[p.sequence_id].append((p.offset, p.length))
    assert all(_ends(parts) <= packing.SEQUENCE for parts in sequences.values())
    assert sum(p.doc_id == 11 and p.start == 0 for p in whole) == 2
    assert sum(p.doc_id is None and p.start == 0 for p in whole) == 1


@pytest.mark.parametrize(("parts", "window", "together"), [(1, 5000, 1024), (40, 10**6, 1024), (40, 9000, 8)])
def test_padding_does_not_follow_the_splits(make_docs, parts, window, together):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["river", "stone", "of"], k=rng.randint(0, 900)))) for i in range(300)]
    docs = make_docs(rows).repartition(parts)
    pieces = packing.pack(docs, PATH, 2, window_tokens=window, together=together).collect()
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id].append((p.start, p.length))
    assert {i: _ends(parts) for i, parts in by_doc.items()} == {
        i: len(t.split()) + 1 for i, t in rows
    }
    filled = [_ends(parts) for parts in sequences.values()]
    assert max(filled) <= packing.SEQUENCE
    # Less than one sequence for each group of tasks.
    groups = -(-parts // together)
    assert len(filled) * packing.SEQUENCE - sum(filled) < groups * packing.SEQUENCE


def test_ids_when_little_is_remembered(monkeypatch):
    library = Tokenizer.from_file(PATH)
    monkeypatch.setattr(packing, "WORDS", 5)
    encoder = packing.WordEncoder(PATH)
    texts = ["one two three four five six seven", "eight nine", "", "one two"]
    got = [ids.tolist() for ids in encoder.encode([t.encode() for t in texts])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_empty_table(make_docs):
    assert packing.pack(make_docs([]), PATH, 2).collect() == []


#: Encodes a batch of 16 MB, as a worker gets it, and prints by how many MB memory rose.
GROWTH = """
import random, re, sys
from pathlib import Path
import pyarrow as pa
from ledgerfold.llm import packing

def mb(name):
    return int(re.search(name + r":\\s+(\\d+)", Path("/proc/self/status").read_text())[1]) / 1024

rng = random.Random(5)
words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(30_000)]
texts = [" ".join(rng.choices(words, k=1500)) for _ in range(1800)]
batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
del texts
encoder = packing.WordEncoder(sys.argv[1])
before = mb("VmRSS")
documents = list(packing.encoded(iter([batch]), encoder, 2))
held = sum(ids.nbytes for _, ids in documents) / 2**20
print(mb("VmHWM") - before - held)
"""


def test_encoding_takes_little_memory_beside_the_ids():
    run = [sys.executable, "-c", GROWTH, PATH]
    root = Path(packing.__file__).parents[2]
    out = subprocess.run(run, cwd=root, capture_output=True, text=True, check=True).stdout
    assert float(out) < 100


def test_slices_are_of_the_size_asked_for():
    texts = ["x" * n for n in (400, 700, 10, 5000, 0, 990)] + [None]
    batch = pa.record_batch([pa.array(range(7)), pa.array(texts)], names=["doc_id", "text"])
    parts = list(slices(iter([batch]), size=1000))
    assert [p.num_rows for p in parts] == [1, 2, 1, 3]
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
