import random

import pytest
from llm_helpers import sentence

SCHEMA = (
    "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, "
    # Names that the operators use inside.
    "batch INT, score DOUBLE, rest STRING, votes STRING, fp LONG, epoch INT, label INT, "
    "domain STRING, n_tokens LONG, `a b.c` STRING"
)

@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents of ``(doc_id, text)``, with the other columns and clashing names."""

    def make(rows):
        full = [
            (i, t, "en", f"src{(i or 0) % 3}", len(t or ""), 7, 0.5, "r", "v", 1, 2, 3, "d", 4, "x")
            for i, t in rows
        ]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, copies, and a very long text."""
    rng = random.Random(3)
    long = "\n".join(sentence(rng, 12) for _ in range(3000))
    text = "\n".join(sentence(rng, 9) for _ in range(6))
    near = text.replace("river", "rivers", 1)
    return [
        (7, ""),
        (8, None),
        (9, " \n\t \r\n"),
        (10, "Short."),
        (11, text),
        (11, text),
        (12, text),
        (13, near),
        (None, text),
        (14, long),
        (15, "x" * 300),
        (16, "é" * 100 + " ÀÉ ñ"),
        (17, "a  b\n\n c \t d"),
        (18, "the " * 200),
        (19, text + "\n" + "tail of its own"),
        (20, "\x00 zero \x01 bytes \x1f here"),
        (21, "12 34 !!"),
    ]
