"""The tree of openings against one built by hand."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from llm_helpers import WORD

from ledgerfold.llm.conversation_trie import grafted, ordered_turns, prefix_trie

SCHEMA = "conv_id LONG, turn LONG, role STRING, text STRING, depth INT, k1 STRING, path STRING, `a b.c` INT"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", "p", 2) for r in rows], SCHEMA)


def rebuilt(rows, every, most):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            item = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append(((turn is not None, turn or 0, role, item), (role, text)))
    own = {c: [t for _, t in sorted(ts)] for c, ts in turns.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % most
        out[c] = own.get(c - c % every, [])[:h] + own[c][h:]
    return out


def by_hand(rows, every=20, most=4):
    whole = rebuilt(rows, every, most)
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        childless = [n for n in below if not any(m[:-1] == n and m for m in members)]
        saved = sum(
            (len(members[n]) - 1) * len(re.findall(WORD, n[-1][1])) for n in below if n
        )
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(node))
        out.append(
            (
                min(convs),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(convs),
                sum(len(n) == len(node) + 1 for n in below),
                len(childless),
                saved,
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def found(spark, rows, every=20, most=4, **sizes):
    turns, lengths = ordered_turns(table(spark, rows))
    got = prefix_trie(grafted(turns, lengths, every, most), **sizes)
    return sorted((tuple(r) for r in got.collect()), key=repr)


def openings(rng, n, length, words):
    """Conversations that share openings, as they choose their turns among few."""
    return [
        (c, t, "user" if t % 2 else "assistant", " ".join(rng.choices("ab", k=words)))
        for c in rng.sample(range(10 * n), n)
        for t in range(rng.randint(1, length))
    ]


@pytest.mark.parametrize(("band", "block"), [(1, 1), (2, 4), (3, 6), (32, 1024)])
def test_equals_by_hand(spark, band, block):
    rows = openings(random.Random(band), 60, 9, 1)
    random.Random(1).shuffle(rows)
    assert found(spark, rows, band=band, block=block) == by_hand(rows)


def test_bands_and_blocks_of_deep_conversations(spark):
    rng = random.Random(5)
    rows = []
    for c in range(8):
        shared = rng.randint(0, 60)
        rows += [(c, t, "u", f"turn {t}" if t < shared else f"own {c} {t}") for t in range(70)]
    assert found(spark, rows, band=4, block=8) == by_hand(rows)


def test_one_conversation_in_many_tasks(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(40, t, "u", f"turn {t}") for t in range(300)]
        rows += [(41, t, "u", f"turn {t}") for t in range(20)]
        turns, sizes = ordered_turns(table(spark, rows).repartition(5))
        assert turns.select("k").where("conv = 40").distinct().count() == 300
        assert {tuple(r) for r in sizes.collect()} == {(40, 300), (41, 20)}
        assert found(spark, rows, band=8, block=64) == by_hand(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_many_copies_of_one_conversation(spark):
    rows = [(c, t, "u", f"same {t}") for c in range(1500) for t in range(4)]
    rows += [(c, t, "u", f"other {c} {t}") for c in range(1500, 1530) for t in range(4)]
    assert found(spark, rows) == by_hand(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "no id"),
        (1, None, "user", "null turn first"),
        (1, 0, None, None),
        (1, 0, "", ""),
        (1, 1, "user", "same"),
        (1, 1, "user", "same"),
        (1, 1, "system", "same"),
        (20, 0, "user", "word " * 50_000),
        (20, 1, "a", ":b"),
        (25, 0, "user", "x\t\n\x0by \x0c\r z é"),
        (23, 0, "user", "one turn"),
        (300, 0, "user", "no base turns"),
        (301, 0, "user", "turnless, if its one turn is replaced by a short base"),
        (345, 0, "user", "base is not there"),
        (346, 7, "user", "base is not there"),
        (347, 7, "user", "base is not there"),
    ]
    assert found(spark, rows) == by_hand(rows)
    assert any(not turns for turns in rebuilt(rows, 20, 4).values())


def test_roles_and_texts_do_not_run_together(spark):
    rows = [(60, 0, "a", "bc"), (80, 0, "ab", "c"), (100, 0, "", "abc")]
    assert len(found(spark, rows)) == 4


def test_no_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 0, "user", "no id")]) == []


def test_a_block_holds_whole_bands(spark):
    turns, sizes = ordered_turns(table(spark, []))
    with pytest.raises(ValueError):
        prefix_trie(grafted(turns, sizes, 20, 4), band=3, block=8)
