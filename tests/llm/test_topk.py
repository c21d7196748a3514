import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerfold.llm import mtree, topk


def brute(rows, k=5, asked=lambda i: i % 5 == 0):
    ids = [i for i, _ in rows]
    values = np.array([v for _, v in rows])
    out = set()
    for i in sorted({i for i in ids if asked(i)}):
        own = values[ids.index(i)]
        scored = {(-int(values[j] @ own), ids[j]) for j in range(len(ids)) if ids[j] != i}
        out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(scored)[:k])}
    return out


def answers(spark, rows, cell, k=5):
    schema = "vec_id LONG, embedding ARRAY<DOUBLE>, score STRING, vector INT"
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], schema)
    vectors = topk.whole_vectors(df, scale=256)
    return {tuple(r) for r in topk.top_k(vectors, F.col("vec_id") % 5 == 0, k, cell).collect()}


@pytest.mark.parametrize("cell", [40, 10**6])
def test_equals_brute_force_with_copies_and_ties(spark, cell):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(30, 8)).round(1)
    picked = base[rng.integers(0, 30, 400)]
    picked[:150] += rng.normal(scale=0.2, size=(150, 8))
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(1000)[:400], picked)]
    whole = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows]
    assert answers(spark, rows, cell) == brute(whole)


def test_a_cell_meets_its_queries_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES", 3)
    rng = np.random.default_rng(7)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(120, 4)).round(1))]
    whole = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows]
    assert answers(spark, rows, 50) == brute(whole)


@pytest.mark.parametrize("size", [9.0e6, 1e9, 5e14 / 256])
def test_large_components(spark, size):
    """Numbers beyond 32 bits, and products beyond what a double holds exactly."""
    rng = np.random.default_rng(4)
    rows = [(i, (v * size).tolist()) for i, v in enumerate(rng.normal(size=(60, 4)))]
    rows += [(i + 60, (np.array(v) + rng.integers(0, 3, 4)).tolist()) for i, v in rows[:30]]
    whole = [(i, np.array([int(x) for x in np.floor(256 * np.array(v))], object)) for i, v in rows]
    scores = {i: sorted(((-int(v @ w), j) for j, w in whole if j != i))[:5] for i, v in whole if i % 5 == 0}
    want = {(i, n + 1, j, -s) for i, found in scores.items() for n, (s, j) in enumerate(found)}
    if max(abs(r[3]) for r in want) < 2**63:
        assert answers(spark, rows, 40) == want
    else:
        with pytest.raises(Exception, match="does not fit"):
            answers(spark, rows, 40)


def test_a_component_beyond_64_bits_raises(spark):
    with pytest.raises(Exception, match="does not fit"):
        answers(spark, [(0, [1e300]), (1, [1.0])], 10)


def test_odd_vectors(spark):
    good = [(i, [float(i), 1.0]) for i in range(8)]
    odd = [(20, None), (25, []), (30, [1.0, None]), (35, [float("nan"), 1.0])]
    odd += [(40, [float("inf"), 1.0]), (45, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    whole = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in good]
    assert answers(spark, good + odd, 3) == brute(whole)


def test_fewer_candidates_and_empty_table(spark):
    assert answers(spark, [(0, [1.0]), (1, [2.0]), (5, [0.5])], 10) == {
        (0, 1, 1, 131072),
        (0, 2, 5, 32768),
        (5, 1, 1, 65536),
        (5, 2, 0, 32768),
    }
    assert answers(spark, [(0, [1.0])], 10) == set()
    assert answers(spark, [], 10) == set()


def test_tree_computes_fewer_distances_than_there_are():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * 100
    values = np.unique(np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) * 4), axis=0)
    norms = (values * values).sum(axis=1)
    longest = float(norms.max())
    pages, centre, reach = mtree.build(values, longest)
    ids = [[i] for i in range(len(values))]
    flat, at = [], {}
    for page in pages:
        if page.leaf:
            at[page.number] = len(flat)
            flat += [ids[i] for i in page.below]
            page.below = np.arange(at[page.number], len(flat))
    assert sorted(i for one in flat for i in one) == list(range(len(values)))
    tree = {page.number: page for page in pages}
    computed = 0
    for query in values[::200]:
        best = mtree.Best(6)
        computed += mtree.search(tree, query, best, flat, longest)
        want = sorted(zip((-(values @ query)).astype(int).tolist(), range(len(values))))[:6]
        assert sorted(best.found) == want
    assert computed < 0.5 * len(values) * len(values[::200])


def test_radii_cover_their_subtrees():
    rng = np.random.default_rng(4)
    values = np.floor(rng.normal(size=(1500, 6)) * 50)
    longest = float((values * values).sum(axis=1).max())
    pages = {p.number: p for p in mtree.build(values, longest)[0]}

    def members(number):
        page = pages[number]
        if page.leaf:
            return page.vectors
        return np.concatenate([members(int(b)) for b in page.below])

    for page in pages.values():
        if not page.leaf:
            for vector, radius, below in zip(page.vectors, page.radius, page.below):
                assert mtree.distances(vector, members(int(below)), longest).max() <= radius + 1e-6
