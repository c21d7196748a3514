"""Gathering, above all when a key or a mass of copies holds many of the rows."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerfold.operators.gather import push, push_parts
from ledgerfold.operators.nested import lookup, unwind
from ledgerfold.session import land


@pytest.fixture(scope="module")
def df(spark):
    """9,000 rows: a third on one key, a third copies of one row, the rest spread."""
    hot = spark.range(3000).selectExpr("1 AS k", "id AS v")
    copies = spark.range(3000).selectExpr("2 AS k", "7L AS v")
    spread = spark.range(2900).selectExpr("CAST(10 + id % 290 AS INT) AS k", "id AS v")
    keyless = spark.range(100).selectExpr("CAST(NULL AS INT) AS k", "id AS v")
    return land(hot.union(copies).union(spread).union(keyless), "skewed")


def flat(documents):
    return Counter(
        (r["k"], item["v"]) for r in documents.collect() for item in r["items"]
    )


def test_each_key_is_one_sorted_document(df):
    documents = push(df, ["k"], ["v"], "items")
    assert flat(documents) == Counter(tuple(r) for r in df.collect())
    rows = documents.collect()
    assert len(rows) == 293 and documents.columns == ["k", "items"]
    for row in rows:
        values = [item["v"] for item in row["items"]]
        assert values == sorted(values)


def test_a_key_of_any_size_is_one_document(spark):
    for n in (10_000, 10_001, 25_000):
        rows = spark.range(n).selectExpr("1 AS k", "id AS v")
        (row,) = push(rows, ["k"], ["v"], "items").collect()
        assert len(row["items"]) == n


def test_no_job_runs_while_a_plan_is_built(spark, df):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        push(df, ["k"], ["v"], "items")
        lookup(df, df, "k", "k", "found")
        assert not tracker.getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_parts_hold_every_row_and_repeat(df):
    def texts(rows):
        documents = push_parts(rows, ["k"], ["v"], "items", parts=8)
        return sorted(documents.select(F.to_json(F.struct("*"))).toPandas().iloc[:, 0])

    documents = push_parts(df, ["k"], ["v"], "items", parts=8)
    assert documents.columns == ["k", "part", "items"]
    assert flat(documents) == Counter(tuple(r) for r in df.collect())
    parts = Counter(r["k"] for r in documents.collect())
    assert parts[1] == 8 and parts[2] == 1 and max(parts.values()) == 8
    assert texts(df.repartition(1)) == texts(df.repartition(13))


def test_totals_are_of_the_whole_key(df):
    named = df.withColumn("name", F.concat(F.lit("key "), F.col("k")))
    totals = {"name": F.first("name"), "mean": F.avg("v"), "n": F.count("v")}
    documents = push(named, ["k"], ["v"], "items", totals)
    assert documents.columns == ["k", "name", "mean", "n", "items"]
    rows = df.collect()
    for row in documents.collect():
        values = [r["v"] for r in rows if r["k"] == row["k"]]
        assert row["name"] == (f"key {row['k']}" if row["k"] else None)
        assert row["n"] == len(values) and row["mean"] == pytest.approx(sum(values) / len(values))


def test_structs_of_nulls_are_kept(spark):
    df = spark.createDataFrame([(1, None), (1, 2)], "k INT, v INT")
    assert [i["v"] for i in push(df, ["k"], ["v"], "items").head()["items"]] == [None, 2]


def test_lookup_gives_each_left_row_once(spark):
    left = spark.createDataFrame(
        [(1, "a"), (2, "b"), (3, "c"), (None, "d"), (1, "e")], "k INT, name STRING"
    )
    right = spark.createDataFrame(
        [(1, i % 4) for i in range(20)] + [(2, 1), (None, 9), (7, 7)], "k INT, v INT"
    )
    want = Counter(
        (a["k"], a["name"], b["v"])
        for a in left.collect()
        for b in right.collect()
        if a["k"] == b["k"]
    )
    nested = lookup(left, right, "k", "k", "found", ["v"])
    got = Counter(
        (r["k"], r["name"], r["found"]["v"]) for r in unwind(nested, "found").collect()
    )
    assert got == want
    assert sorted(r["name"] for r in nested.collect()) == list("abcde")
    assert [r["found"] for r in nested.collect() if r["name"] == "c"] == [[]]


def test_gathering_is_one_shuffle(df, plan):
    text = plan(push(df, ["k"], ["v"], "items"))
    assert text.count("Exchange hashpartitioning") == 1
    assert "Join" not in text


KEYS = st.sampled_from([None, "a", "b", "c"])
ROWS = st.lists(st.tuples(KEYS, st.integers(0, 5) | st.none()), min_size=1, max_size=60)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, parts=st.integers(1, 20))
def test_any_rows_come_back(spark, rows, parts):
    made = spark.createDataFrame(rows, "k STRING, v INT")
    documents = push_parts(made, ["k"], ["v"], "items", parts)
    assert flat(documents) == Counter(rows) == flat(push(made, ["k"], ["v"], "items"))
    keys = [(r["k"], r["part"]) for r in documents.collect()]
    assert len(keys) == len(set(keys))
