import pytest
from pyspark.sql import functions as F

from ledgerfold.operators.nested import (
    array_count,
    lookup,
    lookup_unwind,
    map_fields,
    path_type,
    project_elements,
    put,
    unwind,
)

DOCUMENTS = "id INT, t ARRAY<STRUCT<a: INT, b: STRING>>"


@pytest.fixture
def documents(spark):
    return spark.createDataFrame(
        [(1, [(1, "x"), (2, "y")]), (2, []), (3, None), (4, [None, (3, None)])], DOCUMENTS
    )


def test_unwind_drops_missing_and_empty_and_keeps_null_elements(documents):
    got = [(r["id"], r["t"] and tuple(r["t"])) for r in unwind(documents, "t").collect()]
    assert got == [(1, (1, "x")), (1, (2, "y")), (4, None), (4, (3, None))]


def test_unwind_of_chosen_fields(documents):
    got = [(r["id"], r["t"]["b"]) for r in unwind(documents, "t", ["b"]).collect()]
    assert got == [(1, "x"), (1, "y"), (4, None), (4, None)]


def test_unwind_of_a_single_value(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id INT, t STRING")
    assert [tuple(r) for r in unwind(df, "t").collect()] == [(1, "x")]


def test_unwind_of_a_nested_array(spark):
    df = spark.createDataFrame([(1, (5, [1, 2])), (2, (6, []))], "id INT, d STRUCT<x: INT, a: ARRAY<INT>>")
    got = [(r["id"], tuple(r["d"])) for r in unwind(df, "d.a").collect()]
    assert got == [(1, (5, 1)), (1, (5, 2))]
    assert unwind(df, "d.a").columns == ["id", "d"]


def test_put_adds_and_replaces_nested_fields(spark):
    df = spark.createDataFrame([(1, (5, 6))], "id INT, d STRUCT<x: INT, y: INT>")
    got = put(put(df, "d.x", F.lit("new")), "d.z", F.col("d.y") + 1)
    assert got.head()["d"].asDict() == {"x": "new", "y": 6, "z": 7}
    assert path_type(got, "d.x").simpleString() == "string"


def test_map_fields_merges_into_every_element(documents):
    got = map_fields(documents, "t", {"b": lambda r: F.upper(r["b"]), "c": lambda r: r["a"] + 1})
    arrays = {r["id"]: r["t"] for r in got.collect()}
    assert [tuple(x) for x in arrays[1]] == [(1, "X", 2), (2, "Y", 3)]
    assert arrays[2] == [] and arrays[3] is None
    assert arrays[4][0] is None and tuple(arrays[4][1]) == (3, None, 4)


def test_map_fields_can_turn_null_elements_into_documents(documents):
    got = map_fields(documents, "t", {"c": lambda r: r["a"]}, null_element="document")
    assert tuple(got.where("id = 4").head()["t"][0]) == (None, None, None)


def test_project_elements_keeps_named_fields_only(documents):
    got = project_elements(documents, "t", {"A": lambda r: r["a"]})
    assert path_type(got, "t").simpleString() == "array<struct<A:int>>"
    assert [tuple(x) for x in got.head()["t"]] == [(1,), (2,)]


def test_array_count(documents):
    counts = documents.select(array_count(documents, "t")).collect()
    assert [r[0] for r in counts] == [2, 0, None, 2]


def test_strict_array_count_raises_on_a_missing_array(documents):
    strict = array_count(documents, "t", strict=True)
    assert documents.where("id <> 3").select(strict).count() == 3
    with pytest.raises(Exception, match="t is not an array"):
        documents.select(strict).collect()


def test_array_count_reads_one_leaf(spark, documents, tmp_path, plan):
    path = str(tmp_path / "d")
    documents.write.parquet(path)
    stored = spark.read.parquet(path)
    text = plan(stored.select(array_count(stored, "t")))
    assert "ReadSchema: struct<t:array<struct<a:int>>>" in text
    text = plan(unwind(stored, "t", ["b"]).select("t.b"))
    assert "ReadSchema: struct<t:array<struct<b:string>>>" in text


def test_lookup_into_a_nested_path_by_a_nested_path(spark):
    left = spark.createDataFrame([(1, (10, "p")), (2, (11, "q"))], "id INT, line STRUCT<o: INT, v: STRING>")
    right = spark.createDataFrame([(10, "first"), (10, "second")], "o INT, name STRING")
    got = lookup(left, right, "line.o", "o", "line.Order").orderBy("id").collect()
    assert [tuple(x) for x in got[0]["line"]["Order"]] == [(10, "first"), (10, "second")]
    assert got[1]["line"]["Order"] == []
    flat = unwind(lookup(left, right, "line.o", "o", "line.Order"), "line.Order")
    joined = lookup_unwind(left, right, "line.o", "o", "line.Order")
    assert sorted(map(str, flat.collect())) == sorted(map(str, joined.collect()))


def test_lookup_unwind_and_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k INT, name STRING")
    right = spark.createDataFrame([(1, 5), (None, 6)], "k INT, v INT")
    safe = lookup_unwind(left, right, "k", "k", "m", ["v"])
    assert sorted((r["name"], r["m"]["v"]) for r in safe.collect()) == [("a", 5), ("b", 6)]
    plain = lookup_unwind(left, right, "k", "k", "m", ["v"], null_safe=False)
    assert [(r["name"], r["m"]["v"]) for r in plain.collect()] == [("a", 5)]


def test_lookup_by_the_left_table_key_shuffles_arrays_once(spark, plan):
    left = spark.range(10).withColumnRenamed("id", "k")
    right = spark.range(100).selectExpr("id % 10 AS k", "id AS v")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(lookup(left, right, "k", "k", "found", left_unique=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 2


def test_null_safe_lookup_is_still_an_equi_join(spark, plan):
    left = spark.range(10).withColumnRenamed("id", "k")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(lookup_unwind(left, left, "k", "k", "m"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in text and "NestedLoop" not in text
