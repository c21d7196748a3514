from collections import Counter

import pytest

from ledgerfold.operators.changes import (
    apply_changes,
    delete_by_key,
    insert_rows,
    latest_per_key,
    update_by_key,
)
from ledgerfold.plans.customers import (
    customers_by_email,
    delete_customers,
    insert_customers,
    update_customers,
)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def base(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", None), (3, "c", 30)], "k INT, s STRING, n INT")


def test_insert_by_name_with_columns_left_out(spark, base):
    new = spark.createDataFrame([("d", 4)], "s STRING, k INT")
    assert rows(insert_rows(base, new))[3] == (4, "d", None)


def test_update_sets_nulls_and_ignores_unknown_keys(spark, base):
    changes = spark.createDataFrame([(1, None), (2, 22), (9, 99)], "k INT, n INT")
    assert rows(update_by_key(base, changes, "k")) == [(1, "a", None), (2, "b", 22), (3, "c", 30)]
    assert update_by_key(base, changes, "k").columns == base.columns


def test_update_of_several_columns_to_null(spark, base):
    changes = spark.createDataFrame([(1, None, None)], "k INT, s STRING, n INT")
    assert rows(update_by_key(base, changes, "k"))[0] == (1, None, None)


def test_delete(spark, base):
    keys = spark.createDataFrame([(1,), (1,), (9,)], "k INT")
    assert rows(delete_by_key(base, keys, "k").select("k")) == [(2,), (3,)]


def test_change_set(spark, base):
    changes = spark.createDataFrame(
        [(1, "A", 11, "U"), (2, "", 0, "D"), (4, "d", 40, "I"), (8, "x", 0, "U"), (9, "y", 0, "D")],
        "k INT, s STRING, n INT, op STRING",
    )
    once = apply_changes(base, changes, "k")
    assert rows(once) == [(1, "A", 11), (3, "c", 30), (4, "d", 40)]
    assert rows(apply_changes(once, changes, "k")) == rows(once)


def test_change_set_with_several_changes_per_key(spark, base):
    changes = spark.createDataFrame(
        [(1, "x", 1, "U", 1), (1, "y", 2, "U", 3), (1, "z", 3, "D", 2), (5, "e", 5, "I", 1), (5, "", 0, "D", 2)],
        "k INT, s STRING, n INT, op STRING, seq INT",
    )
    got = apply_changes(base, changes, "k", order_by=["seq"])
    assert [r[:2] for r in rows(got.fillna(-1))] == [(1, "y"), (2, "b"), (3, "c")]


@pytest.mark.parametrize("op", ["u", "X", "", None])
def test_an_unknown_op_raises(spark, base, op):
    changes = spark.createDataFrame([(1, "A", 11, op)], "k INT, s STRING, n INT, op STRING")
    with pytest.raises(Exception, match="no such op"):
        apply_changes(base, changes, "k").collect()


def test_several_changes_of_one_key_raise(spark, base):
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k INT, s STRING")
    with pytest.raises(Exception, match="several changes of key 1"):
        update_by_key(base, twice, "k").collect()
    with pytest.raises(Exception, match="several changes of key 1"):
        update_by_key(base, twice, "k").count()
    ops = spark.createDataFrame([(1, "x", 1, "U"), (1, "y", 2, "D")], "k INT, s STRING, n INT, op STRING")
    with pytest.raises(Exception, match="several changes of key 1"):
        apply_changes(base, ops, "k").collect()


def test_null_keys_in_changes_match_nothing(spark, base):
    changes = spark.createDataFrame([(None, "x"), (None, "y")], "k INT, s STRING")
    assert rows(update_by_key(base, changes, "k").fillna(-1)) == rows(base.fillna(-1))


def test_small_change_set_does_not_shuffle_the_table(spark, tmp_path, plan):
    path = str(tmp_path / "base")
    spark.range(1000).selectExpr("id AS k", "id AS n").write.parquet(path)
    changes = spark.createDataFrame([(1, 2, "U")], "k BIGINT, n BIGINT, op STRING")
    stored = str(tmp_path / "changes")
    changes.write.parquet(stored)
    changes = spark.read.parquet(stored)
    table = spark.read.parquet(path)
    for df in (
        apply_changes(table, changes, "k"),
        update_by_key(table, changes.drop("op"), "k"),
        delete_by_key(table, changes, "k"),
    ):
        # The changes are brought together by key to see that it is one each.
        assert "BroadcastHashJoin" in plan(df)
        assert "SortMergeJoin" not in plan(df)


def test_latest_per_key_with_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, 5, 1), (1, 5, 2), (1, None, 9), (2, None, 1), (None, 1, 1), (None, 2, 1)],
        "k INT, ts INT, tie INT",
    )
    got = Counter(tuple(r) for r in latest_per_key(df, ["k"], ["ts", "tie"]).collect())
    assert got == Counter([(1, 5, 2), (2, None, 1), (None, 2, 1)])


def test_latest_per_key_keeps_one_row_per_key_and_task_before_the_shuffle(spark, plan):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS ts")
    text = plan(latest_per_key(df, ["k"], ["ts"]))
    before_shuffle = text[text.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_round_trip_of_one_customer(spark):
    """Insert, change and remove customer 404, looked up by e-mail after each step.

    The customer's fields are fixed values.
    """
    schema = "CustomerID INT, CustomerPrimaryContact STRING, CustomerEmail STRING, CustomerUpdateAt STRING"
    base = spark.createDataFrame([(1, "x", "other", "2020-01-01")], schema)
    new = spark.createDataFrame([(404, "Teste PrimaryContact", "email", "2023-02-21")], schema)
    inserted = insert_customers(base, new)
    assert customers_by_email(inserted, "email").count() == 1
    change = spark.createDataFrame([(404, "22222 PrimaryContact")], "CustomerID INT, CustomerPrimaryContact STRING")
    updated = update_customers(inserted, change)
    assert customers_by_email(updated, "email").head()[1] == "22222 PrimaryContact"
    deleted = delete_customers(updated, change)
    assert customers_by_email(deleted, "email").count() == 0
    assert rows(deleted) == rows(base)
