import hashlib
import random
from datetime import datetime
from pathlib import Path

from ledgerfold.operators.profiling import column_profile, storage_profile
from ledgerfold.plans.monitoring import (
    keep_latest,
    keep_snapshot,
    last_monitoring,
    last_monitoring_storage,
    monitor,
    monitor_files,
    monitor_storage,
)
from ledgerfold.sinks.collections import drop_collection

DAY_1, DAY_2 = "2023-02-21 00:00:00", "2023-02-22 00:00:00"


def test_column_profile_counts_rows_nulls_and_distinct_values(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None)], "k INT, s STRING")
    got = {r["column_name"]: tuple(r) for r in column_profile(df, "t", DAY_1, exact=True).collect()}
    at = datetime(2023, 2, 21)
    assert got == {"k": (at, "t", "k", 3, 0, 2), "s": (at, "t", "s", 3, 2, 1)}


def test_estimated_profile_is_close_and_shuffles_one_row_per_task(spark, plan):
    df = spark.range(20000).selectExpr("id", "id % 100 AS few")
    profile = column_profile(df, "t", DAY_1)
    got = {r["column_name"]: r["n_distinct"] for r in profile.collect()}
    assert abs(got["id"] - 20000) < 3000 and abs(got["few"] - 100) < 15
    assert "hashpartitioning" not in plan(profile) and "Expand" not in plan(profile)


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k INT")
    assert column_profile(df, "t", DAY_1, exact=True).head()[3:] == (0, 0, 0)


def test_storage_profile_equals_the_files(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(1000).repartition(3).write.parquet(str(path))
    files = list(Path(path).glob("*.parquet"))
    row = storage_profile(spark, str(path), "t", DAY_1).head()
    assert (row["n_files"], row["n_rows"]) == (3, 1000)
    assert row["n_bytes"] == sum(f.stat().st_size for f in files)


def test_storage_profile_of_an_empty_table(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(0).write.parquet(str(path))
    files = list(Path(path).glob("*.parquet"))
    row = storage_profile(spark, str(path), "t", DAY_1).head()
    assert (row["n_files"], row["n_rows"]) == (len(files), 0)
    assert row["n_bytes"] == sum(f.stat().st_size for f in files) > 0


def test_exact_profile_is_one_scan_and_one_shuffle_of_values(spark, plan, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id AS a", "id % 3 AS b", "'x' AS `c.d`").write.parquet(path)
    profile = column_profile(spark.read.parquet(path), "t", DAY_1, exact=True)
    assert plan(profile).count("FileScan") == 1
    assert plan(profile).count("Exchange hashpartitioning") == 1
    assert {r["column_name"]: r["n_distinct"] for r in profile.collect()} == {"a": 100, "b": 3, "c.d": 1}


def test_snapshots_of_one_time_give_the_larger(spark):
    rows = [(DAY_1, "a", "c", 5, 0, 2), (DAY_1, "a", "c", 7, 0, 1)]
    schema = "snapshot_at STRING, table_name STRING, column_name STRING, n_rows INT, n_nulls INT, n_distinct INT"
    for order in (rows, rows[::-1]):
        assert last_monitoring(spark.createDataFrame(order, schema)).head()["n_rows"] == 7


def test_last_snapshots(spark, tmp_path):
    one = spark.createDataFrame([(1,)], "k INT")
    two = spark.createDataFrame([(1,), (2,)], "k INT")
    kept = str(tmp_path / "kept")
    keep_snapshot(monitor({"a": one, "b": one}, DAY_1), kept)
    keep_snapshot(monitor({"a": two}, DAY_2), kept)
    last = last_monitoring(spark.read.parquet(kept)).collect()
    assert sorted((r["table_name"], r["snapshot_at"].day, r["n_rows"]) for r in last) == [
        ("a", 22, 2),
        ("b", 21, 1),
    ]


def test_last_storage_snapshots(spark, tmp_path):
    stored, kept = str(tmp_path / "t"), str(tmp_path / "kept")
    spark.range(10).write.parquet(stored)
    keep_snapshot(monitor_storage(spark, {"t": stored}, DAY_1), kept)
    spark.range(5).write.mode("append").parquet(stored)
    keep_snapshot(monitor_storage(spark, {"t": stored}, DAY_2), kept)
    last = last_monitoring_storage(spark.read.parquet(kept)).collect()
    assert [(r["table_name"], r["n_rows"]) for r in last] == [("t", 15)]


def test_long_values_are_counted_by_their_digests(spark):
    long = "x" * 5000
    texts = [long + "a", long + "b", long + "a", "short", None, "", "#" + "0" * 64]
    digest = hashlib.sha256((long + "a").encode()).hexdigest()
    texts += ["#" + digest, "=short"]
    df = spark.createDataFrame([(t, [t]) for t in texts], "s STRING, l ARRAY<STRING>")
    got = {r["column_name"]: r["n_distinct"] for r in column_profile(df, "t", DAY_1, exact=True).collect()}
    assert got == {"s": len(set(texts) - {None}), "l": len(set(texts))}


def test_latest_kept_up_equals_the_full_read(spark, tmp_path):
    rng = random.Random(2)
    drop_collection(spark, "Latest")
    path = str(tmp_path / "all")
    for day in rng.sample(range(1, 9), 8):  # some come late
        tables = {n: spark.range(rng.randint(0, 9)) for n in rng.sample(["a", "b", "c"], 2)}
        snapshot = monitor(tables, f"2023-02-0{day} 00:00:00", exact=True)
        keep_snapshot(snapshot, path)
        latest = keep_latest(snapshot, "Latest")
        whole = last_monitoring(spark.read.parquet(path))
        assert sorted(map(tuple, latest.collect())) == sorted(map(tuple, whole.collect()))
    assert latest.count() <= 3
    drop_collection(spark, "Latest")


def test_snapshots_from_files_are_like_those_from_tables(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("a", "b")}
    spark.range(300).write.parquet(paths["a"])
    spark.range(5).selectExpr("id", "CAST(NULL AS STRING) AS s").write.parquet(paths["b"])
    got = monitor_files(spark, paths, str(tmp_path / "store"), DAY_1)
    want = monitor({n: spark.read.parquet(p) for n, p in paths.items()}, DAY_1)
    assert got.columns == want.columns
    assert sorted(tuple(r)[1:5] for r in got.collect()) == sorted(tuple(r)[1:5] for r in want.collect())
