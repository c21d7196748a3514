"""Kept sketches against exact counts, as files come, go and change."""

import os
from datetime import datetime

import pytest

from ledgerfold.operators.profiling import column_profile
from ledgerfold.operators.sketches import sketched_profile, update_sketches

AT = "2023-02-21 00:00:00"


def add(spark, path, low, high):
    rows = spark.range(low, high, 1, 2).selectExpr(
        "id",
        "id % 100 AS few",
        "CAST(id % 1000 AS DOUBLE) / 10 AS real",
        "CASE WHEN id % 4 > 0 THEN concat('text ', id % 5000) END AS `a text`",
        "array(id % 7, 1) AS list",
        "CAST(NULL AS INT) AS none",
        "map('k', id % 3) AS pairs",
    )
    rows.write.mode("append").parquet(path)


def profile(spark, path, store):
    return {r["column_name"]: r for r in sketched_profile(spark, path, store, "t", AT).collect()}


def close(spark, got, path):
    table = spark.read.parquet(path)
    exact = {r["column_name"]: r for r in column_profile(table, "t", AT, exact=True).collect()}
    assert set(got) == set(exact)
    for name, row in exact.items():
        assert got[name][:5] == row[:5]
        assert got[name]["n_distinct"] == pytest.approx(row["n_distinct"], rel=0.05, abs=0.5)


def test_a_second_snapshot_reads_only_new_files(spark, tmp_path):
    path, store = str(tmp_path / "t"), str(tmp_path / "store")
    add(spark, path, 0, 20_000)
    assert update_sketches(spark, path, store) == 2
    assert update_sketches(spark, path, store) == 0
    add(spark, path, 10_000, 40_000)
    # The old files need not even be readable: their bytes are not looked at again.
    assert update_sketches(spark, path, store) == 2
    got = profile(spark, path, store)
    close(spark, got, path)
    assert got["id"]["snapshot_at"] == datetime(2023, 2, 21)
    assert got["none"]["quantiles"] is None and got["a text"]["quantiles"] is None


def test_known_files_are_not_opened(spark, tmp_path):
    path, store = str(tmp_path / "t"), str(tmp_path / "store")
    add(spark, path, 0, 2000)
    before = profile(spark, path, store)
    for file in (tmp_path / "t").glob("*.parquet"):
        stat = file.stat()
        crc = file.with_name(f".{file.name}.crc")
        crc.unlink(missing_ok=True)
        data = bytearray(file.read_bytes())
        data[4:40] = b"x" * 36  # a page that no one could read
        file.write_bytes(data)
        os.utime(file, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert profile(spark, path, store) == before


def test_quantiles_are_within_their_bound(spark, tmp_path):
    path, store = str(tmp_path / "t"), str(tmp_path / "store")
    for n in range(4):
        add(spark, path, n * 10_000, (n + 1) * 10_000)
        update_sketches(spark, path, store)
    got = profile(spark, path, store)["id"]["quantiles"]
    for value, rank in zip(got, (0.25, 0.5, 0.75)):
        assert abs(value / 40_000 - rank) < 0.02


def test_files_that_go_or_change_do_not_count(spark, tmp_path):
    path, store = str(tmp_path / "t"), str(tmp_path / "store")
    add(spark, path, 0, 8000)
    update_sketches(spark, path, store)
    add(spark, path, 8000, 9000)
    close(spark, profile(spark, path, store), path)
    sorted((tmp_path / "t").glob("*.parquet"))[0].unlink()
    # What is left of the part that lost a file is read again, the other part is not.
    assert update_sketches(spark, path, store) == 1
    close(spark, profile(spark, path, store), path)
    spark.range(10).selectExpr("id", "id AS few").write.mode("overwrite").parquet(path)
    close(spark, profile(spark, path, store), path)


def test_a_part_without_its_list_does_not_count(spark, tmp_path):
    path, store = str(tmp_path / "t"), str(tmp_path / "store")
    add(spark, path, 0, 1000)
    update_sketches(spark, path, store)
    (part,) = (tmp_path / "store" / "files").iterdir()
    for file in part.iterdir():
        file.unlink()
    assert profile(spark, path, store)["id"]["n_rows"] == 1000


def test_tables_without_rows_or_files(spark, tmp_path):
    path, store = str(tmp_path / "t"), str(tmp_path / "store")
    spark.range(0).write.parquet(path)
    row = profile(spark, path, store)["id"]
    assert (row["n_rows"], row["n_nulls"], row["n_distinct"], row["quantiles"]) == (0, 0, 0, None)
