from datetime import date

import pyarrow.parquet as pq
import pytest

from ledgerfold.session import land
from ledgerfold.sinks.layout import (
    buckets_for,
    files_for,
    files_in_range,
    read_clustered,
    write_bucketed,
    write_clustered,
)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_join_of_buckets_has_no_shuffle(spark, plan, no_broadcast):
    hot = spark.range(500).selectExpr("7L AS ok", "id AS line")
    keyless = spark.range(300).selectExpr("CAST(NULL AS BIGINT) AS ok", "id AS line")
    lines = land(spark.range(1000).selectExpr("id % 100 AS ok", "id AS line").union(hot).union(keyless), "l")
    orders = land(spark.range(100).selectExpr("id AS k", "id * 2 AS v"), "o")
    stored_lines = write_bucketed(lines, "even_lines", "ok", 4)
    stored_orders = write_bucketed(orders, "even_orders", "k", 4)
    joined = stored_lines.join(stored_orders, stored_lines["ok"] == stored_orders["k"])
    assert "Exchange" not in plan(joined)
    plain = lines.join(orders, lines["ok"] == orders["k"])
    assert "Exchange" in plan(plain)
    assert rows(joined) == rows(plain)
    assert stored_lines.count() == 1800 and stored_lines.where("ok IS NULL").count() == 300


def test_a_table_stored_again_is_replaced(spark):
    write_bucketed(spark.range(10), "twice", "id", 2)
    assert write_bucketed(spark.range(5), "twice", "id", 4).count() == 5


@pytest.mark.parametrize(("n_bytes", "buckets"), [(0, 1), (100, 1), (101, 2), (350, 4), (10**5, 1024)])
def test_buckets_follow_the_size(n_bytes, buckets):
    assert buckets_for(n_bytes, bucket_bytes=100) == buckets


def spans(path, key):
    """Lowest and highest value of a key in each file, from the files' footers."""
    out = []
    for file in sorted((path / "rows").glob("*.parquet")):
        found = pq.ParquetFile(file).metadata
        index = found.schema.names.index(key)
        groups = [found.row_group(g).column(index).statistics for g in range(found.num_row_groups)]
        out.append((min(g.min for g in groups), max(g.max for g in groups)))
    return out


def test_either_key_reads_a_fraction_of_the_files(spark, tmp_path):
    lines = spark.range(40_000).selectExpr("xxhash64(id) % 5000 AS a", "xxhash64(id, 1) % 800 AS b", "id")
    path = tmp_path / "t"
    write_clustered(lines, str(path), ["a", "b"], 64)
    for key, value in (("a", 77), ("a", -4999), ("b", 5), ("b", -700)):
        chosen = files_in_range(spark, str(path), {key: (value, value)})
        found = spans(path, key)
        # Twice the square root of 64, and some as files end where samples say.
        assert len(found) == 64 and 1 <= len(chosen) <= 24
        # No file is left out that has the value.
        assert sum(low <= value <= high for low, high in found) == len(chosen)
        got = read_clustered(spark, str(path), {key: (value, value)})
        assert rows(got) == rows(lines.where(f"{key} = {value}"))
    both = {"a": (0, 500), "b": (None, -400)}
    assert rows(read_clustered(spark, str(path), both)) == rows(lines.where("a BETWEEN 0 AND 500 AND b <= -400"))
    assert len(files_in_range(spark, str(path), both)) < 20


def test_clustered_skewed_and_missing_keys(spark, tmp_path):
    lines = spark.range(9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN id END AS a",
        "CASE WHEN id % 5 > 0 THEN pow(2, id % 40) END AS b",
        "CAST(id AS STRING) AS `c d`",
    )
    path = tmp_path / "t"
    stored = write_clustered(lines, str(path), ["a", "b"], 16)
    assert stored.dtypes == lines.dtypes and rows(stored.na.fill(-1)) == rows(lines.na.fill(-1))
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in (path / "rows").glob("*.parquet")]
    assert max(sizes) < 3 * 9000 / 16  # the hot key is in several files
    for between, where in (
        ({"a": (7, 7)}, "a = 7"),
        ({"b": (1e6, None)}, "b >= 1e6"),
        ({"a": (None, 100), "b": (2, 8)}, "a <= 100 AND b BETWEEN 2 AND 8"),
        ({"a": (10**9, None)}, "false"),
    ):
        got = read_clustered(spark, str(path), between)
        assert rows(got.na.fill(-1)) == rows(lines.where(where).na.fill(-1))


def test_clustered_dates_and_empty_tables(spark, tmp_path):
    days = spark.range(500).selectExpr("DATE '2020-01-01' + CAST(id AS INT) AS day", "TIMESTAMP_NTZ '2020-01-01' + make_dt_interval(id) AS at")
    write_clustered(days, str(tmp_path / "d"), ["day", "at"], 8)
    low = date(2020, 3, 1)
    got = read_clustered(spark, str(tmp_path / "d"), {"day": (low, date(2020, 3, 9))})
    assert got.count() == 9
    write_clustered(days.limit(0), str(tmp_path / "e"), ["day"], 4)
    assert read_clustered(spark, str(tmp_path / "e"), {"day": (low, None)}).count() == 0
    with pytest.raises(ValueError):
        write_clustered(spark.range(1).selectExpr("'x' AS s"), str(tmp_path / "s"), ["s"], 2)


@pytest.mark.parametrize(("n_bytes", "files"), [(0, 1), (100, 1), (101, 2), (950, 10)])
def test_files_follow_the_size(n_bytes, files):
    assert files_for(n_bytes, file_bytes=100) == files
