import threading
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

from ledgerfold import schemas
from ledgerfold import session
from ledgerfold.session import fresh_path, land, shared_folder
from ledgerfold.sinks.collections import (
    create_collection,
    drop_collection,
    list_databases,
    replace_collection,
    use_database,
)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", schemas.COLLECTIONS)
def test_empty_collections_of_every_declared_schema(spark, name):
    create_collection(spark, name, schemas.COLLECTIONS[name])
    table = spark.table(name)
    assert table.count() == 0
    assert table.schema.simpleString() == spark.createDataFrame([], schemas.COLLECTIONS[name]).schema.simpleString()
    drop_collection(spark, name)
    assert not spark.catalog.tableExists(name)
    drop_collection(spark, name)


def test_a_collection_can_be_replaced_by_what_is_read_from_it(spark):
    replace_collection(spark.range(5), "Numbers")
    before = spark.table("Numbers")
    again = replace_collection(spark.table("Numbers").where("id > 1"), "Numbers")
    assert rows(again) == rows(spark.table("Numbers")) == [(2,), (3,), (4,)]
    assert before.count() == 5
    drop_collection(spark, "Numbers")


def test_a_collection_can_change_its_schema(spark):
    replace_collection(spark.range(2), "Shape")
    replace_collection(spark.createDataFrame([("a",)], "s STRING"), "Shape")
    assert rows(spark.table("Shape")) == [("a",)]
    drop_collection(spark, "Shape")


def test_a_collection_is_there_all_the_time(spark):
    """Another thread looks for it, and reads it, while its schema changes again and again."""
    replace_collection(spark.range(3), "Always")
    missing, done = [], threading.Event()

    def watch():
        while not done.is_set():
            if not spark.catalog.tableExists("Always"):
                missing.append("gone")
            try:
                spark.table("Always").schema
            except Exception as error:
                missing.append(str(error))

    watcher = threading.Thread(target=watch)
    watcher.start()
    for n in range(6):
        replace_collection(spark.range(3).withColumnRenamed("id", f"c{n}"), "Always")
    done.set()
    watcher.join()
    assert missing == [] and spark.table("Always").columns == ["c5"]
    drop_collection(spark, "Always")


def test_a_plain_table_becomes_a_collection(spark):
    spark.range(4).write.saveAsTable("Plain")
    assert rows(replace_collection(spark.range(2), "Plain")) == [(0,), (1,)]
    drop_collection(spark, "Plain")
    spark.range(4).write.saveAsTable("Plain")
    drop_collection(spark, "Plain")
    assert not spark.catalog.tableExists("Plain")


def test_databases(spark):
    use_database(spark, "web_store")
    assert spark.catalog.currentDatabase().lower() == "web_store"
    create_collection(spark, "Brand", schemas.BRAND)
    assert spark.catalog.tableExists("web_store.Brand")
    drop_collection(spark, "Brand")
    use_database(spark, "default")
    assert "web_store" in {r[0].lower() for r in list_databases(spark).collect()}


def test_landed_rows_are_in_the_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df = land(spark.range(3), "three")
    assert rows(df) == [(0,), (1,), (2,)]
    assert all(shared_folder(spark) in f for f in df.inputFiles())
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


class _Session:
    """Stands for a session in which only the warehouse is set."""

    conf = {"spark.sql.warehouse.dir": "hdfs://host/warehouse/"}


def test_without_a_shared_folder_the_warehouse_is_taken():
    assert shared_folder(_Session()) == "hdfs://host/warehouse"


def test_a_collection_that_exists_is_not_emptied(spark):
    replace_collection(spark.range(3), "Kept")
    with pytest.raises(ValueError, match="Kept exists"):
        create_collection(spark, "Kept", "id BIGINT")
    assert spark.table("Kept").count() == 3
    drop_collection(spark, "Kept")


def test_what_was_written_can_be_removed(spark, monkeypatch):
    folder = shared_folder(spark) + "/apart"
    monkeypatch.setattr(session, "shared_folder", lambda _: folder)
    land(spark.range(3), "three")
    assert any(Path(folder).rglob("*.parquet"))
    session.expire(spark)
    assert not any(Path(folder).rglob("*.parquet"))


def test_partitions_follow_the_largest_shuffle(monkeypatch):
    settings = {}

    class Builder:
        def appName(self, _):
            return self

        def config(self, name, value):
            settings[name] = value
            return self

        def getOrCreate(self):
            return None

    monkeypatch.setattr(SparkSession, "builder", Builder())
    session.build(largest_shuffle_bytes=10 * 1024**4)
    assert settings["spark.sql.shuffle.partitions"] == "81920"
    session.build(largest_shuffle_bytes=1)
    assert settings["spark.sql.shuffle.partitions"] == "200"
