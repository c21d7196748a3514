"""Collections kept in the catalog: create, replace, drop, and choose a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerfold.session import fresh_path


def create_collection(spark: SparkSession, name: str, schema: str) -> None:
    """An empty collection of the declared schema; one that exists is not touched, and raises."""
    if spark.catalog.tableExists(name):
        raise ValueError(f"collection {name} exists")
    _point(spark, name, spark.createDataFrame([], schema))


def replace_collection(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as the new content of a collection and give the stored rows.

    A collection is a view of the folder with its present content. The rows go to a new
    folder and the view is replaced, in one step of the catalog, only when all are
    written: ``df`` may read the collection it replaces, readers of the old rows are not
    disturbed, and at no moment is there no such collection, also where its schema
    changes. Folders of former contents stay until ``session.expire`` or the owner of the
    shared folder removes them. (A plain table of that name is dropped first.)
    """
    return _point(df.sparkSession, name, df)


def _point(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    path = fresh_path(spark, name)
    df.write.parquet(path)
    if _is_table(spark, name):
        drop_collection(spark, name)
    # ALTER is one step of the catalog; CREATE OR REPLACE would drop the view before.
    verb = "ALTER" if spark.catalog.tableExists(name) else "CREATE"
    spark.sql(f"{verb} VIEW {_quoted(name)} AS SELECT * FROM parquet.`{path}`")
    return spark.table(name)


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _is_table(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW"


def drop_collection(spark: SparkSession, name: str) -> None:
    """Forget a collection; it is no error if there is none."""
    kind = "TABLE" if _is_table(spark, name) else "VIEW"
    spark.sql(f"DROP {kind} IF EXISTS {_quoted(name)}")


def use_database(spark: SparkSession, name: str) -> None:
    """Make a database the current one, creating it if there is none."""
    spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:name)", args={"name": name})
    spark.catalog.setCurrentDatabase(name)


def list_databases(spark: SparkSession) -> DataFrame:
    """Names of the databases."""
    return spark.sql("SHOW DATABASES")
