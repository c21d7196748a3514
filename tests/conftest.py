import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ledgerfold.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("shared")
    session = build(
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": str(scratch),
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan():
    """The physical plan of a DataFrame as text."""

    def text(df) -> str:
        return df._jdf.queryExecution().executedPlan().toString()

    return text


@pytest.fixture
def zone(spark):
    """Run a check in another session time zone."""
    before = spark.conf.get("spark.sql.session.timeZone")

    def switch(name: str) -> None:
        spark.conf.set("spark.sql.session.timeZone", name)

    yield switch
    spark.conf.set("spark.sql.session.timeZone", before)
