"""Every registered query against its SQL, on the driver's smallest tables."""

import importlib.util
from pathlib import Path

import pytest

from workload.check import connect, differs
from workload.queries import QUERIES
from workload.sql import SQL

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, database, name):
    assert differs(spark, database, SF_DIR, name) == ""


def test_results_do_not_depend_on_the_session_zone(spark, database, zone):
    zone("Asia/Tokyo")
    for name in ("carrier_avg_delivery_days", "nested_dates_normalised", "orders_dates_normalised"):
        assert differs(spark, database, SF_DIR, name) == ""


def test_driver_contract(spark):
    path = Path(__file__).resolve().parent.parent / "__spark_entry__.py"
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert module.entry(spark).columns == ["name", "avgDifferenceBetweenDays"]
    assert QUERIES.items() <= module.queries().items()
    assert SQL.items() <= module.oracle_sql().items()
    assert set(module.oracle_sql()) <= set(module.queries())
    assert set(QUERIES) == set(SQL)
