"""Every query against its SQL on the smallest tables; skipped where the tables are absent."""

import os

import pytest

import __spark_entry__ as contract
from wardhouse.catalog import check
from wardhouse.catalog.queries import QUERIES

FOLDER = os.environ.get("CATALOG_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
ROWS = {"grid_search": 2 * 729, "forecast": 2 * 45, "champion_forecast": 5 * 15}


@pytest.fixture(scope="module")
def con():
    return check.connect(FOLDER)


def test_every_query_is_checked():
    assert set(QUERIES) == (set(contract.oracle_sql()) & set(QUERIES)) | set(ROWS)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = contract.queries()[name](spark, FOLDER)
    if name in ROWS:
        assert df.count() == ROWS[name]
    else:
        assert check.compare(df, con, contract.oracle_sql()[name]) is None


def test_entry(spark):
    out = contract.entry(spark)
    assert out.columns == ["DateKey", "revenue", "insurance_paid", "patients"] and out.count() > 0
