"""Every query with a SQL counterpart gives the same table in DuckDB."""

import os

import pytest

import __spark_entry__ as entry_module
from tests.compare import connect, difference

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_same_as_sql(spark, con, name):
    df = entry_module.queries()[name](spark, SF)
    assert difference(df, con, entry_module.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry_module.entry(spark).columns == [
        "tconst", "primaryTitle", "averageRating", "numVotes", "startYear"]
