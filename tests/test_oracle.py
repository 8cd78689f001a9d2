"""Every registered query runs on the smallest tables; those with an SQL twin must equal it."""

import os

import oracle
import pytest

from sigstat.catalog import QUERIES, SQL

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_names_match():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert oracle.compare(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 2
