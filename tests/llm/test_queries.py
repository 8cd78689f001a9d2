"""Every corpus query runs; those with an SQL twin equal it."""

import oracle
import pytest

from sigstat.llm.catalog import QUERIES, SQL


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, folder, name):
    df = QUERIES[name](spark, folder)
    if name in SQL:
        assert oracle.compare(df, oracle.connect(folder), SQL[name]) is None
    else:
        assert df.count() > 0


def test_numbers():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
