from __future__ import annotations

import pytest

from oracle import assert_same, connected
from textloom.plans import catalogue


@pytest.fixture(scope="module")
def con(data):
    return connected(data)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, data, con, name):
    df = catalogue.QUERIES[name](spark, data)
    if name in catalogue.ORACLE_SQL:
        assert_same(df, con, catalogue.ORACLE_SQL[name])
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
