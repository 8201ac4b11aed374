"""Every registered query against its SQL at the smallest scale; without SQL, it must yield rows."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert difference(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
