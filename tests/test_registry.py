import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["doc_id", "url", "ranking"] and df.count() > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, SF_DIR)
    if name in oracle_sql():
        assert compare(df, con, oracle_sql()[name]) is None
    else:
        assert df.count() > 0
