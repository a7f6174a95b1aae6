"""Every registered query against its SQL twin on the smallest tables."""

import pytest
from compare import differences, oracle_connection

import __spark_entry__ as checked

SF_DIR = "/root/testdata/sf0.001"
ORACLE = checked.oracle_sql()


@pytest.fixture(scope="module")
def database():
    return oracle_connection(SF_DIR)


def test_names():
    assert set(ORACLE) <= set(checked.queries())


@pytest.mark.parametrize("name", checked.queries())
def test_query(spark, database, name):
    result = checked.queries()[name](spark, SF_DIR).toArrow()
    assert result.num_rows > 0
    if name in ORACLE:
        assert differences(result, database.sql(ORACLE[name]).to_arrow_table()) is None


def test_entry(spark):
    assert checked.entry(spark).count() == 5
