"""Every query against its SQL twin on the smallest generated tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tools.check_oracles import differences, oracle_connection


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SMALL)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    got = entry.queries()[name](spark, SMALL).toPandas()
    assert len(got) > 0
    assert differences(got, con.execute(entry.oracle_sql()[name]).df()) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 10


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
