"""Every registered query against its SQL on the whole test tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lakeops.plans import ORACLES, QUERIES
from check import compare, connect
from conftest import SF

ROWS_ONLY = {"random_int", "sample_rows", "layout_report"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, con, name, SF) is None


def test_only_queries_without_sql_lack_an_oracle():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry_has_rows(spark):
    df = entry(spark)
    assert df.count() == 10 and df.columns[0] == "state"
