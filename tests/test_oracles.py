"""Every query with an SQL equivalent gives exactly its rows."""

import pytest

import __spark_entry__ as entry
from cardwarden.plans.testdata_oracles import ORACLES
from cardwarden.plans.testdata_queries import QUERIES
from compare import duck, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_is_compared():
    assert set(ORACLES) == set(QUERIES) - {"iforest_scores"}
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, con, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = duck_rows(con, ORACLES[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows
