"""Every registered query against its oracle SQL on the smallest tables."""

import pytest
from conftest import SF_DIR
from oracle_check import compare, duck

from __spark_entry__ import entry
from lakeaudit.suite import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_oracle(spark, con, name):
    # File sizes are read from the folder itself, which this text names.
    sql = ORACLES[name].replace("/root/testdata/sf0.01/", f"{SF_DIR}/")
    assert compare(QUERIES[name](spark, SF_DIR), con, sql) is None


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_entry_has_rows(spark):
    df = entry(spark)
    assert df.columns == ["query_id", "metric_value", "count_executions", "last_execution_time"]
    assert df.count() == 10
