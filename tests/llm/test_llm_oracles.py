"""The corpus queries that SQL can say, next to their SQL."""

import pytest
from conftest import SF_DIR
from oracle_check import compare, duck

from lakeaudit.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_oracle(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLES[name]) is None


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
