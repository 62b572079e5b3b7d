"""Every query with SQL gives the same columns, types and rows in DuckDB."""

import pytest

from millrace.plans import CHECKS, QUERIES
from tests.parity import compare, oracle


@pytest.fixture(scope="module")
def con(sf):
    return oracle(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf, name):
    problem, _, _ = compare(spark, con, name, QUERIES[name], CHECKS.get(name), sf)
    assert problem == ""
