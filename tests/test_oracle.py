"""Every registered query against its SQL, row by row, on the smallest tables."""

from __future__ import annotations

import pytest

from tests.conftest import SF_TINY
from tests.oracle_check import compare, duck
from tidemark.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_TINY)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF_TINY), con, ORACLES[name]) == []
