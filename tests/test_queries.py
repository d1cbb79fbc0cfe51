"""Every registered query against its SQL, and its plan, at the smallest scale."""

from __future__ import annotations

import os

import pytest
from oracle import compare, oracle_connection

from signalmill.catalog import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF_DIR)
    assert problem is None, problem


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
