"""Every registered query against its SQL on the smallest given tables."""

from __future__ import annotations

import os

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from activity_engine.registry.queries import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


def test_every_library_query_has_an_oracle():
    assert set(REGISTRY) <= set(ORACLES)


def test_entry_has_rows(spark):
    assert not entry.entry(spark).isEmpty()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_agrees_with_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None
