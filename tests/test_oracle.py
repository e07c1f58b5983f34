"""Every registered query against its SQL on the small tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests.check import compare, connect

ROOT = "/root/testdata/sf0.001"
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


def test_every_check_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, ROOT), ORACLE[name], con) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, ROOT).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 4
