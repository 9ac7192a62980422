"""Registered queries against their SQL twins; ALL_QUERIES=1 adds the slow linkage ones."""

import os

import pytest

import __spark_entry__ as entry
from suite import modules

from .check_oracles import compare, oracle_connection

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SLOW = ("linkage", "tfidf", "tier_", "monthly", "archive_arrivals", "wide_to_map", "cost_sheet")


def names():
    every = [n for m in modules() for n in m.QUERIES]
    if os.environ.get("ALL_QUERIES"):
        return every
    return [n for n in every if not n.startswith(SLOW)]


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", names())
def test_query(spark, con, name):
    result = compare(spark, con, name, SF)
    assert result.startswith(("ok", "rows only")), result


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
