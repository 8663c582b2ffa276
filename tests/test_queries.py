"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as spark_entry
from compare import connect, difference
from registry import load_all

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


# The training-data operators have tests of their own, in a folder that may be absent.
NAMES = sorted(load_all().QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_its_sql(spark, connection, name):
    problem, _ = difference(spark, connection, name, SF_DIR)
    assert problem is None


def test_every_query_has_sql():
    assert set(NAMES) <= set(spark_entry.oracle_sql()) & set(spark_entry.queries())


def test_entry_has_rows(spark):
    assert spark_entry.entry(spark).count() > 0
