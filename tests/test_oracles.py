"""Every registered query against its DuckDB statement on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"
# the corpus operators have tests of their own
NAMES = [name for module, _ in entry.MODULES if not module.__name__.startswith("hexloom.llm")
         for name in module.QUERIES]


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    assert compare(spark, duck, entry.queries()[name], entry.oracle_sql()[name], FOLDER) == []


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry.oracle_sql())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
