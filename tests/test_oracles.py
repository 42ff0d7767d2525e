"""Every registered query on the small tables, next to its DuckDB SQL."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return check.connect(sf)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    ok, note, _ = check.compare(spark, con, name, sf, QUERIES, ORACLES)
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0
