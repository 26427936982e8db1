"""Every registered query against its SQL twin."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
import compare  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in SQL:
        assert compare.differences(got, con.execute(SQL[name]).df()) is None
    else:
        assert len(got) > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_twin_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
