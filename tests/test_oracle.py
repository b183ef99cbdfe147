"""Every registered query against its DuckDB twin on the small driver tables.

The driver runs the same gate at sf0.01; here sf0.001 keeps the suite quick.
Queries without a SQL twin (eigen-decompositions) must at least run.
"""

import os

import pytest

from tests.oracle_check import compare, duck

SF = os.environ.get("LARDER_TEST_SF", "/root/testdata/sf0.001")

import __spark_entry__ as entry  # noqa: E402

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in SQL:
        report = compare(df, SQL[name], con)
        assert report["ok"], report
    else:
        assert df.count() >= 0
        assert df.columns


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
