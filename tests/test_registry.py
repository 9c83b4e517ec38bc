"""Every query beside DuckDB on the smallest tables; checks/compare.py takes larger ones."""

import os

import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# No store of the smallest tables sold before it opened.
NONE_FOUND = {"store_opened_after_sales"}


def test_every_query_has_its_statement():
    assert set(entry.core_queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", entry.core_queries())
def test_same_rows_as_duckdb_and_no_python(spark, name):
    from checks.compare import connect, differences
    from tests.conftest import plan_of

    df = entry.core_queries()[name](spark, SF_DIR)
    assert differences(df, connect(SF_DIR), name) == ("no rows" if name in NONE_FOUND else None)
    plan = plan_of(df)
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
