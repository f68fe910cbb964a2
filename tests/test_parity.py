"""Every registered query against its SQL in DuckDB."""

import pytest

from fairreach import catalog
from parity import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_matches_sql(spark, con, name):
    ok, note = compare(spark, con, FOLDER, name)
    assert ok, note


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
