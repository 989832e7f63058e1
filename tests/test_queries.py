"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from bindings.registry import QUERIES
from tools.compare import connect, differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables not present")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    assert differences(spark, db, FOLDER, name) == ""


def test_only_the_forecast_has_no_sql():
    assert set(QUERIES) - set(entry.oracle_sql()) == {"gbt_forecast"}
    assert set(entry.oracle_sql()) <= set(entry.queries())
