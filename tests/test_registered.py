"""Every registered query against its SQL on the smallest tables."""

import check_sql
import pytest

import __spark_entry__ as registered

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_sql.connect(FOLDER)


@pytest.mark.parametrize("name", list(registered.queries()))
def test_query(spark, con, name):
    assert check_sql.differences(spark, con, FOLDER, name) is None


def test_sql_names_are_queries():
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).count() > 0
