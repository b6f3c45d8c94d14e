"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry
from check_queries import compare, duck
from plumbline.plans import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    ok, message, _ = compare(spark, con, FOLDER, name, QUERIES[name], ORACLES.get(name))
    assert ok, message


def test_a_wrong_result_is_noticed(spark, con):
    sql = ORACLES["a18_progress"].replace("'F'", "'O'", 1)
    ok, message, _ = compare(spark, con, FOLDER, "a18_progress", QUERIES["a18_progress"], sql)
    assert not ok and "only here" in message


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
