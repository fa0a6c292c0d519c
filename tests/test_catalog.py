"""Every registered query against its SQL, whole tables."""

import pytest

from tests.oracle import connect, difference
from vidstrata.plans.catalog import QUERIES
from vidstrata.plans.catalog_sql import SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert difference(spark, duck, SF_DIR, QUERIES[name], SQL[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
