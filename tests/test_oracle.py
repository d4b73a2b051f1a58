"""Every registered query equals its SQL on the small tables."""

import pytest

from checks.compare import compare, connect
from checks.oracle import ORACLE
from checks.queries import REGISTRY

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_every_sql_has_a_query():
    assert set(ORACLE) == set(REGISTRY)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, SMALL, name) == ""
