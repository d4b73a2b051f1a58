"""Queries that SQL cannot compute are registered apart, and still run from the entry point."""

import pytest

import __spark_entry__ as entry
from checks.oracle import ORACLE
from checks.queries import REGISTRY, WITHOUT_SQL


def test_names_are_apart_and_registered():
    assert not set(WITHOUT_SQL) & (set(REGISTRY) | set(ORACLE))
    assert "train_metrics" in WITHOUT_SQL
    assert set(REGISTRY) | set(WITHOUT_SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_query_returns_rows(spark, name):
    assert entry.queries()[name](spark, entry.SMALL).count() > 0
