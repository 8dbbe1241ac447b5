"""Every catalogue query agrees with its SQL; the entry point is complete."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from statmart.catalog import REGISTRY

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_agrees_with_sql(name, spark, con):
    assert REGISTRY[name].sql, "every query here can be written in SQL"
    assert difference(spark, con, REGISTRY[name], FOLDER) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(REGISTRY) <= set(entry.queries())
    assert set(REGISTRY) <= set(entry.oracle_sql()) <= set(entry.queries())
