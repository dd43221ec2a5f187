"""Every registered query against its SQL, and the shape of the registry."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from oracle import compare, connect
from saltmill.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_registry():
    assert set(ORACLES) == set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    assert compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() == 10
