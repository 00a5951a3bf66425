"""Every registered query against its plain-SQL twin, on the smallest tables."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from tarmac.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem = compare(spark, con, SF, name, QUERIES[name], ORACLES[name])
    assert problem is None, problem


def test_every_query_is_checked():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_inventory_is_covered():
    """Each numbered operator of the blueprint has a query."""
    have = {re.sub(r"^([a-z])0*(\d+)_.*", lambda m: f"{m[1].upper()}{m[2]}", n) for n in QUERIES}
    wanted = {"S": 15, "F": 30, "J": 11, "A": 18, "W": 11, "K": 4, "U": 3, "Q": 5, "R": 7, "M": 5}
    missing = [f"{k}{i}" for k, n in wanted.items() for i in range(1, n + 1) if f"{k}{i}" not in have]
    assert missing == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["day", "n_rows", "n_aircraft", "n_airports"]
