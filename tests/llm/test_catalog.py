"""Registered queries with SQL; those without have brute-force tests beside this file."""

import pytest

import __spark_entry__ as entry
from riskloom.llm.catalog import ORACLES, QUERIES
from tools.check import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None


def test_names():
    assert [n.split("_")[0] for n in QUERIES] and {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
