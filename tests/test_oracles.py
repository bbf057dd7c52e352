"""Every catalog query with a check statement equals it; the others run and keep their schema."""

from __future__ import annotations

import pytest
from check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

# The optional training-data queries have tests of their own.
QUERIES = {name: query for name, query in queries().items() if not name.startswith("op") and name != "pipeline"}
ORACLES = {name: sql for name, sql in oracle_sql().items() if name in QUERIES}
# Trained on the smallest data these take most of the test time; test_models.py runs one of each kind.
LONG = {name for name in QUERIES if name.startswith(("m", "p2", "p7", "p8", "u7", "x2", "x3", "v8", "s13", "s14", "t1_stream_model"))}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_statement_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_statement(spark, sf_dir, duck, name):
    assert compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - LONG))
def test_runs_without_statement(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.columns and df.count() > 0
