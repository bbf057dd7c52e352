"""One local session for all tests."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for folder in (ROOT, os.path.join(ROOT, "tests")):
    if folder not in sys.path:
        sys.path.insert(0, folder)

from fareloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", 8, "fareloom-tests",
                            spark__checkpoint__dir=tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    session.sparkContext.setLogLevel("OFF")
    yield session
    from fareloom.sources.tables import clear_scratch

    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables(spark, sf_dir):
    from fareloom.plans import model_queries
    from fareloom.sources.ride_views import stored_ride_tables

    # Small models: the tests hold invariants that do not depend on the sizes.
    small = model_queries.sizes_of(rounds=6, trials=3)
    forests = {"forest_trees": 10, "forest_depth": 5, "boost_depth": 3}
    model_queries.SIZES = model_queries.Sizes(
        {**small.classifiers, **forests}, {**small.regressors, **forests}, {**small.outcome, "boost_depth": 3},
        {**small.space, "maxDepth": (3, 4)}, small.trials)
    return stored_ride_tables(spark, sf_dir)
