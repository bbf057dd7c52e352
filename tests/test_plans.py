"""What the physical plans must and must not hold."""

from __future__ import annotations

import pytest

from __spark_entry__ import queries
from fareloom.sources.ride_views import ride_tables
from fareloom.plans import overview, strategy

REPORTS = [name for name in queries() if name[0] in "qwdj" and name not in ("d15_rejected_rides_check",)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", REPORTS)
def test_no_cartesian_product_and_no_python(spark, sf_dir, name):
    text = plan(queries()[name](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert word not in text, f"{name}: {word}"


def test_source_scans_read_only_what_is_needed(spark, sf_dir):
    text = plan(overview.city_heatmap(ride_tables(spark, sf_dir).bookings))
    assert "l_extendedprice" not in text and "o_orderpriority" not in text and "c_acctbal" not in text


def test_filters_reach_the_stored_table(tables):
    text = plan(tables.bookings.filter("city = 'ASIA'").select("booking_id"))
    assert "EqualTo(city,ASIA)" in text and "booking_value" not in text


def test_large_sides_are_not_broadcast_by_hint(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = ride_tables(spark, sf_dir)
        assert "BroadcastHashJoin" not in plan(strategy.driver_demand(t.bookings, t.predictions))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
