"""Aggregates that several reports share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareloom.functions.exprs import percent, round_stable

STATUS = "booking_status"


def rides(name: str = "total_rides") -> Column:
    return F.count(F.lit(1)).alias(name)


def with_status(status: str) -> Column:
    return F.count_if(F.col(STATUS) == status)


def cancel_rate(digits: int = 2) -> Column:
    return round_stable(percent(with_status("Cancelled"), F.count(F.lit(1))), digits).alias("cancel_rate_pct")


def mean(column: str | Column, digits: int, name: str) -> Column:
    return round_stable(F.avg(column), digits).alias(name)


def in_tier(tier: str) -> Column:
    return F.count_if(F.col("cancel_risk_tier") == tier)


def completion_rate() -> Column:
    return percent(with_status("Completed"), F.count(F.lit(1)))
