"""Business rules on edge values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fareloom.functions import exprs
from fareloom.operators.features import ACCEPTANCE_BINS, AGE_BINS, EXPERIENCE_BINS, WAIT_BINS


def values(spark, rows, kind, expr):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i INT, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


@pytest.mark.parametrize("bins, rows, expected", [
    (EXPERIENCE_BINS, [0.0, 1.0, 3.0, 7.0, 14.0, 15.0, None], [None, "junior", "junior", "mid", "senior", None, None]),
    (ACCEPTANCE_BINS, [0.0, 0.6, 0.75, 0.9, 1.0, 1.02], [None, "low", "medium", "high", "very_high", None]),
    (AGE_BINS, [18.0, 25.0, 35.0, 50.0, 100.0, 101.0], ["young", "young", "adult", "mid", "senior", None]),
    (WAIT_BINS, [0.0, 5.0, 10.0, 20.0, 999.0], [None, "fast", "normal", "slow", "very_slow"]),
])
def test_bins_are_right_closed(spark, bins, rows, expected):
    edges, labels = bins
    assert values(spark, rows, "DOUBLE", lambda x: exprs.bin_label(x, edges, labels)) == expected
    codes = [None if e is None else labels.index(e) for e in expected]
    assert values(spark, rows, "DOUBLE", lambda x: exprs.bin_code(x, edges)) == codes


def test_title_case(spark):
    rows = [" customer no-show ", "HEAVY RAIN", "o'neil 2nd", "\tlow\n", "", None, "élan vital"]
    expected = [None if r is None else r.strip().title() for r in rows]
    assert values(spark, rows, "STRING", exprs.title_case) == expected


def test_flag_treats_unknown_as_zero(spark):
    assert values(spark, [1.0, 5.0, None], "DOUBLE", lambda x: exprs.flag(x < 3)) == [1, 0, 0]


def test_round_stable(spark):
    assert values(spark, [1.005, 0.285, 2.5, -0.1234, None], "DOUBLE", lambda x: exprs.round_stable(x, 2)) == [
        1.01, 0.29, 2.5, -0.12, None]


def test_round_stable_keeps_what_has_no_digits(spark):
    import math

    nan, inf, low, big, edge = values(spark, [math.nan, math.inf, -math.inf, 1e15, 123456789.125], "DOUBLE", lambda x: exprs.round_stable(x, 6))
    assert math.isnan(nan) and (inf, low, big, edge) == (math.inf, -math.inf, 1e15, 123456789.125)


def test_tiers_and_actions(spark):
    rows = [0.70, 0.6999, 0.40, 0.3999, 0.0]
    tiers = values(spark, rows, "DOUBLE", exprs.risk_tier)
    assert tiers == ["High", "Medium", "Medium", "Low", "Low"]
    assert values(spark, tiers, "STRING", exprs.recommended_action) == [
        "Reassign Driver", "Send Reminder", "Send Reminder", "Proceed", "Proceed"]
    assert values(spark, tiers, "STRING", exprs.tier_rank) == [1, 2, 2, 3, 3]


def test_hours(spark):
    rows = [0, 1, 5, 6, 7, 10, 11, 16, 17, 21, 22, 23]
    assert values(spark, rows, "INT", exprs.peak_flag) == [0, 0, 0, 0, 1, 1, 0, 0, 1, 1, 0, 0]
    assert values(spark, [0, 1, 7, 23], "INT", exprs.half_past_hour_before) == ["00:30", "00:30", "06:30", "22:30"]
    assert values(spark, [0, 9, 23], "INT", exprs.hour_label) == ["00:00", "09:00", "23:00"]


def test_clip_keeps_nulls(spark):
    assert values(spark, [-1.0, 0.5, 2.0, None], "DOUBLE",
                  lambda x: exprs.clip(x, F.lit(0.0), F.lit(1.0))) == [0.0, 0.5, 1.0, None]
    assert values(spark, [-1.0, 2.0, None], "DOUBLE", lambda x: exprs.clip_low(x, F.lit(0.0))) == [0.0, 2.0, None]


def test_safe_ratio(spark):
    assert values(spark, [2.0, 0.0, None], "DOUBLE", lambda x: exprs.safe_ratio(F.lit(1), x)) == [0.5, None, None]
