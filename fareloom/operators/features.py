"""Row-wise features. They need no fitted state, so the same functions serve batch, single rows and streams."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.exprs import bin_label, clip_low, flag, mapped

# Interval edges (right-closed) and names.
AGE_BINS = ((0, 25, 35, 50, 100), ("young", "adult", "mid", "senior"))
ACCEPTANCE_BINS = ((0, 0.6, 0.75, 0.9, 1.01), ("low", "medium", "high", "very_high"))
EXPERIENCE_BINS = ((0, 3, 7, 14), ("junior", "mid", "senior"))
WAIT_BINS = ((0, 5, 10, 20, 999), ("fast", "normal", "slow", "very_slow"))

# Ordinal weights in the interaction features.
TRAFFIC_WEIGHT = {"Low": 1, "Medium": 2, "High": 3}
WEATHER_WEIGHT = {"Clear": 0, "Rain": 1, "Heavy Rain": 2}

# Columns that are logged, and columns dropped after the features are built.
LOG_COLUMNS = ("base_fare", "ride_distance_km", "total_bookings", "total_requests", "estimated_ride_time_min")
RAW_COLUMNS = (
    "booking_id", "customer_id", "driver_id", "actual_ride_time_min", "booking_datetime", "actual_time_available",
    "merge_hour", "pickup_location", "drop_location", "traffic_level", "weather_condition", "demand_level",
    "booking_status", "completed_rides", "cust_completion_rate", "total_bookings", "driver_experience_bin",
    "driver_acceptance_tier", "customer_age_bin", "wait_time_bin", "traffic_num", "weather_num",
)


def _c(name: str) -> Column:
    return F.col(name)


def _cycle(value: Column, period: int) -> tuple[Column, Column]:
    angle = value * (2 * math.pi) / period
    return F.sin(angle), F.cos(angle)


def add_datetime_features(df: DataFrame) -> DataFrame:
    when, hour = _c("booking_datetime"), _c("hour_of_day")
    weekday, month = F.weekday(when), F.month(when)
    hour_sin, hour_cos = _cycle(hour, 24)
    day_sin, day_cos = _cycle(weekday, 7)
    month_sin, month_cos = _cycle(month, 12)
    return df.withColumns({
        "day_of_week_num": weekday,
        "booking_month": month,
        "booking_quarter": F.quarter(when),
        "booking_week": F.weekofyear(when),
        "is_morning_peak": flag(hour.between(7, 10)),
        "is_evening_peak": flag(hour.between(17, 21)),
        "is_night_ride": flag((hour >= 22) | (hour <= 5)),
        "is_weekend": flag(weekday >= 5),
        "hour_sin": hour_sin, "hour_cos": hour_cos,
        "day_sin": day_sin, "day_cos": day_cos,
        "month_sin": month_sin, "month_cos": month_cos,
    })


def add_ride_features(df: DataFrame) -> DataFrame:
    fare = _c("base_fare") * _c("surge_multiplier")
    made = {
        "expected_fare": fare,
        "fare_per_km": fare / (_c("ride_distance_km") + 0.1),
        "fare_per_min": fare / (_c("estimated_ride_time_min") + 1),
        "delay_per_km": _c("delay_rate") * _c("avg_pickup_delay_min") / (_c("ride_distance_km") + 0.1),
    }
    if "same_loc_flag" in df.columns:
        made["same_loc_flag"] = _c("same_loc_flag").cast("int")
    return df.withColumns(made)


def add_customer_features(df: DataFrame) -> DataFrame:
    def per_booking(count: str) -> Column:
        return _c(count) / (_c("total_bookings") + 1)

    made = {
        "customer_tenure_years": _c("customer_signup_days_ago") / 365,
        "is_new_customer": flag(_c("customer_signup_days_ago") < 90),
        "cancel_to_booking_ratio": per_booking("cancelled_rides"),
        "cust_completion_rate": per_booking("completed_rides"),
        "incomplete_ride_share": per_booking("incomplete_rides"),
        "is_low_rated_customer": flag(_c("avg_customer_rating") < 3.5),
        "customer_age_bin": bin_label(_c("customer_age"), *AGE_BINS),
    }
    if {"preferred_vehicle_type", "vehicle_type"} <= set(df.columns):
        made["vehicle_preference_match"] = flag(_c("preferred_vehicle_type") == _c("vehicle_type"))
    return df.withColumns(made)


def add_driver_features(df: DataFrame) -> DataFrame:
    unfinished = "driver_incomplete_rides" if "driver_incomplete_rides" in df.columns else "incomplete_rides"
    late, refusing = _c("delay_rate") > 0.15, _c("acceptance_rate") < 0.6
    return df.withColumns({
        "rejection_rate": _c("rejected_rides") / (_c("total_assigned_rides") + 1),
        "driver_incomplete_rate": _c(unfinished) / (_c("accepted_rides") + 1),
        "delay_per_ride": _c("delay_count") / (_c("accepted_rides") + 1),
        "driver_acceptance_tier": bin_label(_c("acceptance_rate"), *ACCEPTANCE_BINS),
        "driver_experience_bin": bin_label(_c("driver_experience_years"), *EXPERIENCE_BINS),
        "is_unreliable_driver": flag(late | refusing),
        "is_low_rated_driver": flag(_c("avg_driver_rating") < 3.5),
    })


def add_location_features(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    made: dict[str, Column] = {}
    if {"loc_total_requests", "loc_completed_rides"} <= have:
        made["demand_supply_ratio"] = _c("loc_total_requests") / (_c("loc_completed_rides") + 1)
    if "avg_surge_multiplier" in have:
        made["location_surge_deviation"] = _c("surge_multiplier") - _c("avg_surge_multiplier")
    if "avg_wait_time_min" in have:
        made["wait_time_bin"] = bin_label(_c("avg_wait_time_min"), *WAIT_BINS)
    if "demand_level" in have:
        made["is_high_demand_location"] = flag(_c("demand_level") == "High")
    return df.withColumns(made)


def add_interaction_features(df: DataFrame) -> DataFrame:
    traffic = mapped(_c("traffic_level"), TRAFFIC_WEIGHT)
    weather = mapped(_c("weather_condition"), WEATHER_WEIGHT)
    jammed = _c("traffic_level") == "High"
    factors = {
        "surge_x_distance": ("surge_multiplier", "ride_distance_km"),
        "surge_x_traffic": ("surge_multiplier", "traffic_num"),
        "peak_x_surge": ("peak_time_flag", "surge_multiplier"),
        "base_x_surge": ("base_fare", "surge_multiplier"),
        "traffic_x_ridetime": ("traffic_num", "estimated_ride_time_min"),
        "weather_x_ridetime": ("weather_num", "estimated_ride_time_min"),
        "cancel_risk_x_peak": ("cancellation_rate", "peak_time_flag"),
        "cancel_risk_x_night": ("cancellation_rate", "is_night_ride"),
        "delay_x_traffic": ("delay_rate", "traffic_num"),
    }
    return (
        df.withColumns({"traffic_num": traffic, "weather_num": weather})
        .withColumns({
            **{name: _c(a) * _c(b) for name, (a, b) in factors.items()},
            "rain_high_traffic": flag(_c("weather_condition").isin("Rain", "Heavy Rain") & jammed),
            "high_delay_high_traffic": flag((_c("delay_rate") > 0.1) & jammed),
            "night_x_high_traffic": flag((_c("is_night_ride") == 1) & jammed),
        })
    )


def add_outcome_interactions(df: DataFrame) -> DataFrame:
    """Interactions on encoded columns; each is added only when its inputs are there."""
    have = set(df.columns)
    recipes: dict[str, tuple[tuple[str, ...], Column]] = {
        "demand_x_unreliable": (
            ("demand_enc", "is_unreliable_driver"), _c("is_unreliable_driver") * _c("demand_enc")),
        "demand_x_low_acceptance": (
            ("demand_enc", "acceptance_rate"), _c("demand_enc") * (1 - _c("acceptance_rate"))),
        "demand_x_incomplete_rate": (
            ("demand_enc", "driver_incomplete_rides", "total_assigned_rides"),
            _c("demand_enc") * _c("driver_incomplete_rides") / (_c("total_assigned_rides") + 1)),
        "ride_difficulty": (
            ("ride_distance_km", "is_night_ride", "weather_enc"),
            _c("ride_distance_km") * _c("is_night_ride") * _c("weather_enc")),
        "distance_x_traffic": (
            ("ride_distance_km", "traffic_enc"), _c("ride_distance_km") * _c("traffic_enc")),
        "exp_x_distance": (
            ("driver_experience_years", "ride_distance_km"), _c("driver_experience_years") * _c("ride_distance_km")),
        "rating_x_ridetime": (
            ("avg_driver_rating", "estimated_ride_time_min"), _c("avg_driver_rating") * _c("estimated_ride_time_min")),
        "dual_low_rating": (
            ("is_low_rated_customer", "is_low_rated_driver"), _c("is_low_rated_customer") * _c("is_low_rated_driver")),
        "new_cust_x_unreliable": (
            ("is_new_customer", "is_unreliable_driver"), _c("is_new_customer") * _c("is_unreliable_driver")),
        "time_pressure": (
            ("estimated_ride_time_min", "avg_wait_time_min"),
            _c("estimated_ride_time_min") / (_c("avg_wait_time_min") + 1)),
        "peak_x_distance": (
            ("peak_time_flag", "ride_distance_km"), _c("peak_time_flag") * _c("ride_distance_km")),
    }
    return df.withColumns({name: expr for name, (needs, expr) in recipes.items() if have.issuperset(needs)})


def log_transform(df: DataFrame) -> DataFrame:
    def logged(name: str) -> Column:
        return F.log1p(clip_low(_c(name).cast("double"), F.lit(0.0)))

    made = {c: logged(c) for c in LOG_COLUMNS if c in df.columns}
    if "booking_value" in df.columns:
        made["booking_value_log"] = logged("booking_value")
    return df.withColumns(made)


def drop_raw_columns(df: DataFrame, keep: tuple[str, ...] = ("booking_id",)) -> DataFrame:
    """Drop the raw columns; the booking key stays because rows have no position to be found by."""
    return df.drop(*[c for c in RAW_COLUMNS if c not in keep])
