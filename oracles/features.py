"""Check statements for the joins, the row-wise features and the encodings."""

from __future__ import annotations

from oracles.dashboard import REGIONS, WEEKDAYS
from oracles.views import over, rs

ALL_VIEWS = "bookings customers drivers time_features location_demand"

CUSTOMER_SIDE = (
    "customer_gender", "customer_age", "customer_city", "customer_signup_days_ago", "preferred_vehicle_type",
    "total_bookings", "completed_rides", "cancelled_rides", "incomplete_rides", "cancellation_rate",
    "avg_customer_rating", "customer_cancel_flag",
)
DRIVER_SIDE = (
    "driver_age", "driver_city", "driver_experience_years", "total_assigned_rides", "accepted_rides", "delay_count",
    "acceptance_rate", "delay_rate", "avg_driver_rating", "avg_pickup_delay_min", "driver_delay_flag",
    "experience_outlier_flag", "rejected_rides",
)

RIDES = """
rides AS (
  SELECT *, CASE WHEN pickup_location = drop_location THEN 1 ELSE 0 END AS same_loc_flag,
    CASE WHEN actual_ride_time_min IS NOT NULL THEN 1 ELSE 0 END AS actual_time_available FROM bookings)"""


def named(alias: str, names) -> str:
    return ", ".join(f"{alias}.{n}" for n in names)


JOIN_CUSTOMERS = f"SELECT b.*, {named('c', CUSTOMER_SIDE)} FROM rides b LEFT JOIN customers c USING (customer_id)"
JOIN_DRIVERS = (f"SELECT b.*, {named('d', DRIVER_SIDE)}, d.incomplete_rides AS driver_incomplete_rides "
                "FROM rides b LEFT JOIN drivers d USING (driver_id)")
JOIN_TIME = """SELECT b.*, t.peak_time_flag, t.season FROM rides b
LEFT JOIN time_features t ON t.datetime = date_trunc('hour', b.booking_datetime)"""
LOCATION_SIDE = """l.total_requests AS loc_total_requests, l.completed_rides AS loc_completed_rides,
  l.cancelled_rides AS loc_cancelled_rides, l.avg_wait_time_min, l.avg_surge_multiplier, l.demand_level"""
LOCATION_ON = """l.city = b.city AND l.pickup_location = b.pickup_location AND l.hour_of_day = b.hour_of_day
  AND l.vehicle_type = b.vehicle_type"""
JOIN_LOCATION = f"SELECT b.*, {LOCATION_SIDE} FROM rides b LEFT JOIN location_demand l ON {LOCATION_ON}"

WIDE = f"""
wide AS (
  SELECT b.*, {named('c', CUSTOMER_SIDE)}, {named('d', DRIVER_SIDE)}, d.incomplete_rides AS driver_incomplete_rides,
    t.peak_time_flag, t.season, {LOCATION_SIDE}, b.vehicle_type AS ride_vehicle_type
  FROM rides b
  LEFT JOIN customers c ON c.customer_id = b.customer_id
  LEFT JOIN drivers d ON d.driver_id = b.driver_id
  LEFT JOIN time_features t ON t.datetime = date_trunc('hour', b.booking_datetime)
  LEFT JOIN location_demand l ON {LOCATION_ON})"""


def yes(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


def binned(value: str, edges, labels) -> str:
    arms = " ".join(f"WHEN {value} > {lo} AND {value} <= {hi} THEN '{lab}'" for lo, hi, lab in zip(edges, edges[1:], labels))
    return f"CASE {arms} END"


def coded(value: str, labels) -> str:
    return f"CASE {value} " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(labels)) + " END"


ANGLE = "2 * pi() *"
DATETIME = {
    "day_of_week_num": "CAST(isodow(booking_datetime) - 1 AS INT)",
    "booking_month": "CAST(month(booking_datetime) AS INT)",
    "booking_quarter": "CAST(quarter(booking_datetime) AS INT)",
    "booking_week": "CAST(weekofyear(booking_datetime) AS INT)",
    "is_morning_peak": yes("hour_of_day BETWEEN 7 AND 10"),
    "is_evening_peak": yes("hour_of_day BETWEEN 17 AND 21"),
    "is_night_ride": yes("hour_of_day >= 22 OR hour_of_day <= 5"),
    "is_weekend": yes("isodow(booking_datetime) >= 6"),
    "hour_sin": f"sin({ANGLE} hour_of_day / 24)", "hour_cos": f"cos({ANGLE} hour_of_day / 24)",
    "day_sin": f"sin({ANGLE} (isodow(booking_datetime) - 1) / 7)", "day_cos": f"cos({ANGLE} (isodow(booking_datetime) - 1) / 7)",
    "month_sin": f"sin({ANGLE} month(booking_datetime) / 12)", "month_cos": f"cos({ANGLE} month(booking_datetime) / 12)",
}
RIDE = {
    "expected_fare": "base_fare * surge_multiplier",
    "fare_per_km": "base_fare * surge_multiplier / (ride_distance_km + 0.1e0)",
    "fare_per_min": "base_fare * surge_multiplier / (estimated_ride_time_min + 1)",
    "delay_per_km": "delay_rate * avg_pickup_delay_min / (ride_distance_km + 0.1e0)",
}
CUSTOMER = {
    "customer_tenure_years": "customer_signup_days_ago / 365e0",
    "is_new_customer": yes("customer_signup_days_ago < 90"),
    "cancel_to_booking_ratio": "CAST(cancelled_rides AS DOUBLE) / (total_bookings + 1)",
    "cust_completion_rate": "CAST(completed_rides AS DOUBLE) / (total_bookings + 1)",
    "incomplete_ride_share": "CAST(incomplete_rides AS DOUBLE) / (total_bookings + 1)",
    "is_low_rated_customer": yes("avg_customer_rating < 3.5e0"),
    "vehicle_preference_match": yes("preferred_vehicle_type = vehicle_type"),
    "customer_age_bin": binned("customer_age", (0, 25, 35, 50, 100), ("young", "adult", "mid", "senior")),
}
DRIVER = {
    "rejection_rate": "CAST(rejected_rides AS DOUBLE) / (total_assigned_rides + 1)",
    "driver_incomplete_rate": "CAST(driver_incomplete_rides AS DOUBLE) / (accepted_rides + 1)",
    "delay_per_ride": "CAST(delay_count AS DOUBLE) / (accepted_rides + 1)",
    "driver_acceptance_tier": binned("acceptance_rate", ("0e0", "0.6e0", "0.75e0", "0.9e0", "1.01e0"), ("low", "medium", "high", "very_high")),
    "driver_experience_bin": binned("driver_experience_years", (0, 3, 7, 14), ("junior", "mid", "senior")),
    "is_unreliable_driver": yes("delay_rate > 0.15e0 OR acceptance_rate < 0.6e0"),
    "is_low_rated_driver": yes("avg_driver_rating < 3.5e0"),
}
LOCATION = {
    "demand_supply_ratio": "CAST(loc_total_requests AS DOUBLE) / (loc_completed_rides + 1)",
    "location_surge_deviation": "surge_multiplier - avg_surge_multiplier",
    "wait_time_bin": binned("avg_wait_time_min", (0, 5, 10, 20, 999), ("fast", "normal", "slow", "very_slow")),
    "is_high_demand_location": yes("demand_level = 'High'"),
}
TRAFFIC, WEATHER = coded("traffic_level", ("Low", "Medium", "High")), coded("weather_condition", ("Clear", "Rain", "Heavy Rain"))
INTERACTION = {
    "traffic_num": f"1 + {TRAFFIC}", "weather_num": WEATHER,
    "surge_x_distance": "surge_multiplier * ride_distance_km",
    "surge_x_traffic": f"surge_multiplier * (1 + {TRAFFIC})",
    "peak_x_surge": "peak_time_flag * surge_multiplier",
    "base_x_surge": "base_fare * surge_multiplier",
    "traffic_x_ridetime": f"(1 + {TRAFFIC}) * estimated_ride_time_min",
    "weather_x_ridetime": f"{WEATHER} * estimated_ride_time_min",
    "cancel_risk_x_peak": "cancellation_rate * peak_time_flag",
    "cancel_risk_x_night": "cancellation_rate * is_night_ride",
    "delay_x_traffic": f"delay_rate * (1 + {TRAFFIC})",
    "rain_high_traffic": yes("weather_condition <> 'Clear' AND traffic_level = 'High'"),
    "high_delay_high_traffic": yes("delay_rate > 0.1e0 AND traffic_level = 'High'"),
    "night_x_high_traffic": yes("is_night_ride = 1 AND traffic_level = 'High'"),
}
ORDINAL = {
    "is_cancelled": yes("booking_status = 'Cancelled'"),
    "traffic_enc": TRAFFIC, "weather_enc": WEATHER,
    "demand_enc": coded("demand_level", ("Low", "Medium", "High")),
    "booking_status_enc": coded("booking_status", ("Completed", "Cancelled", "Incomplete")),
}
CATEGORY_VALUES = {
    "incomplete_ride_reason": ("App Error", "Customer No-Show", "Driver Delay", "Not Applicable", "Vehicle Issue"),
    "customer_city": REGIONS, "driver_city": REGIONS, "preferred_vehicle_type": ("Auto", "Bike", "Cab"),
    "season": ("Monsoon", "Summer", "Winter"), "day_of_week": tuple(sorted(WEEKDAYS)),
    "vehicle_type": ("Auto", "Bike", "Cab"), "city": REGIONS, "customer_gender": ("Female", "Male", "Non-Binary"),
}
ONE_HOT = {
    f"{'reason' if c == 'incomplete_ride_reason' else c}_{v}": yes(f"{c} = '{v}'")
    for c, values in CATEGORY_VALUES.items() for v in values[1:]
}
BIN_CODES = {
    "driver_experience_enc": coded("driver_experience_bin", ("junior", "mid", "senior")),
    "driver_acceptance_enc": coded("driver_acceptance_tier", ("low", "medium", "high", "very_high")),
    "customer_age_enc": coded("customer_age_bin", ("young", "adult", "mid", "senior")),
    "wait_time_enc": coded("wait_time_bin", ("fast", "normal", "slow", "very_slow")),
}
OUTCOME = {
    "demand_x_unreliable": "is_unreliable_driver * demand_enc",
    "demand_x_low_acceptance": "demand_enc * (1 - acceptance_rate)",
    "demand_x_incomplete_rate": "CAST(demand_enc * driver_incomplete_rides AS DOUBLE) / (total_assigned_rides + 1)",
    "ride_difficulty": "ride_distance_km * is_night_ride * weather_enc",
    "distance_x_traffic": "ride_distance_km * traffic_enc",
    "exp_x_distance": "driver_experience_years * ride_distance_km",
    "rating_x_ridetime": "avg_driver_rating * estimated_ride_time_min",
    "dual_low_rating": "is_low_rated_customer * is_low_rated_driver",
    "new_cust_x_unreliable": "is_new_customer * is_unreliable_driver",
    "time_pressure": "estimated_ride_time_min / (avg_wait_time_min + 1)",
    "peak_x_distance": "peak_time_flag * ride_distance_km",
}
LOGGED = {
    "base_fare": "ln(1 + greatest(base_fare, 0))", "ride_distance_km": "ln(1 + greatest(ride_distance_km, 0))",
    "total_bookings": "ln(1 + greatest(total_bookings, 0))",
    "estimated_ride_time_min": "ln(1 + greatest(estimated_ride_time_min, 0))",
    "booking_value_log": "ln(1 + greatest(booking_value, 0))",
}

# Columns that the feature functions give out as whole numbers or text; all others are rounded in the comparison.
EXACT = {
    "booking_id", "day_of_week_num", "booking_month", "booking_quarter", "booking_week", "traffic_num", "weather_num",
    "customer_age", "customer_signup_days_ago", "cancelled_rides", "incomplete_rides", "customer_cancel_flag",
    "driver_age", "driver_experience_years", "total_assigned_rides", "accepted_rides", "driver_incomplete_rides",
    "delay_count", "driver_delay_flag", "experience_outlier_flag", "rejected_rides", "peak_time_flag",
    "loc_total_requests", "loc_completed_rides", "loc_cancelled_rides", "hour_of_day", "same_loc_flag",
    "ride_vehicle_type", "customer_age_bin", "driver_acceptance_tier", "driver_experience_bin", "wait_time_bin",
    "demand_x_unreliable", "dual_low_rating", "new_cust_x_unreliable", "rain_high_traffic", "high_delay_high_traffic",
    "night_x_high_traffic", "vehicle_preference_match", *ORDINAL, *ONE_HOT, *BIN_CODES,
}


def stage(name: str, source: str, made: dict[str, str], replaced: tuple[str, ...] = ()) -> str:
    base = "* EXCLUDE (" + ", ".join(replaced) + ")" if replaced else "*"
    return f"{name} AS (SELECT {base}, " + ", ".join(f'{e} AS "{n}"' for n, e in made.items()) + f" FROM {source})"


STAGES = [
    RIDES, WIDE,
    stage("f1", "wide", DATETIME, ("is_weekend",)),
    stage("f2", "f1", {**RIDE, **CUSTOMER, **DRIVER, **LOCATION}),
    stage("f3", "f2", INTERACTION),
    stage("f4", "f3", {**ORDINAL, **ONE_HOT, **BIN_CODES}),
    stage("f5", "f4", OUTCOME),
    stage("f6", "f5", LOGGED, tuple(c for c in LOGGED if c != "booking_value_log")),
]


def shown(names, digits: int = 6) -> str:
    flags = ("is_",)
    out = []
    for n in names:
        exact = n in EXACT or n.startswith(flags)
        out.append(f'"{n}"' if exact else f'{rs(chr(34) + n + chr(34), digits)} AS "{n}"')
    return ", ".join(out)


def feature_check(source: str, names) -> str:
    return over(ALL_VIEWS, f"SELECT {shown(['booking_id', *names])} FROM {source}", *STAGES)


# Numeric columns of the engineered frame that come straight from the tables.
CARRIED = (
    "hour_of_day", "surge_multiplier", "booking_value", "same_loc_flag", "customer_age", "customer_signup_days_ago",
    "cancelled_rides", "incomplete_rides", "cancellation_rate", "avg_customer_rating", "customer_cancel_flag",
    "driver_age", "driver_experience_years", "total_assigned_rides", "accepted_rides", "driver_incomplete_rides",
    "delay_count", "acceptance_rate", "delay_rate", "avg_driver_rating", "avg_pickup_delay_min", "driver_delay_flag",
    "experience_outlier_flag", "rejected_rides", "peak_time_flag", "loc_total_requests", "loc_completed_rides",
    "loc_cancelled_rides", "avg_wait_time_min", "avg_surge_multiplier", "ride_vehicle_type",
)
DROPPED = {"cust_completion_rate", "total_bookings", "driver_experience_bin", "driver_acceptance_tier",
           "customer_age_bin", "wait_time_bin", "traffic_num", "weather_num"}
ENGINEERED = [
    n for n in (*CARRIED, *DATETIME, *RIDE, *CUSTOMER, *DRIVER, *LOCATION, *INTERACTION, *ORDINAL, *ONE_HOT,
                *BIN_CODES, *OUTCOME, *LOGGED) if n not in DROPPED
]

STATEMENTS = {
    "j1_with_customers": over("bookings customers", JOIN_CUSTOMERS, RIDES),
    "j2_with_drivers": over("bookings drivers", JOIN_DRIVERS, RIDES),
    "j3_with_time": over("bookings time_features", JOIN_TIME, RIDES),
    "j4_with_location": over("bookings location_demand", JOIN_LOCATION, RIDES),
    "j5_wide_bookings": over(ALL_VIEWS, "SELECT * EXCLUDE (ride_vehicle_type) FROM wide", RIDES, WIDE),
    "j6_with_predictions": over("bookings predictions", """
SELECT b.*, p.cancel_probability, p.cancel_risk_tier, p.recommended_action, p.uc3_threshold_used, p.predicted_fare,
  p.actual_fare, p.actual_completed_flag, p.actual_cancelled_flag
FROM bookings b JOIN predictions p USING (booking_id)"""),
    "j9_align_predictions": over("bookings predictions", f"""
SELECT b.booking_id, {rs('coalesce(p.predicted_fare, m.middle)', 4)} AS predicted_fare
FROM bookings b LEFT JOIN modelled p USING (booking_id)
CROSS JOIN (SELECT median(predicted_fare) AS middle FROM modelled) m""",
        "modelled AS (SELECT * FROM predictions WHERE vehicle_type IN ('Cab', 'Auto'))"),
    "f1_datetime_features": feature_check("f1", DATETIME),
    "f2_ride_features": feature_check("f2", RIDE),
    "f3_customer_features": feature_check("f2", CUSTOMER),
    "f4_driver_features": feature_check("f2", DRIVER),
    "f5_location_features": feature_check("f2", LOCATION),
    "f6_interaction_features": feature_check("f3", INTERACTION),
    "f7_outcome_interactions": feature_check("f5", OUTCOME),
    "f8_log_transform": feature_check("f6", LOGGED),
    "f9_f10_engineered": feature_check("f6", ENGINEERED),
    "f11_peak_flag": over("bookings", f"""
SELECT booking_id, {yes('hour_of_day BETWEEN 7 AND 10 OR hour_of_day BETWEEN 17 AND 21')} AS peak_time_flag FROM bookings"""),
    "e1_e2_ordinal_codes": feature_check("f4", ORDINAL),
    "e3_one_hot": feature_check("f4", ONE_HOT),
    "e4_bin_codes": feature_check("f4", BIN_CODES),
    "e5_booleans_to_int": over("bookings", f"""
SELECT booking_id, {yes("booking_status = 'Completed'")} AS done, {yes('surge_multiplier > 1.05e0')} AS surged FROM bookings"""),
    "e6_tidy_columns": over(ALL_VIEWS, "SELECT booking_id, " + ", ".join(
        f'"{n}" AS "{n.translate({ord(c): "_" for c in "[]<> ,"})}"' for n in ONE_HOT) + " FROM f4", *STAGES),
}
