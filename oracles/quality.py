"""Check statements for profiling, data quality, cleaning and the table readers and writers."""

from __future__ import annotations

from oracles.views import over, rs

FIVE = ("bookings", "customers", "drivers", "location_demand", "time_features")
WIDTHS = {"bookings": 21, "customers": 13, "drivers": 16, "location_demand": 10, "time_features": 7, "raw_bookings": 20}

BOOKING_TYPES = {
    "booking_id": "bigint", "customer_id": "bigint", "driver_id": "bigint", "city": "string",
    "pickup_location": "string", "drop_location": "string", "vehicle_type": "string", "hour_of_day": "int",
    "booking_datetime": "timestamp_ntz", "booking_status": "string", "incomplete_ride_reason": "string",
    "traffic_level": "string", "weather_condition": "string", "ride_distance_km": "double",
    "surge_multiplier": "double", "base_fare": "double", "booking_value": "double",
    "estimated_ride_time_min": "double", "actual_ride_time_min": "double", "day_of_week": "string", "is_weekend": "int",
}
RAW_COLUMNS = (
    "booking_id", "booking_date", "booking_time", "city", "pickup_location", "drop_location", "vehicle_type",
    "traffic_level", "weather_condition", "booking_status", "incomplete_ride_reason", "hour_of_day",
    "ride_distance_km", "estimated_ride_time_min", "actual_ride_time_min", "base_fare", "surge_multiplier",
    "booking_value", "customer_id", "driver_id",
)
RAW_TEXT = RAW_COLUMNS[:11]
TYPES = {
    "bookings": BOOKING_TYPES,
    "customers": {
        "customer_id": "bigint", "customer_gender": "string", "customer_age": "int", "customer_city": "string",
        "customer_signup_days_ago": "int", "preferred_vehicle_type": "string", "total_bookings": "bigint",
        "completed_rides": "bigint", "cancelled_rides": "bigint", "incomplete_rides": "bigint",
        "cancellation_rate": "double", "avg_customer_rating": "double", "customer_cancel_flag": "int",
    },
    "drivers": {
        "driver_id": "bigint", "driver_age": "int", "driver_city": "string", "vehicle_type": "string",
        "driver_experience_years": "int", "total_assigned_rides": "bigint", "accepted_rides": "bigint",
        "rejected_rides": "bigint", "incomplete_rides": "bigint", "delay_count": "bigint",
        "acceptance_rate": "double", "delay_rate": "double", "avg_driver_rating": "double",
        "avg_pickup_delay_min": "double", "driver_delay_flag": "int", "experience_outlier_flag": "int",
    },
    "location_demand": {
        "city": "string", "pickup_location": "string", "hour_of_day": "int", "vehicle_type": "string",
        "total_requests": "bigint", "completed_rides": "bigint", "cancelled_rides": "bigint",
        "avg_wait_time_min": "double", "avg_surge_multiplier": "double", "demand_level": "string",
    },
    "time_features": {
        "datetime": "timestamp_ntz", "hour_of_day": "int", "day_of_week": "string", "is_weekend": "int",
        "is_holiday": "int", "peak_time_flag": "int", "season": "string",
    },
    "raw_bookings": {
        c: "string" if c in RAW_TEXT else "int" if c == "hour_of_day" else "bigint" if c in ("customer_id", "driver_id") else "double"
        for c in RAW_COLUMNS
    },
}
EVERY = " ".join(TYPES)


def union(parts) -> str:
    return "\nUNION ALL ".join(parts)


def summary(table: str, column: str, digits: int = 4) -> str:
    def q(p: float) -> str:
        return rs(f"quantile_cont(CAST({column} AS DOUBLE), {p})", digits)
    return (f"SELECT '{table}' AS table_name, '{column}' AS \"column\", count({column}) AS count, {rs(f'avg({column})', digits)} AS mean, "
            f"{rs(f'stddev_samp({column})', digits)} AS std, CAST(min({column}) AS DOUBLE) AS min, "
            f"CAST(max({column}) AS DOUBLE) AS max, {q(0.25)} AS q25, {q(0.5)} AS q50, {q(0.75)} AS q75 FROM {table}")


VALUE_COUNTS = "value_counts AS (" + union(
    f"SELECT '{t}' AS table_name, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {t} GROUP BY {c}"
    for t, kinds in TYPES.items() for c, k in kinds.items() if k == "string") + ")"


def off(observed: str, expected: str, tolerance: str) -> str:
    return f"NOT coalesce(abs({observed} - {expected}) <= abs({expected}) * 1e-5 + {tolerance}, false)"


def failures(table: str, failed: str) -> str:
    return over(table, f"SELECT count(*) AS checked, count(*) FILTER (WHERE {failed}) AS failed FROM {table}")


def key(view: str, column: str) -> str:
    return over(view, f"""
SELECT count(*) AS rows, count(DISTINCT {column}) AS distinct_keys, count(*) = count(DISTINCT {column}) AS is_unique
FROM {view}""")


def title(text: str) -> str:
    """Title case of words joined by blanks or hyphens."""
    return (f"array_to_string(list_transform(string_split_regex(replace(trim(lower({text})), '-', '- '), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


def titled(column: str) -> str:
    return f"replace({title(column)}, '- ', '-') AS {column}"


def table_summary(name: str) -> str:
    return (f"SELECT '{name}' AS table_name, count(*) AS rows, {WIDTHS[name]} AS columns, "
            f"(SELECT CAST(sum(n) AS BIGINT) FROM (SELECT unnest([{{counts}}]) AS n FROM {name}) t) AS nulls, "
            f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {name}) d) AS duplicates FROM {name}")


NULLS = {
    "bookings": "CASE WHEN actual_ride_time_min IS NULL THEN 1 ELSE 0 END",
    "customers": "CASE WHEN cancellation_rate IS NULL THEN 1 ELSE 0 END",
    "drivers": "CASE WHEN acceptance_rate IS NULL THEN 1 ELSE 0 END, CASE WHEN delay_rate IS NULL THEN 1 ELSE 0 END",
    "location_demand": "0", "time_features": "0",
    "raw_bookings": "CASE WHEN actual_ride_time_min IS NULL THEN 1 ELSE 0 END, "
                    "CASE WHEN incomplete_ride_reason IS NULL THEN 1 ELSE 0 END",
}

CATEGORIES = "city, vehicle_type, traffic_level, weather_condition, booking_status".split(", ")

CLEAN_BOOKINGS = f"""
clean AS (
  SELECT DISTINCT booking_id, {titled('city')}, pickup_location, drop_location, {titled('vehicle_type')},
    {titled('traffic_level')}, {titled('weather_condition')}, {titled('booking_status')},
    coalesce(replace({title('incomplete_ride_reason')}, '- ', '-'), 'Not Applicable') AS incomplete_ride_reason,
    hour_of_day, ride_distance_km, estimated_ride_time_min, actual_ride_time_min, base_fare, surge_multiplier,
    booking_value, customer_id, driver_id,
    CAST(booking_date || ' ' || booking_time AS TIMESTAMP) AS booking_datetime,
    CASE WHEN actual_ride_time_min IS NULL THEN 0 ELSE 1 END AS actual_time_available,
    CASE WHEN pickup_location = drop_location THEN 1 ELSE 0 END AS same_loc_flag
  FROM raw_bookings)"""

ALL_FIVE = " ".join(FIVE)

STATEMENTS = {
    "d1_shapes": over(ALL_FIVE, union(
        f"SELECT '{n}' AS table_name, count(*) AS rows, {WIDTHS[n]} AS columns FROM {n}" for n in FIVE)),
    "d2_column_info": over(EVERY, union(
        f"SELECT '{t}' AS table_name, '{c}' AS \"column\", '{k}' AS dtype, count({c}) AS non_null FROM {t}"
        for t, kinds in TYPES.items() for c, k in kinds.items())),
    "d3_null_counts": over(EVERY, union(
        f"SELECT '{t}' AS table_name, '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM {t}"
        for t, kinds in TYPES.items() for c in kinds)),
    "d4_duplicate_rows": over("raw_bookings", """
SELECT (SELECT count(*) FROM raw_bookings) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_bookings) t) AS duplicates"""),
    "d5_booking_key_check": key("bookings", "booking_id"),
    "d5_raw_booking_key_check": key("raw_bookings", "booking_id"),
    "d5_driver_key_check": key("drivers", "driver_id"),
    "d6_numeric_summary": over(EVERY, union(
        summary(t, c) for t, kinds in TYPES.items() for c, k in kinds.items() if k in ("bigint", "int", "double"))),
    "d7_categorical_summary": over(EVERY, """
SELECT table_name, "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique", first(value ORDER BY n DESC, value) AS top, max(n) AS freq
FROM value_counts WHERE value IS NOT NULL GROUP BY table_name, "column" """, VALUE_COUNTS),
    "d8_top_values": over(EVERY, """
SELECT table_name, "column", value, n AS count, CAST(place AS INT) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name, "column" ORDER BY n DESC, value NULLS LAST) AS place FROM value_counts) t
WHERE place <= 10 AND "column" NOT IN ('booking_id', 'booking_date', 'booking_time')""", VALUE_COUNTS),
    "d9_nulls_by_group": over("raw_bookings", """
SELECT booking_status, count(*) - count(incomplete_ride_reason) AS nulls FROM raw_bookings GROUP BY booking_status"""),
    "d10_booking_value_check": failures("bookings", off("booking_value", rs("base_fare * surge_multiplier", 2), "1e0")),
    "d11_customer_age_check": failures("customers", "customer_age NOT BETWEEN 18 AND 80"),
    "d11_driver_age_check": failures("drivers", "driver_age NOT BETWEEN 18 AND 65"),
    "d12_cancellation_rate_check": failures("customers", off(
        "cancellation_rate", rs("CAST(cancelled_rides AS DOUBLE) / nullif(total_bookings, 0)", 6), "1e-3")),
    "d13_total_bookings_check": failures("customers", "total_bookings <> completed_rides + cancelled_rides + incomplete_rides"),
    "d14_driver_rate_checks": over("drivers", f"""
SELECT count(*) AS checked,
  count(*) FILTER (WHERE {off('acceptance_rate', rs('CAST(accepted_rides AS DOUBLE) / nullif(total_assigned_rides, 0)', 2), '1e-2')}) AS acceptance_failed,
  count(*) FILTER (WHERE {off('delay_rate', rs('CAST(delay_count AS DOUBLE) / nullif(total_assigned_rides, 0)', 2), '1e-2')}) AS delay_failed
FROM drivers"""),
    "d15_rejected_rides_check": over("drivers", summary("drivers", "rejected_rides", 2).replace("'drivers' AS table_name, ", "").replace(
        " FROM drivers", ", count(*) FILTER (WHERE rejected_rides < 0) AS negative FROM drivers")),
    "d16_requests_check": failures("location_demand", "completed_rides + cancelled_rides > total_requests"),
    "d17_constant_check": over("time_features", """
SELECT min(is_holiday) AS smallest, max(is_holiday) AS largest, CAST(sum(is_holiday) AS BIGINT) AS total,
  min(is_holiday) = max(is_holiday) AS is_constant FROM time_features"""),
    "d18_final_summary": over(ALL_FIVE + " raw_bookings", union(
        table_summary(n).format(counts=NULLS[n]) for n in (*FIVE, "raw_bookings"))),
    "d19_join_check": over("bookings", """
SELECT count(*) AS rows_before, count(*) AS rows_after, 0 AS suffix_columns, true AS preserved FROM bookings"""),
    "d21_class_balance": over("bookings", f"""
SELECT booking_status, count(*) AS count, {rs('CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM bookings)', 3)} AS share
FROM bookings GROUP BY booking_status"""),
    "c1_combine_date_time": over("raw_bookings", """
SELECT booking_id, CAST(booking_date || ' ' || booking_time AS TIMESTAMP) AS booking_datetime FROM raw_bookings"""),
    "c2_flag_measured_time": over("raw_bookings", """
SELECT booking_id, CASE WHEN actual_ride_time_min IS NULL THEN 0 ELSE 1 END AS actual_time_available FROM raw_bookings"""),
    "c3_fill_reason": over("raw_bookings", """
SELECT booking_id, coalesce(incomplete_ride_reason, 'Not Applicable') AS incomplete_ride_reason FROM raw_bookings"""),
    "c4_standardise": over("raw_bookings", "SELECT booking_id, " + ", ".join(
        titled(c) for c in (*CATEGORIES, "incomplete_ride_reason")) + " FROM raw_bookings"),
    "c4_clean_customers": over("customers", f"""
SELECT DISTINCT customer_id, {titled('customer_gender')}, {titled('customer_city')}, {titled('preferred_vehicle_type')}
FROM customers"""),
    "c5_drop_repeated_rows": over("raw_bookings", "SELECT DISTINCT * FROM raw_bookings"),
    "c6_flag_same_location": over("raw_bookings", """
SELECT booking_id, CASE WHEN pickup_location = drop_location THEN 1 ELSE 0 END AS same_loc_flag FROM raw_bookings"""),
    "c7_c8_clean_drivers": over("drivers", f"""
SELECT * EXCLUDE (rejected_rides, driver_city, vehicle_type), {titled('driver_city')}, {titled('vehicle_type')},
  total_assigned_rides - accepted_rides AS rejected_rides FROM drivers"""),
    "c_clean_bookings": over("raw_bookings", "SELECT * FROM clean", CLEAN_BOOKINGS),
    "c_clean_location_demand": over("location_demand", f"""
SELECT {titled('city')}, pickup_location, hour_of_day, vehicle_type, total_requests, demand_level FROM location_demand"""),
    "c_clean_time_features": over("time_features", "SELECT * FROM time_features"),
    "s1_raw_csv": over("raw_bookings", """
SELECT * REPLACE (CAST(customer_id AS VARCHAR) AS customer_id, CAST(driver_id AS VARCHAR) AS driver_id) FROM raw_bookings"""),
    "s1_raw_customers": over("customers", "SELECT * REPLACE (CAST(customer_id AS VARCHAR) AS customer_id) FROM customers"),
    "s1_raw_drivers": over("drivers", "SELECT * REPLACE (CAST(driver_id AS VARCHAR) AS driver_id) FROM drivers"),
    "s1_raw_location_demand": over("location_demand", "SELECT * FROM location_demand"),
    "s1_raw_time_features": over("time_features", "SELECT * FROM time_features"),
    "s7_append_all": over(ALL_FIVE, union(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in FIVE)),
    "s2_s3_cleaned_tables": over(ALL_FIVE, union(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in FIVE)),
    "s5_typed_bookings": over("raw_bookings", """
SELECT * REPLACE (CAST(substr(booking_id, 3) AS BIGINT) AS booking_id, CAST(customer_id AS VARCHAR) AS customer_id,
  CAST(driver_id AS VARCHAR) AS driver_id) FROM clean""", CLEAN_BOOKINGS),
    "s6_known_ride_time": over("bookings", """
SELECT booking_id, booking_status, coalesce(actual_ride_time_min, 0e0) AS actual_ride_time_min FROM bookings"""),
    "s7_append": over("location_demand", "SELECT demand_level, count(*) AS count FROM location_demand GROUP BY demand_level"),
    "s8_replace_predictions": over("predictions", "SELECT cancel_risk_tier, count(*) AS count FROM predictions GROUP BY ALL"),
    "s8_versioned_predictions": over("predictions", """
SELECT 'v1' AS model_version, cancel_risk_tier, count(*) AS count FROM predictions GROUP BY ALL
UNION ALL SELECT 'v2', cancel_risk_tier, count(*) FROM predictions WHERE cancel_risk_tier <> 'Low' GROUP BY ALL"""),
    "s4_typed_tables": over("predictions location_demand", """
SELECT 'location_demand' AS table_name, count(*) AS row_count FROM location_demand
UNION ALL SELECT 'predictions', count(*) FROM predictions UNION ALL SELECT 'bookings', 0 UNION ALL SELECT 'customers', 0
UNION ALL SELECT 'drivers', 0 UNION ALL SELECT 'time_features', 0"""),
    "s11_cached_query": over("bookings", "SELECT city, count(*) AS rides FROM bookings GROUP BY city"),
    "s9_row_counts": over(ALL_FIVE + " predictions", union(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in (*FIVE, "predictions"))),
    "s10_run_query": over("bookings", """
SELECT vehicle_type, count(*) AS rides FROM bookings WHERE city = 'EUROPE' AND hour_of_day BETWEEN 6 AND 12
GROUP BY vehicle_type"""),
}
