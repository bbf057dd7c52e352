"""Explicit schemas of the ride tables; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "BIGINT": T.LongType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(), "STRING": T.StringType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _schema(columns: str) -> T.StructType:
    """A schema from 'name TYPE, ...' that needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


BOOKINGS = _schema("""
    booking_id BIGINT, customer_id STRING, driver_id STRING, city STRING, pickup_location STRING, drop_location STRING,
    vehicle_type STRING, day_of_week STRING, is_weekend INT, hour_of_day INT, booking_datetime TIMESTAMP_NTZ,
    booking_status STRING, incomplete_ride_reason STRING, traffic_level STRING, weather_condition STRING,
    ride_distance_km DOUBLE, estimated_ride_time_min DOUBLE, actual_ride_time_min DOUBLE, base_fare DOUBLE,
    surge_multiplier DOUBLE, booking_value DOUBLE, actual_time_available INT, same_loc_flag INT""")

RAW_BOOKINGS = _schema("""
    booking_id STRING, booking_date STRING, booking_time STRING, city STRING, pickup_location STRING,
    drop_location STRING, vehicle_type STRING, traffic_level STRING, weather_condition STRING, booking_status STRING,
    incomplete_ride_reason STRING, hour_of_day INT, ride_distance_km DOUBLE, estimated_ride_time_min DOUBLE,
    actual_ride_time_min DOUBLE, base_fare DOUBLE, surge_multiplier DOUBLE, booking_value DOUBLE,
    customer_id STRING, driver_id STRING""")

CUSTOMERS = _schema("""
    customer_id STRING, customer_gender STRING, customer_age INT, customer_city STRING, customer_signup_days_ago INT,
    preferred_vehicle_type STRING, total_bookings BIGINT, completed_rides BIGINT, cancelled_rides BIGINT,
    incomplete_rides BIGINT, cancellation_rate DOUBLE, avg_customer_rating DOUBLE, customer_cancel_flag INT""")

DRIVERS = _schema("""
    driver_id STRING, driver_age INT, driver_city STRING, vehicle_type STRING, driver_experience_years INT,
    total_assigned_rides BIGINT, accepted_rides BIGINT, rejected_rides BIGINT, incomplete_rides BIGINT,
    delay_count BIGINT, acceptance_rate DOUBLE, delay_rate DOUBLE, avg_driver_rating DOUBLE,
    avg_pickup_delay_min DOUBLE, driver_delay_flag INT, experience_outlier_flag INT""")

LOCATION_DEMAND = _schema("""
    city STRING, pickup_location STRING, hour_of_day INT, vehicle_type STRING, total_requests BIGINT,
    completed_rides BIGINT, cancelled_rides BIGINT, avg_wait_time_min DOUBLE, avg_surge_multiplier DOUBLE,
    demand_level STRING""")

TIME_FEATURES = _schema("""
    datetime TIMESTAMP_NTZ, hour_of_day INT, day_of_week STRING, is_weekend INT, is_holiday INT, peak_time_flag INT,
    season STRING""")

PREDICTIONS = _schema("""
    booking_id BIGINT, predicted_at TIMESTAMP_NTZ, model_version STRING, prediction_type STRING, city STRING,
    vehicle_type STRING, hour_of_day INT, ride_distance_km DOUBLE, surge_multiplier DOUBLE, is_weekend INT,
    demand_level STRING, peak_time_flag INT, traffic_level STRING, weather_condition STRING, predicted_fare DOUBLE,
    predicted_ride_time_min DOUBLE, cancel_probability DOUBLE, cancel_risk_tier STRING, uc3_threshold_used DOUBLE,
    recommended_action STRING, actual_completed_flag INT, actual_fare DOUBLE, actual_ride_time_min DOUBLE,
    actual_cancelled_flag INT""")

# The supplied order tables that the ride views are derived from.
SOURCES: dict[str, T.StructType] = {
    "region": _schema("r_regionkey INT, r_name STRING"),
    "nation": _schema("n_nationkey INT, n_name STRING, n_regionkey INT"),
    "customer": _schema("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"),
    "supplier": _schema("s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"),
    "orders": _schema("""
        o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ,
        o_orderpriority STRING"""),
    "lineitem": _schema("""
        l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,
        l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,
        l_shipdate TIMESTAMP_NTZ"""),
}

TABLES: dict[str, T.StructType] = {
    "bookings": BOOKINGS,
    "customers": CUSTOMERS,
    "drivers": DRIVERS,
    "location_demand": LOCATION_DEMAND,
    "time_features": TIME_FEATURES,
    "predictions": PREDICTIONS,
}
RAW_TABLES: dict[str, T.StructType] = {**TABLES, "bookings": RAW_BOOKINGS}
RAW_TABLES.pop("predictions")


def digits_of(text_id: Column) -> Column:
    """The number in an id like 'B_000042'; an id without digits becomes null."""
    return F.regexp_extract(text_id.cast("string"), r"(\d+)", 1).try_cast("bigint")


def known_ride_time(status: Column, minutes: Column) -> Column:
    """Measured minutes of a completed ride, 0 for every other ride and for a missing measurement."""
    return F.when(status == "Completed", F.coalesce(minutes, F.lit(0.0))).otherwise(F.lit(0.0))


def narrow(df: DataFrame, table: str) -> DataFrame:
    """Cast the columns a table shares with its schema to the declared types; NaN becomes null."""
    declared = {f.name: f.dataType for f in TABLES[table]}
    given = dict(df.dtypes)
    out = []
    for name in df.columns:
        column = F.col(name)
        if name not in declared:
            out.append(column)
            continue
        if name == "booking_id":
            column = digits_of(column)
        elif given[name] in ("double", "float"):
            column = F.nanvl(column, F.lit(None).cast(given[name]))
        out.append(column.cast(declared[name]).alias(name))
    return df.select(*out)


def load_form(bookings: DataFrame) -> DataFrame:
    """Bookings as they are loaded for reporting: typed, with the ride-time rule applied."""
    timed = bookings.withColumn(
        "actual_ride_time_min", known_ride_time(F.col("booking_status"), F.col("actual_ride_time_min"))
    )
    return narrow(timed, "bookings")
