"""Catalog entries of the profiling, data-quality and cleaning operators."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.operators import cleaning, joins, quality
from fareloom.sources.ride_views import RideTables


def five_tables(t: RideTables) -> dict[str, DataFrame]:
    return {
        "bookings": t.bookings, "customers": t.customers, "drivers": t.drivers,
        "location_demand": t.location_demand, "time_features": t.time_features,
    }


def _untidy_customers(t: RideTables) -> DataFrame:
    return t.customers.select("customer_id", F.lower("customer_gender").alias("customer_gender"),
                              F.concat(F.lit(" "), F.lower("customer_city")).alias("customer_city"),
                              F.upper("preferred_vehicle_type").alias("preferred_vehicle_type"))


def _keyed_by(t: RideTables, name: str, key: str) -> DataFrame:
    return quality.key_check(getattr(t, name), key)


def _of_each_table(t: RideTables, report: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A report over the five tables and the raw bookings, one after another."""
    parts = [report(df).withColumn("table_name", F.lit(name)) for name, df in {**five_tables(t), "raw_bookings": t.raw_bookings}.items()]
    return reduce(DataFrame.unionByName, parts)


def _top_values(df: DataFrame) -> DataFrame:
    """Of a table of bookings its categories, of another one every text column."""
    bookings = "booking_status" in df.columns
    return quality.top_values(df, [c for c in quality.BOOKING_CATEGORIES if c in df.columns] if bookings else None)


ENTRIES: dict[str, Callable[[RideTables], DataFrame]] = {
    "d1_shapes": lambda t: quality.shapes(five_tables(t)),
    "d2_column_info": lambda t: _of_each_table(t, quality.column_info),
    "d3_null_counts": lambda t: _of_each_table(t, quality.null_counts),
    "d4_duplicate_rows": lambda t: quality.duplicate_rows(t.raw_bookings),
    "d5_booking_key_check": lambda t: _keyed_by(t, "bookings", "booking_id"),
    "d5_raw_booking_key_check": lambda t: _keyed_by(t, "raw_bookings", "booking_id"),
    "d5_driver_key_check": lambda t: _keyed_by(t, "drivers", "driver_id"),
    "d6_numeric_summary": lambda t: _of_each_table(t, quality.numeric_summary),
    "d7_categorical_summary": lambda t: _of_each_table(t, quality.categorical_summary),
    "d8_top_values": lambda t: _of_each_table(t, _top_values),
    "d9_nulls_by_group": lambda t: quality.nulls_by_group(t.raw_bookings, "booking_status", "incomplete_ride_reason"),
    "d10_booking_value_check": lambda t: quality.booking_value_check(t.bookings),
    "d11_customer_age_check": lambda t: quality.age_check(t.customers, "customer_age", 18, 80),
    "d11_driver_age_check": lambda t: quality.age_check(t.drivers, "driver_age", 18, 65),
    "d12_cancellation_rate_check": lambda t: quality.cancellation_rate_check(t.customers),
    "d13_total_bookings_check": lambda t: quality.total_bookings_check(t.customers),
    "d14_driver_rate_checks": lambda t: quality.driver_rate_checks(t.drivers),
    "d15_rejected_rides_check": lambda t: quality.rejected_rides_check(t.drivers),
    "d16_requests_check": lambda t: quality.requests_check(t.location_demand),
    "d17_constant_check": lambda t: quality.constant_check(t.time_features, "is_holiday"),
    "d18_final_summary": lambda t: quality.final_summary({**five_tables(t), "raw_bookings": t.raw_bookings}),
    "d19_join_check": lambda t: quality.join_check(t.bookings, joins.with_location(t.bookings, t.location_demand)),
    "d21_class_balance": lambda t: quality.class_balance(t.bookings, "booking_status"),
    "c1_combine_date_time": lambda t: cleaning.combine_date_time(t.raw_bookings).select("booking_id", "booking_datetime"),
    "c2_flag_measured_time": lambda t: cleaning.flag_measured_time(t.raw_bookings).select("booking_id", "actual_time_available"),
    "c3_fill_reason": lambda t: cleaning.fill_reason(t.raw_bookings).select("booking_id", "incomplete_ride_reason"),
    "c4_standardise": lambda t: cleaning.standardise(t.raw_bookings, cleaning.CATEGORIES["bookings"]).select(
        "booking_id", *cleaning.CATEGORIES["bookings"]),
    "c4_clean_customers": lambda t: cleaning.clean_customers(_untidy_customers(t)),
    "c5_drop_repeated_rows": lambda t: cleaning.drop_repeated_rows(t.raw_bookings),
    "c6_flag_same_location": lambda t: cleaning.flag_same_location(t.raw_bookings).select("booking_id", "same_loc_flag"),
    "c7_c8_clean_drivers": lambda t: cleaning.clean_drivers(t.drivers.drop("rejected_rides", "experience_outlier_flag")),
    "c_clean_bookings": lambda t: cleaning.clean_bookings(t.raw_bookings),
    "c_clean_location_demand": lambda t: cleaning.clean_location_demand(t.location_demand).select(
        *joins.LOCATION_KEYS, "total_requests", "demand_level"),
    "c_clean_time_features": lambda t: cleaning.clean_time_features(t.time_features),
}
