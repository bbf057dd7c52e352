"""Cleaning rules of the five delivered tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions.exprs import flag, title_case

# Categorical columns that are standardised, per table.
CATEGORIES = {
    "bookings": ("city", "vehicle_type", "traffic_level", "weather_condition", "booking_status",
                 "incomplete_ride_reason"),
    "customers": ("customer_gender", "customer_city", "preferred_vehicle_type"),
    "drivers": ("driver_city", "vehicle_type"),
    "location_demand": ("city", "vehicle_type", "demand_level"),
    "time_features": ("day_of_week", "season"),
}


def combine_date_time(df: DataFrame) -> DataFrame:
    text = F.concat(F.col("booking_date"), F.lit(" "), F.col("booking_time"))
    return df.withColumn("booking_datetime", F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm:ss"))).drop(
        "booking_date", "booking_time")


def flag_measured_time(df: DataFrame) -> DataFrame:
    return df.withColumn("actual_time_available", flag(F.col("actual_ride_time_min").isNotNull()))


def fill_reason(df: DataFrame) -> DataFrame:
    return df.fillna({"incomplete_ride_reason": "Not Applicable"})


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: title_case(F.col(c)) for c in columns if c in df.columns})


def drop_repeated_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def flag_same_location(df: DataFrame) -> DataFrame:
    return df.withColumn("same_loc_flag", flag(F.col("pickup_location") == F.col("drop_location")))


def flag_experience(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "experience_outlier_flag", flag(F.col("driver_experience_years") > F.col("driver_age") - 18))


def derive_rejected(df: DataFrame) -> DataFrame:
    return df.withColumn("rejected_rides", F.col("total_assigned_rides") - F.col("accepted_rides"))


def clean_bookings(raw: DataFrame) -> DataFrame:
    return (
        raw.transform(combine_date_time)
        .transform(flag_measured_time)
        .transform(fill_reason)
        .transform(standardise, CATEGORIES["bookings"])
        .transform(drop_repeated_rows)
        .transform(flag_same_location)
    )


def clean_customers(raw: DataFrame) -> DataFrame:
    return raw.transform(standardise, CATEGORIES["customers"]).transform(drop_repeated_rows)


def clean_drivers(raw: DataFrame) -> DataFrame:
    return (
        raw.transform(standardise, CATEGORIES["drivers"])
        .transform(flag_experience)
        .transform(derive_rejected)
        .transform(drop_repeated_rows)
    )


def clean_location_demand(raw: DataFrame) -> DataFrame:
    return raw.transform(standardise, CATEGORIES["location_demand"]).transform(drop_repeated_rows)


def clean_time_features(raw: DataFrame) -> DataFrame:
    return (
        raw.withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))
        .transform(standardise, CATEGORIES["time_features"])
        .transform(drop_repeated_rows)
    )
