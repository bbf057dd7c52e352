"""Shared lists and the overview reports. All read `bookings` once and aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fareloom.functions.exprs import percent, round_stable
from fareloom.functions.measures import cancel_rate, mean, rides, with_status


def cities(bookings: DataFrame) -> DataFrame:
    return bookings.select("city").distinct().orderBy("city")


def vehicle_types(bookings: DataFrame) -> DataFrame:
    return bookings.select("vehicle_type").distinct().orderBy("vehicle_type")


def date_range(bookings: DataFrame) -> DataFrame:
    return bookings.agg(
        F.min("booking_datetime").alias("min_date"), F.max("booking_datetime").alias("max_date")
    )


def kpi_summary(bookings: DataFrame) -> DataFrame:
    overrun = F.when(
        F.col("actual_ride_time_min") > 0, F.col("actual_ride_time_min") - F.col("estimated_ride_time_min")
    )
    return bookings.agg(
        rides(),
        mean("booking_value", 2, "avg_fare"),
        cancel_rate(),
        mean(overrun, 2, "avg_delay_min"),
        mean("surge_multiplier", 3, "avg_surge"),
        with_status("Completed").alias("completed_rides"),
        with_status("Cancelled").alias("cancelled_rides"),
        F.count_if(~F.col("booking_status").isin("Completed", "Cancelled")).alias("incomplete_rides"),
    )


def _ride_profile(bookings: DataFrame, key: str) -> DataFrame:
    return bookings.groupBy(key).agg(
        rides(),
        with_status("Completed").alias("completed"),
        with_status("Cancelled").alias("cancelled"),
        cancel_rate(),
        mean("booking_value", 2, "avg_fare"),
        mean("surge_multiplier", 3, "avg_surge"),
    )


def city_heatmap(bookings: DataFrame) -> DataFrame:
    return _ride_profile(bookings, "city").orderBy(F.desc("total_rides"), "city")


def hourly_trends(bookings: DataFrame) -> DataFrame:
    return _ride_profile(bookings, "hour_of_day").orderBy("hour_of_day")


def pickup_demand(bookings: DataFrame) -> DataFrame:
    # The window runs over one row per (city, location), not over rides.
    in_city = Window.partitionBy("city")
    return (
        bookings.groupBy("city", "pickup_location")
        .agg(rides("ride_count"))
        .withColumn("pct_of_city", round_stable(percent(F.col("ride_count"), F.sum("ride_count").over(in_city)), 1))
        .orderBy("city", F.desc("ride_count"), "pickup_location")
    )


def vehicle_breakdown(bookings: DataFrame) -> DataFrame:
    return (
        bookings.groupBy("vehicle_type")
        .agg(
            rides(),
            mean("booking_value", 2, "avg_fare"),
            mean("ride_distance_km", 2, "avg_dist_km"),
            cancel_rate(),
        )
        .orderBy(F.desc("total_rides"), "vehicle_type")
    )


def status_distribution(bookings: DataFrame) -> DataFrame:
    return bookings.groupBy("booking_status").agg(rides("count"))
