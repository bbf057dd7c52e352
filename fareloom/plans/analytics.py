"""Cancellation, surge and condition reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions.exprs import round_stable
from fareloom.functions.measures import cancel_rate, mean, rides, with_status


def cancel_heatmap(bookings: DataFrame) -> DataFrame:
    return (
        bookings.groupBy("hour_of_day", "day_of_week")
        .agg(rides(), with_status("Cancelled").alias("cancellations"), cancel_rate())
        .orderBy("hour_of_day", "day_of_week")
    )


def surge_by_hour_city(bookings: DataFrame) -> DataFrame:
    return (
        bookings.groupBy("hour_of_day", "city")
        .agg(
            mean("surge_multiplier", 3, "avg_surge"),
            round_stable(F.max("surge_multiplier"), 2).alias("max_surge"),
            rides("ride_count"),
        )
        .orderBy("hour_of_day", "city")
    )


def cancel_probability_by_surge(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy(round_stable(F.col("surge_multiplier"), 1).alias("surge_bucket"))
        .agg(mean("cancel_probability", 4, "avg_cancel_prob"), rides("count"))
        .orderBy("surge_bucket")
    )


def cancel_probability_by_hour(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy("hour_of_day")
        .agg(
            mean("cancel_probability", 4, "avg_cancel_prob"),
            F.sum("actual_cancelled_flag").alias("actual_cancels"),
            rides("total"),
        )
        .orderBy("hour_of_day")
    )


def cancel_probability_by_distance(predictions: DataFrame, below_km: float = 60, step_km: int = 5) -> DataFrame:
    return (
        predictions.filter(F.col("ride_distance_km") < below_km)
        .groupBy((F.floor(F.col("ride_distance_km") / step_km) * step_km).alias("dist_bucket_km"))
        .agg(mean("cancel_probability", 4, "avg_cancel_prob"), rides("count"))
        .orderBy("dist_bucket_km")
    )


def _not_completed(bookings: DataFrame) -> DataFrame:
    return bookings.filter(F.col("booking_status").isin("Cancelled", "Incomplete"))


def cancel_reasons(bookings: DataFrame, limit: int = 30) -> DataFrame:
    reason = F.coalesce("incomplete_ride_reason", F.lit("Not Specified"))
    return (
        _not_completed(bookings)
        .groupBy(reason.alias("reason"), "booking_status")
        .agg(rides("count"))
        .orderBy(F.desc("count"), "reason", "booking_status")
        .limit(limit)
    )


def cancellations_by_party(bookings: DataFrame) -> DataFrame:
    reason = F.col("incomplete_ride_reason")
    party = (
        F.when(reason.ilike("%customer%"), "Customer No Show")
        .when(reason.ilike("%driver%"), "Driver")
        .when(F.col("booking_status") == "Cancelled", "Cancelled By Customer (Assumed)")
        .otherwise("System / Unknown")
    )
    return (
        _not_completed(bookings)
        .groupBy(party.alias("cancelled_by"))
        .agg(rides("count"))
        .orderBy(F.desc("count"), "cancelled_by")
    )


def weekend_comparison(bookings: DataFrame) -> DataFrame:
    return bookings.groupBy("is_weekend").agg(
        rides(), mean("booking_value", 2, "avg_fare"), mean("surge_multiplier", 3, "avg_surge"), cancel_rate()
    )


def weather_impact(bookings: DataFrame) -> DataFrame:
    return (
        bookings.groupBy("weather_condition")
        .agg(rides(), mean("surge_multiplier", 3, "avg_surge"), cancel_rate(), mean("booking_value", 2, "avg_fare"))
        .orderBy(F.desc("total_rides"), "weather_condition")
    )


def traffic_impact(bookings: DataFrame) -> DataFrame:
    """Only rides with a measured time take part, so the cancel rate is 0 as long as cancelled rides have none."""
    overrun = F.col("actual_ride_time_min") - F.col("estimated_ride_time_min")
    return (
        bookings.filter(F.col("actual_ride_time_min") > 0)
        .groupBy("traffic_level")
        .agg(rides(), mean(overrun, 2, "avg_delay_min"), mean("surge_multiplier", 3, "avg_surge"), cancel_rate())
        .orderBy(F.desc("avg_delay_min"), "traffic_level")
    )
