"""Tables behind the dashboard charts: one more transformation on the named queries, in the same plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.exprs import (
    ALLOCATION_BOUNDS, TIER_ORDER, WEEKDAYS, flag, hour_label, percent, round_stable,
)
from fareloom.functions.measures import cancel_rate, mean, rides
from fareloom.functions.quantiles import exact_quantiles
from fareloom.functions.small import one_row

# Colour bands of the charts, highest first.
CITY_RATE_BANDS = (("red", 30.0), ("amber", 20.0))
MAPE_BANDS = (("red", 15.0), ("amber", 8.0))
PROBABILITY_BANDS = (("High", 0.7), ("Medium", 0.4))
DISTANCE_BANDS = (("High", 30.0), ("Medium", 20.0))
FEW_MATCHES = 5


def _above(value: Column, bands, otherwise: str) -> Column:
    (first, high), (second, low) = bands
    return F.when(value > high, first).when(value > low, second).otherwise(otherwise)


def _from(value: Column, bands, otherwise: str) -> Column:
    (first, high), (second, low) = bands
    return F.when(value >= high, first).when(value >= low, second).otherwise(otherwise)


# Overview page -----------------------------------------------------------------------------------------------------

def overview_rides(bookings: DataFrame, drivers: DataFrame) -> DataFrame:
    """Bookings with the two driver figures of the overview page."""
    figures = drivers.select("driver_id", "avg_pickup_delay_min", "driver_delay_flag")
    return bookings.join(figures, "driver_id", "left").select(
        "booking_id", "city", "hour_of_day", "day_of_week", "is_weekend", "vehicle_type", "ride_distance_km",
        "booking_value", "booking_status", "surge_multiplier", "base_fare", "traffic_level", "weather_condition",
        "booking_datetime", "avg_pickup_delay_min", "driver_delay_flag",
    )


def filter_overview(rides_df: DataFrame, city: str = "All", vehicle_type: str = "All",
                    hours: tuple[int, int] = (0, 23)) -> DataFrame:
    if city != "All":
        rides_df = rides_df.filter(F.col("city") == city)
    if vehicle_type != "All":
        rides_df = rides_df.filter(F.col("vehicle_type") == vehicle_type)
    return rides_df.filter(F.col("hour_of_day").between(*hours))


def kpi_cards(rides_df: DataFrame) -> DataFrame:
    delay = F.coalesce("avg_pickup_delay_min", F.lit(0.0))
    return rides_df.agg(
        rides(),
        F.count_if(F.col("booking_status") == "Completed").alias("completed"),
        F.count_if(F.col("booking_status") == "Cancelled").alias("cancelled"),
        F.coalesce(cancel_rate(), F.lit(0.0)).alias("cancel_rate_pct"),
        mean("booking_value", 2, "avg_fare"),
        mean("surge_multiplier", 3, "avg_surge"),
        mean(delay, 2, "avg_pickup_delay_min"),
    )


def cancel_rate_by_city(rides_df: DataFrame) -> DataFrame:
    return rides_df.groupBy("city").agg(cancel_rate(), rides()).orderBy("cancel_rate_pct", "city")


def status_by_hour(rides_df: DataFrame) -> DataFrame:
    return (
        rides_df.groupBy("hour_of_day")
        .pivot("booking_status", ["Completed", "Cancelled", "Incomplete"])
        .count().fillna(0)
        .orderBy("hour_of_day")
    )


def surge_by_city_vehicle(rides_df: DataFrame) -> DataFrame:
    return (
        rides_df.groupBy("city", "vehicle_type").agg(mean("surge_multiplier", 4, "surge_multiplier"))
        .orderBy("city", "vehicle_type")
    )


def requests_by_city_hour(location_demand: DataFrame) -> DataFrame:
    return (
        location_demand.groupBy("city", "hour_of_day").agg(F.sum("total_requests").alias("total_requests"))
        .orderBy("city", "hour_of_day")
    )


def fare_by_vehicle(rides_df: DataFrame) -> DataFrame:
    middle = exact_quantiles(rides_df, ["booking_value"], [0.5], by=["vehicle_type"])
    return (
        rides_df.groupBy("vehicle_type")
        .agg(mean("booking_value", 2, "mean_fare"), F.count("booking_value").alias("rides"))
        .join(middle.select("vehicle_type", round_stable(F.col("q0"), 2).alias("median_fare")), "vehicle_type", "left")
        .select("vehicle_type", "mean_fare", "median_fare", "rides")
        .orderBy("vehicle_type")
    )


def busiest_cities(city_heatmap: DataFrame, limit: int = 12) -> DataFrame:
    return city_heatmap.orderBy(F.desc("total_rides"), "city").limit(limit)


def city_demand_table(city_heatmap: DataFrame) -> DataFrame:
    return city_heatmap.select(
        "city", "total_rides", "completed", "cancelled", "cancel_rate_pct", "avg_fare", "avg_surge"
    )


def city_rate_bands(city_heatmap: DataFrame) -> DataFrame:
    rate = F.col("cancel_rate_pct")
    return city_heatmap.select("city", "cancel_rate_pct", _above(rate, CITY_RATE_BANDS, "green").alias("band"))


# Analytics page ----------------------------------------------------------------------------------------------------

def cancel_heatmap_grid(cancel_heatmap: DataFrame) -> DataFrame:
    return (
        cancel_heatmap.groupBy("hour_of_day").pivot("day_of_week", list(WEEKDAYS)).avg("cancel_rate_pct")
        .fillna(0.0).orderBy("hour_of_day")
    )


def surge_grid(surge_by_hour_city: DataFrame, cities: Sequence[str]) -> DataFrame:
    """Hour by city; a column for each of the given cities."""
    return (
        surge_by_hour_city.groupBy("hour_of_day").pivot("city", list(cities)).avg("avg_surge").fillna(1.0).orderBy("hour_of_day")
    )


def cancel_rates_by_hour(by_hour: DataFrame) -> DataFrame:
    return by_hour.select(
        "hour_of_day", "actual_cancels",
        round_stable(percent(F.col("actual_cancels"), F.col("total")), 4).alias("actual_rate_pct"),
        round_stable(F.col("avg_cancel_prob") * 100, 4).alias("predicted_rate_pct"),
    )


def top_reasons(cancel_reasons: DataFrame, limit: int = 10) -> DataFrame:
    return (
        cancel_reasons.groupBy("reason").agg(F.sum("count").alias("count"))
        .orderBy(F.desc("count"), "reason").limit(limit)
    )


def weekend_table(weekend_comparison: DataFrame) -> DataFrame:
    name = F.when(F.col("is_weekend") == 1, "Weekend").when(F.col("is_weekend") == 0, "Weekday")
    return weekend_comparison.select(name.alias("period"), "total_rides", "avg_fare", "cancel_rate_pct", "avg_surge")


def distance_bands(by_distance: DataFrame) -> DataFrame:
    share = F.col("avg_cancel_prob") * 100
    return by_distance.select("dist_bucket_km", "avg_cancel_prob", _from(share, DISTANCE_BANDS, "Low").alias("band"))


# Predictions page --------------------------------------------------------------------------------------------------

def tier_grid(risk_by_city: DataFrame) -> DataFrame:
    return risk_by_city.groupBy("city").pivot("cancel_risk_tier", list(TIER_ORDER)).sum("count").fillna(0).orderBy("city")


def confusion_grid(cancel_confusion: DataFrame) -> DataFrame:
    actual = F.when(F.col("actual_cancelled_flag") == 0, "Not Cancelled").otherwise("Cancelled")
    predicted = F.when(F.col("predicted_cancelled") == 0, "Predicted: No").otherwise("Predicted: Yes")
    return (
        cancel_confusion.select(actual.alias("actual"), predicted.alias("predicted"), "count")
        .groupBy("actual").pivot("predicted", ["Predicted: No", "Predicted: Yes"]).sum("count").fillna(0)
        .orderBy("actual")
    )


def few_matches(live_inference: DataFrame) -> DataFrame:
    return live_inference.withColumn("few_matches", flag(F.col("matched_bookings") < FEW_MATCHES))


def probability_bands(histogram: DataFrame) -> DataFrame:
    return histogram.withColumn("band", _from(F.col("prob_bucket"), PROBABILITY_BANDS, "Low"))


def mape_bands(fare_accuracy: DataFrame) -> DataFrame:
    return fare_accuracy.select("city", "mape_pct", _above(F.col("mape_pct"), MAPE_BANDS, "green").alias("band"))


# Strategy page -----------------------------------------------------------------------------------------------------

def alert_counts(ops_alerts: DataFrame) -> DataFrame:
    level = F.col("alert_level")
    return ops_alerts.agg(
        F.count_if(level.startswith("CRITICAL")).alias("critical"),
        F.count_if(level.startswith("WARNING")).alias("warning"),
        F.count_if(level.startswith("INFO")).alias("info"),
    )


def alert_table(ops_alerts: DataFrame) -> DataFrame:
    return ops_alerts.select(
        F.element_at(F.split("alert_level", " "), 1).alias("level"), "city",
        hour_label(F.col("hour_of_day")).alias("hour"), "vehicle_type", "ride_count", "high_risk_count",
        "high_risk_pct", "avg_surge", "pre_position_by",
    )


def demand_status_grid(driver_demand: DataFrame, cities: Sequence[str]) -> DataFrame:
    """Hour by city as a status code 3..0; a slot without rides counts as 0."""
    load = F.coalesce(F.avg("rides_per_driver"), F.lit(0.0))
    (_, high), (_, lean), (_, balanced) = ALLOCATION_BOUNDS
    code = F.when(load >= high, 3).when(load >= lean, 2).when(load >= balanced, 1).otherwise(0)
    return (
        driver_demand.groupBy(hour_label(F.col("hour_of_day")).alias("hour")).pivot("city", list(cities)).agg(code)
        .fillna(0).orderBy("hour")
    )


def risk_grid(segments: DataFrame, cities: Sequence[str]) -> DataFrame:
    """Vehicle by city: the plain mean of the tier means."""
    return (
        segments.groupBy("vehicle_type").pivot("city", list(cities)).agg(round_stable(F.avg("avg_cancel_prob_pct"), 1))
        .orderBy("vehicle_type")
    )


def risk_volume(segments: DataFrame) -> DataFrame:
    return segments.groupBy("cancel_risk_tier", "city").agg(F.sum("ride_count").alias("ride_count"))


def worst_segments(segments: DataFrame, limit: int = 5) -> DataFrame:
    return (
        segments.filter(F.col("cancel_risk_tier") == "High")
        .groupBy("city", "vehicle_type")
        .agg(
            F.sum("ride_count").alias("high_risk_rides"),
            mean("avg_cancel_prob_pct", 2, "avg_prob"),
            mean("avg_predicted_fare", 2, "avg_fare"),
        )
        .orderBy(F.desc("high_risk_rides"), "city", "vehicle_type").limit(limit)
    )


def reassignment_kpis(candidates: DataFrame) -> DataFrame:
    return candidates.agg(
        rides("bookings"), mean("cancel_prob_pct", 1, "avg_cancel_prob_pct"),
        mean("replacement_score", 2, "avg_replacement_score"),
    )


def tier_distribution(efficiency: DataFrame) -> DataFrame:
    return (
        efficiency.groupBy("driver_tier")
        .agg(
            F.count("driver_id").alias("drivers"),
            mean("completion_rate_pct", 2, "avg_completion"),
            mean("total_earned", 2, "avg_earned"),
            mean("total_rides", 2, "avg_rides"),
        )
        .orderBy(F.desc("avg_completion"), "driver_tier")
    )


def revenue_loss(revenue_impact: DataFrame) -> DataFrame:
    lost, earned = F.sum("estimated_lost_revenue"), F.sum("actual_revenue")
    return revenue_impact.agg(
        round_stable(earned, 2).alias("total_actual"),
        round_stable(lost, 2).alias("total_lost"),
        round_stable(percent(lost, lost + earned), 1).alias("loss_rate_pct"),
    )


def equal_width_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts per equal-width bin between the smallest and largest value; the last bin is closed on the right."""
    ends = one_row(df.agg(F.min(column).alias("low"), F.max(column).alias("high")))
    if ends["low"] is None:
        return df.select(F.lit(0).alias("bin"), F.lit(0.0).alias("bin_start"), F.lit(0).cast("bigint").alias("count")).limit(0)
    low, span = float(ends["low"]), float(ends["high"]) - float(ends["low"])
    place = F.floor((F.col(column) - low) / span * bins) if span > 0 else F.lit(0).cast("bigint")
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(rides("count"))
        .select("bin", round_stable(F.lit(low) + F.col("bin") * (span / bins), 4).alias("bin_start"), "count")
        .orderBy("bin")
    )


def score_histogram(driver_performance: DataFrame, bins: int = 20) -> DataFrame:
    return equal_width_histogram(driver_performance, "performance_score", bins)
