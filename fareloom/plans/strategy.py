"""Driver allocation, alerts, surge, driver, revenue and customer reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.exprs import (
    ALLOCATION_BOUNDS, LOWEST_ALLOCATION, SURGE_HIGH, SURGE_MODERATE, completion_tier, driver_score,
    first_reached, half_past_hour_before, percent, round_stable, safe_ratio, score_tier, steady,
)
from fareloom.functions.measures import cancel_rate, completion_rate, in_tier, mean, rides, with_status

# Alert texts in order of urgency.
ALERT_LEVELS = (
    "CRITICAL — Surge + High Cancel Risk",
    "WARNING — High Surge Demand",
    "WARNING — High Cancellation Risk",
    "INFO — Moderate Surge",
)


def _scored_rides(bookings: DataFrame, predictions: DataFrame) -> DataFrame:
    scores = predictions.select("booking_id", "cancel_probability", "cancel_risk_tier")
    return bookings.select("booking_id", "city", "hour_of_day", "driver_id").join(scores, "booking_id")


def driver_demand(bookings: DataFrame, predictions: DataFrame) -> DataFrame:
    """Rides per driver for every city and hour, with the allocation state and the action to take."""
    slots = (
        _scored_rides(bookings, predictions)
        .groupBy("city", "hour_of_day")
        .agg(
            F.countDistinct("driver_id").alias("active_drivers"),
            rides(),
            F.avg("cancel_probability").alias("risk"),
        )
        .withColumn("load", safe_ratio(F.col("total_rides"), F.col("active_drivers")))
        .filter(F.col("load").isNotNull())
    )
    load, risk, hour = F.col("load"), F.col("risk"), F.col("hour_of_day")
    action = (
        F.when((load >= 1.15) & (steady(risk) > 0.25), "Add Drivers Immediately")
        .when(load >= 1.10, "Pre-position Drivers")
        .when(load < 0.95, "Shift Drivers Out")
        .otherwise("Maintain")
    )
    band = (
        F.when(hour.between(7, 10), "Morning Peak").when(hour.between(18, 23), "Evening Peak").otherwise("Off-Peak")
    )
    return (
        slots.select(
            "city", "hour_of_day", "active_drivers", "total_rides",
            round_stable(load, 2).alias("rides_per_driver"),
            round_stable(risk, 3).alias("avg_cancel_risk"),
            round_stable(load * (risk + 1), 2).alias("demand_pressure"),
            band.alias("time_band"),
            first_reached(load, ALLOCATION_BOUNDS, LOWEST_ALLOCATION).alias("allocation_status"),
            action.alias("recommended_action"),
            half_past_hour_before(hour).alias("pre_position_by"),
        )
        .orderBy(F.desc("demand_pressure"), "city", "hour_of_day")
    )


def understaffed_slots(bookings: DataFrame, predictions: DataFrame, above: float = 1.15,
                       limit: int = 30) -> DataFrame:
    """Busiest city and hour slots; the bound applies to the figure rounded to one digit."""
    return (
        _scored_rides(bookings, predictions)
        .groupBy("city", "hour_of_day")
        .agg(
            F.countDistinct("driver_id").alias("active_drivers"),
            rides(),
            round_stable(F.avg("cancel_probability") * 100, 1).alias("avg_cancel_prob_pct"),
            in_tier("High").alias("high_risk_rides"),
        )
        .withColumns({
            "rides_per_driver": round_stable(safe_ratio(F.col("total_rides"), F.col("active_drivers")), 1),
            "pre_position_by": half_past_hour_before(F.col("hour_of_day")),
        })
        .filter(F.col("rides_per_driver") > above)
        .orderBy(F.desc("rides_per_driver"), F.desc("high_risk_rides"), "city", "hour_of_day")
        .limit(limit)
    )


def _to_reassign(predictions: DataFrame) -> DataFrame:
    return predictions.filter(
        (F.col("cancel_risk_tier") == "High") & (F.col("recommended_action") == "Reassign Driver")
    ).select("booking_id", "city", "vehicle_type", "hour_of_day", "cancel_probability", "recommended_action",
             "predicted_fare")


def _replacements(drivers: DataFrame, at_least: float) -> DataFrame:
    score = driver_score(F.col("avg_driver_rating"), F.col("acceptance_rate"), F.col("delay_rate"))
    return drivers.select(
        "driver_id", "driver_city",
        round_stable(F.col("avg_driver_rating"), 2).alias("driver_rating"),
        round_stable(F.col("acceptance_rate"), 2).alias("acceptance_rate"),
        score.alias("replacement_score"),
    ).filter(F.col("replacement_score") >= at_least)


def _paired(bookings_at_risk: DataFrame, replacements: DataFrame) -> DataFrame:
    return (
        bookings_at_risk.join(replacements, F.col("city") == F.col("driver_city"))
        .select(
            "booking_id", "city", "vehicle_type", "hour_of_day",
            round_stable(F.col("cancel_probability") * 100, 1).alias("cancel_prob_pct"),
            "recommended_action",
            round_stable(F.col("predicted_fare"), 2).alias("predicted_fare"),
            F.col("driver_id").alias("best_replacement_driver"),
            "driver_city", "driver_rating", "acceptance_rate", "replacement_score",
        )
    )


def reassignment_candidates(predictions: DataFrame, drivers: DataFrame, bookings_limit: int = 200,
                            drivers_limit: int = 5, min_score: float = 0.8) -> DataFrame:
    """The riskiest bookings paired with those of the best drivers that work in their city."""
    best = _replacements(drivers, min_score).orderBy(F.desc("replacement_score"), "driver_id").limit(drivers_limit)
    at_risk = _to_reassign(predictions).orderBy(F.desc("cancel_probability"), "booking_id").limit(bookings_limit)
    return _paired(at_risk, best).orderBy(F.desc("cancel_prob_pct"), "booking_id", "best_replacement_driver")


def best_driver_per_booking(predictions: DataFrame, drivers: DataFrame, min_score: float = 0.8) -> DataFrame:
    """Every booking to reassign with the single best driver of its city.

    The best driver is an aggregate (a maximum over score and id), so a city with most of the drivers combines
    on the map side. One row per city remains, which Spark broadcasts by its measured size.
    """
    columns = ["driver_id", "driver_rating", "acceptance_rate", "replacement_score"]
    best = (
        _replacements(drivers, min_score)
        .groupBy("driver_city")
        .agg(F.min_by(F.struct(*columns), F.struct(-F.col("replacement_score"), F.col("driver_id"))).alias("d"))
        .select("driver_city", "d.*")
    )
    return _paired(_to_reassign(predictions), best)


def driver_efficiency(bookings: DataFrame, min_rides: int = 5, limit: int = 300) -> DataFrame:
    done = F.col("booking_status") == "Completed"
    return (
        bookings.groupBy("driver_id", "city", "vehicle_type")
        .agg(
            rides(),
            with_status("Completed").alias("completed_rides"),
            completion_rate().alias("_rate"),
            round_stable(F.sum(F.when(done, F.col("booking_value")).otherwise(0.0)), 2).alias("total_earned"),
            mean("surge_multiplier", 2, "avg_surge_worked"),
        )
        .filter(F.col("total_rides") >= min_rides)
        .withColumns({
            "completion_rate_pct": round_stable(F.col("_rate"), 1),
            "driver_tier": completion_tier(F.col("_rate")),
        })
        .drop("_rate")
        .orderBy(F.desc("completion_rate_pct"), F.desc("total_earned"), "driver_id", "city", "vehicle_type")
        .limit(limit)
    )


def driver_tiers(bookings: DataFrame, min_rides: int = 5) -> DataFrame:
    """One row per city and driver with enough rides; the count is 1 in each."""
    return (
        bookings.groupBy("city", "driver_id")
        .agg(rides("_rides"), completion_rate().alias("_rate"))
        .filter(F.col("_rides") >= min_rides)
        .select("city", completion_tier(F.col("_rate")).alias("driver_tier"), F.lit(1).cast("bigint").alias("driver_count"))
        .orderBy("city", "driver_tier")
    )


def driver_tier_rollup(bookings: DataFrame, min_rides: int = 5) -> DataFrame:
    """Drivers per city and tier."""
    return (
        driver_tiers(bookings, min_rides)
        .groupBy("city", "driver_tier")
        .agg(F.sum("driver_count").alias("driver_count"))
        .orderBy("city", "driver_tier")
    )


def alert_level(surge: Column, high_risk: Column) -> Column:
    critical, surge_warning, risk_warning, info = ALERT_LEVELS
    return (
        F.when((surge > SURGE_HIGH) & (high_risk > 5), critical)
        .when(surge > SURGE_HIGH, surge_warning)
        .when(high_risk > 10, risk_warning)
        .when(surge > SURGE_MODERATE, info)
        .otherwise("OK")
    )


def alert_measures() -> list[Column]:
    """The aggregates of an alert slot; the stream uses the same list."""
    return [
        rides("ride_count"),
        mean("surge_multiplier", 2, "avg_surge"),
        in_tier("High").alias("high_risk_count"),
        round_stable(percent(in_tier("High"), F.count(F.lit(1))), 1).alias("high_risk_pct"),
        mean("cancel_probability", 3, "avg_cancel_prob"),
        alert_level(steady(F.avg("surge_multiplier")), in_tier("High")).alias("alert_level"),
    ]


def ops_alerts(predictions: DataFrame) -> DataFrame:
    urgency = F.array_position(F.array(*[F.lit(level) for level in ALERT_LEVELS]), F.col("alert_level"))
    return (
        predictions.groupBy("city", "hour_of_day", "vehicle_type")
        .agg(*alert_measures())
        .filter(F.col("alert_level") != "OK")
        .withColumn("pre_position_by", half_past_hour_before(F.col("hour_of_day")))
        .orderBy(urgency, F.desc("high_risk_count"), "city", "hour_of_day", "vehicle_type")
    )


def surge_strategy(bookings: DataFrame, limit: int = 50) -> DataFrame:
    surge = steady(F.avg("surge_multiplier"))
    advice = (
        F.when(surge > SURGE_HIGH, "Reduce Surge to Retain Riders")
        .when(surge > SURGE_MODERATE, "Monitor — Surge Moderate")
        .otherwise("Normal Operations")
    )
    return (
        bookings.groupBy("hour_of_day", "city")
        .agg(
            round_stable(surge, 3).alias("avg_surge"),
            rides(),
            with_status("Cancelled").alias("cancellations"),
            cancel_rate(),
            advice.alias("recommendation"),
        )
        .orderBy(F.desc("avg_surge"), "hour_of_day", "city")
        .limit(limit)
    )


def driver_performance(drivers: DataFrame, limit: int = 100, rating_scale: float = 1.0) -> DataFrame:
    """Best drivers by score. With scale 1 the score runs to 2.6 and nearly all are 'Elite'; scale 5 keeps it in 0..1."""
    score = driver_score(F.col("avg_driver_rating"), F.col("acceptance_rate"), F.col("delay_rate"), rating_scale)
    return (
        drivers.select(
            "driver_id", F.col("driver_city").alias("city"), "driver_experience_years", "avg_driver_rating",
            "acceptance_rate", "delay_rate", "total_assigned_rides", "accepted_rides",
            score.alias("performance_score"),
            score_tier(score).alias("driver_tier"),
        )
        .orderBy(F.desc_nulls_last("performance_score"), "driver_id")
        .limit(limit)
    )


def revenue_impact(bookings: DataFrame) -> DataFrame:
    done = F.col("booking_status") == "Completed"
    return (
        bookings.groupBy("city")
        .agg(
            with_status("Cancelled").alias("cancelled_rides"),
            mean("booking_value", 2, "avg_booking_value"),
            round_stable(with_status("Cancelled") * F.avg("booking_value"), 2).alias("estimated_lost_revenue"),
            round_stable(F.sum(F.when(done, F.col("booking_value")).otherwise(0.0)), 2).alias("actual_revenue"),
        )
        .orderBy(F.desc("estimated_lost_revenue"), "city")
    )


def customer_segments(customers: DataFrame) -> DataFrame:
    n, rate = F.col("total_bookings"), F.col("cancellation_rate")
    segment = (
        F.when((n >= 20) & (rate < 0.2), "Champion")
        .when((n >= 10) & (rate < 0.3), "Loyal")
        .when((n >= 5) & (rate < 0.4), "Potential")
        .when(rate >= 0.5, "At Risk")
        .otherwise("New / Occasional")
    )
    return (
        customers.groupBy(segment.alias("segment"))
        .agg(
            rides("customer_count"),
            mean("total_bookings", 1, "avg_bookings"),
            mean("cancellation_rate", 3, "avg_cancel_rate"),
            mean("avg_customer_rating", 2, "avg_rating"),
        )
        .orderBy(F.desc("customer_count"), "segment")
    )
