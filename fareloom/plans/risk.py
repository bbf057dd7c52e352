"""Reports over the scored bookings (`predictions`)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fareloom.functions.exprs import percent, recommended_action, risk_tier, round_stable, steady, tier_rank
from fareloom.functions.measures import in_tier, mean, rides


def _fare_error() -> Column:
    return F.abs(F.col("predicted_fare") - F.col("actual_fare"))


def prediction_kpis(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        rides("total_predictions"),
        mean("predicted_fare", 2, "avg_predicted_fare"),
        mean("actual_fare", 2, "avg_actual_fare"),
        mean(F.when(F.col("actual_completed_flag") == 1, _fare_error()), 2, "avg_fare_mae"),
        round_stable(percent(in_tier("High"), F.count(F.lit(1))), 2).alias("high_risk_pct"),
        in_tier("High").alias("high_risk_count"),
        in_tier("Medium").alias("medium_risk_count"),
        in_tier("Low").alias("low_risk_count"),
    )


def risk_tier_distribution(predictions: DataFrame) -> DataFrame:
    # At most three rows reach the window.
    everything = Window.partitionBy(F.lit(0))
    return (
        predictions.groupBy("cancel_risk_tier")
        .agg(rides("count"))
        .withColumn("pct", round_stable(percent(F.col("count"), F.sum("count").over(everything)), 1))
        .orderBy(tier_rank(F.col("cancel_risk_tier")))
    )


def action_distribution(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy("recommended_action", "cancel_risk_tier")
        .agg(rides("count"))
        .orderBy(F.desc("count"), "recommended_action")
    )


def fare_accuracy_by_city(predictions: DataFrame) -> DataFrame:
    return (
        predictions.filter((F.col("actual_fare") > 0) & (F.col("actual_completed_flag") == 1))
        .groupBy("city")
        .agg(
            mean("predicted_fare", 2, "avg_predicted"),
            mean("actual_fare", 2, "avg_actual"),
            mean(_fare_error(), 2, "mae"),
            round_stable(percent(F.avg(_fare_error()), F.avg("actual_fare")), 1).alias("mape_pct"),
            rides("n"),
        )
        .orderBy(F.desc("mae"), "city")
    )


def risk_by_city(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy("city", "cancel_risk_tier")
        .agg(rides("count"))
        .orderBy("city", tier_rank(F.col("cancel_risk_tier")))
    )


def cancel_probability_histogram(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy((F.floor(F.col("cancel_probability") * 10) / 10).alias("prob_bucket"))
        .agg(rides("count"))
        .orderBy("prob_bucket")
    )


def high_risk_sample(predictions: DataFrame, limit: int = 200) -> DataFrame:
    p = F.col("cancel_probability")
    return (
        predictions.filter(F.col("cancel_risk_tier") == "High")
        .orderBy(p.desc(), "booking_id")
        .limit(limit)
        .select(
            "booking_id", "city", "vehicle_type", "hour_of_day",
            round_stable(F.col("ride_distance_km"), 1).alias("distance_km"),
            round_stable(F.col("surge_multiplier"), 2).alias("surge"),
            round_stable(p * 100, 1).alias("cancel_prob_pct"),
            "cancel_risk_tier", "recommended_action",
            round_stable(F.col("predicted_fare"), 2).alias("predicted_fare"),
            round_stable(F.col("actual_fare"), 2).alias("actual_fare"),
        )
    )


def cancel_confusion(predictions: DataFrame) -> DataFrame:
    flagged = F.when(F.col("cancel_probability") >= F.col("uc3_threshold_used"), 1).otherwise(0)
    return (
        predictions.groupBy("actual_cancelled_flag", flagged.alias("predicted_cancelled")).agg(rides("count"))
    )


def fare_scatter(predictions: DataFrame, seed: int = 42, limit: int = 2000) -> DataFrame:
    """A random sample that is the same on every run: the rows with the smallest hash of key and seed."""
    fare = F.col("actual_fare")
    draw = F.md5(F.concat_ws("-", F.col("booking_id").cast("string"), F.lit(str(seed))))
    return (
        predictions.filter((fare > 0) & (fare < 2000) & (F.col("actual_completed_flag") == 1))
        .orderBy(draw, "booking_id")
        .limit(limit)
        .select(
            round_stable(fare, 2).alias("actual_fare"),
            round_stable(F.col("predicted_fare"), 2).alias("predicted_fare"),
            "city", "vehicle_type", "cancel_risk_tier",
        )
    )


def live_inference(predictions: DataFrame, city: str, vehicle_type: str, hour_of_day: int, traffic_level: str,
                   weather_condition: str, distance_km: float, within_km: float = 5.0) -> DataFrame:
    """Averages over the scored rides that resemble the asked one; no row when nothing matches."""
    alike = predictions.filter(
        (F.col("city") == city)
        & (F.col("vehicle_type") == vehicle_type)
        & (F.col("hour_of_day") == hour_of_day)
        & (F.col("traffic_level") == traffic_level)
        & (F.col("weather_condition") == weather_condition)
        & (F.abs(F.col("ride_distance_km") - distance_km) <= within_km)
    )
    p = F.avg("cancel_probability")
    return alike.groupBy("city", "vehicle_type", "hour_of_day", "traffic_level", "weather_condition").agg(
        mean("ride_distance_km", 1, "ride_distance_km"),
        mean("surge_multiplier", 2, "surge_multiplier"),
        mean("predicted_fare", 2, "predicted_fare"),
        round_stable(p * 100, 1).alias("cancel_probability_pct"),
        round_stable(p, 4).alias("cancel_probability_raw"),
        risk_tier(steady(p)).alias("cancel_risk_tier"),
        recommended_action(risk_tier(steady(p))).alias("recommended_action"),
        F.max("uc3_threshold_used").alias("uc3_threshold_used"),
        rides("matched_bookings"),
    )


def risk_by_city_vehicle(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy("city", "vehicle_type", "cancel_risk_tier")
        .agg(
            rides("ride_count"),
            round_stable(F.avg("cancel_probability") * 100, 2).alias("avg_cancel_prob_pct"),
            mean("predicted_fare", 2, "avg_predicted_fare"),
            mean("surge_multiplier", 3, "avg_surge"),
        )
        .orderBy("city", "vehicle_type", tier_rank(F.col("cancel_risk_tier")))
    )
