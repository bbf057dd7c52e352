"""Every query by name: a callable of (spark, data folder) that returns a DataFrame over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fareloom.plans import (
    analytics, dashboard, feature_queries, model_queries, overview, quality_queries, risk, strategy, stream_queries, table_queries,
)
from fareloom.session import compile_in_short_methods
from fareloom.sources.ride_views import StoredRideTables, stored_ride_tables

Query = Callable[[SparkSession, str], DataFrame]

# Parameters used when the live-inference query is run from the catalog.
LIVE_EXAMPLE = {"city": "ASIA", "vehicle_type": "Bike", "hour_of_day": 11, "traffic_level": "High",
                "weather_condition": "Rain", "distance_km": 25.0}


Build = Callable[[StoredRideTables], DataFrame]


def _over(build: Build) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        compile_in_short_methods(spark)
        return build(stored_ride_tables(spark, folder))
    return query


REPORTS: dict[str, Build] = {
    "q0a_cities": lambda t: overview.cities(t.bookings),
    "q0b_vehicle_types": lambda t: overview.vehicle_types(t.bookings),
    "q0c_date_range": lambda t: overview.date_range(t.bookings),
    "q1a_kpi_summary": lambda t: overview.kpi_summary(t.bookings),
    "q1b_city_heatmap": lambda t: overview.city_heatmap(t.bookings),
    "q1c_pickup_demand": lambda t: overview.pickup_demand(t.bookings),
    "q1d_hourly_trends": lambda t: overview.hourly_trends(t.bookings),
    "q1e_vehicle_breakdown": lambda t: overview.vehicle_breakdown(t.bookings),
    "q1f_status_distribution": lambda t: overview.status_distribution(t.bookings),
    "q2a_prediction_kpis": lambda t: risk.prediction_kpis(t.predictions),
    "q2b_risk_tier_distribution": lambda t: risk.risk_tier_distribution(t.predictions),
    "q2c_action_distribution": lambda t: risk.action_distribution(t.predictions),
    "q2d_fare_accuracy_by_city": lambda t: risk.fare_accuracy_by_city(t.predictions),
    "q2e_risk_by_city": lambda t: risk.risk_by_city(t.predictions),
    "q2f_cancel_probability_histogram": lambda t: risk.cancel_probability_histogram(t.predictions),
    "q2g_high_risk_sample": lambda t: risk.high_risk_sample(t.predictions),
    "q2h_cancel_confusion": lambda t: risk.cancel_confusion(t.predictions),
    "q2i_fare_scatter": lambda t: risk.fare_scatter(t.predictions),
    "q2j_live_inference": lambda t: risk.live_inference(t.predictions, **LIVE_EXAMPLE),
    "q3a_cancel_heatmap": lambda t: analytics.cancel_heatmap(t.bookings),
    "q3b_surge_by_hour_city": lambda t: analytics.surge_by_hour_city(t.bookings),
    "q3c_cancel_probability_by_surge": lambda t: analytics.cancel_probability_by_surge(t.predictions),
    "q3d_cancel_probability_by_hour": lambda t: analytics.cancel_probability_by_hour(t.predictions),
    "q3e_cancel_reasons": lambda t: analytics.cancel_reasons(t.bookings),
    "q3f_cancellations_by_party": lambda t: analytics.cancellations_by_party(t.bookings),
    "q3g_cancel_probability_by_distance": lambda t: analytics.cancel_probability_by_distance(t.predictions),
    "q3h_weekend_comparison": lambda t: analytics.weekend_comparison(t.bookings),
    "q3i_weather_impact": lambda t: analytics.weather_impact(t.bookings),
    "q3j_traffic_impact": lambda t: analytics.traffic_impact(t.bookings),
    "q4a_driver_demand": lambda t: strategy.driver_demand(t.bookings, t.predictions),
    "q4b_risk_by_city_vehicle": lambda t: risk.risk_by_city_vehicle(t.predictions),
    "q4c_reassignment_candidates": lambda t: strategy.reassignment_candidates(t.predictions, t.drivers),
    "q4c2_best_driver_per_booking": lambda t: strategy.best_driver_per_booking(t.predictions, t.drivers),
    "q4d_driver_efficiency": lambda t: strategy.driver_efficiency(t.bookings),
    "q4e_driver_tiers": lambda t: strategy.driver_tiers(t.bookings),
    "q4e2_driver_tier_rollup": lambda t: strategy.driver_tier_rollup(t.bookings),
    "q4f_understaffed_slots": lambda t: strategy.understaffed_slots(t.bookings, t.predictions),
    "q4g_ops_alerts": lambda t: strategy.ops_alerts(t.predictions),
    "q4h_surge_strategy": lambda t: strategy.surge_strategy(t.bookings),
    "q4i_driver_performance": lambda t: strategy.driver_performance(t.drivers),
    "q4i2_driver_performance_scaled": lambda t: strategy.driver_performance(t.drivers, rating_scale=5.0),
    "q4j_revenue_impact": lambda t: strategy.revenue_impact(t.bookings),
    "q4k_customer_segments": lambda t: strategy.customer_segments(t.customers),
}


def _overview_rides(t: StoredRideTables) -> DataFrame:
    return dashboard.overview_rides(t.bookings, t.drivers)


def _segments(t: StoredRideTables) -> DataFrame:
    return risk.risk_by_city_vehicle(t.predictions)


def _demand(t: StoredRideTables) -> DataFrame:
    return strategy.driver_demand(t.bookings, t.predictions)


def _cities(t: StoredRideTables) -> list[str]:
    """City names from their dimension: the columns of the grids."""
    return t.kept("cities", lambda: sorted(r[0] for r in t.source("region").select("r_name").distinct().collect()))


DASHBOARD: dict[str, Build] = {
    "j8_overview_rides": _overview_rides,
    "w1_cancel_heatmap_grid": lambda t: dashboard.cancel_heatmap_grid(analytics.cancel_heatmap(t.bookings)),
    "w2_surge_grid": lambda t: dashboard.surge_grid(analytics.surge_by_hour_city(t.bookings), _cities(t)),
    "w3_cancel_rates_by_hour": lambda t: dashboard.cancel_rates_by_hour(analytics.cancel_probability_by_hour(t.predictions)),
    "w4_top_reasons": lambda t: dashboard.top_reasons(analytics.cancel_reasons(t.bookings)),
    "w5_weekend_table": lambda t: dashboard.weekend_table(analytics.weekend_comparison(t.bookings)),
    "w6_tier_grid": lambda t: dashboard.tier_grid(risk.risk_by_city(t.predictions)),
    "w7_confusion_grid": lambda t: dashboard.confusion_grid(risk.cancel_confusion(t.predictions)),
    "w8_filtered_rides": lambda t: dashboard.filter_overview(_overview_rides(t), city="ASIA", vehicle_type="Cab", hours=(6, 20)),
    "w9_kpi_cards": lambda t: dashboard.kpi_cards(_overview_rides(t)),
    "w10a_cancel_rate_by_city": lambda t: dashboard.cancel_rate_by_city(_overview_rides(t)),
    "w10b_status_by_hour": lambda t: dashboard.status_by_hour(_overview_rides(t)),
    "w10c_surge_by_city_vehicle": lambda t: dashboard.surge_by_city_vehicle(_overview_rides(t)),
    "w11_requests_by_city_hour": lambda t: dashboard.requests_by_city_hour(t.location_demand),
    "w12_fare_by_vehicle": lambda t: dashboard.fare_by_vehicle(t.bookings),
    "w13_alert_counts": lambda t: dashboard.alert_counts(strategy.ops_alerts(t.predictions)),
    "w14_demand_status_grid": lambda t: dashboard.demand_status_grid(_demand(t), _cities(t)),
    "w15_risk_grid": lambda t: dashboard.risk_grid(_segments(t), _cities(t)),
    "w16_risk_volume": lambda t: dashboard.risk_volume(_segments(t)),
    "w17_worst_segments": lambda t: dashboard.worst_segments(_segments(t)),
    "w18_reassignment_kpis": lambda t: dashboard.reassignment_kpis(strategy.reassignment_candidates(t.predictions, t.drivers)),
    "w19_tier_distribution": lambda t: dashboard.tier_distribution(strategy.driver_efficiency(t.bookings)),
    "w20_revenue_loss": lambda t: dashboard.revenue_loss(strategy.revenue_impact(t.bookings)),
    "w21_few_matches": lambda t: dashboard.few_matches(risk.live_inference(t.predictions, **LIVE_EXAMPLE)),
    "w22_busiest_cities": lambda t: dashboard.busiest_cities(overview.city_heatmap(t.bookings)),
    "w22b_city_demand_table": lambda t: dashboard.city_demand_table(overview.city_heatmap(t.bookings)),
    "w23a_city_rate_bands": lambda t: dashboard.city_rate_bands(overview.city_heatmap(t.bookings)),
    "w23b_probability_bands": lambda t: dashboard.probability_bands(risk.cancel_probability_histogram(t.predictions)),
    "w23c_distance_bands": lambda t: dashboard.distance_bands(analytics.cancel_probability_by_distance(t.predictions)),
    "w23d_mape_bands": lambda t: dashboard.mape_bands(risk.fare_accuracy_by_city(t.predictions)),
    "w24_score_histogram": lambda t: dashboard.score_histogram(strategy.driver_performance(t.drivers)),
    "w25_alert_table": lambda t: dashboard.alert_table(strategy.ops_alerts(t.predictions)),
}

# All queries read ride tables that are derived from the sources and stored once per application.
BUILDERS: dict[str, Build] = {
    **REPORTS, **DASHBOARD, **quality_queries.ENTRIES, **table_queries.ENTRIES, **feature_queries.ENTRIES,
    **model_queries.ENTRIES, **stream_queries.ENTRIES,
}


def queries() -> dict[str, Query]:
    return {name: _over(build) for name, build in BUILDERS.items()}
