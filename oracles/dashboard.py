"""Check statements for the tables behind the dashboard charts."""

from __future__ import annotations

from oracles.reports import (
    ALERTS, AVG_FARE, AVG_SURGE, CANCELLED, CANCEL_RATE, CANDIDATES, COMPLETED, DEMAND, EFFICIENCY, FARE_ACCURACY,
    LIVE_MATCH, REASONS, REPLACEMENTS, REVENUE, RISK_SEGMENTS, SLOTS, performance,
)
from oracles.views import over, pct, rs

REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

OVERVIEW = """
overview_rides AS (
  SELECT b.booking_id, b.city, b.hour_of_day, b.day_of_week, b.is_weekend, b.vehicle_type, b.ride_distance_km,
    b.booking_value, b.booking_status, b.surge_multiplier, b.base_fare, b.traffic_level, b.weather_condition,
    b.booking_datetime, d.avg_pickup_delay_min, d.driver_delay_flag
  FROM bookings b LEFT JOIN drivers d USING (driver_id))"""

CITY_PROFILE = f"""
city_profile AS (
  SELECT city, count(*) AS total_rides, {COMPLETED} AS completed, {CANCELLED} AS cancelled, {CANCEL_RATE}, {AVG_FARE},
    {AVG_SURGE} FROM bookings GROUP BY city)"""



def cells(key: str, values, expr) -> str:
    return ", ".join(f"{expr(v)} AS \"{v}\"" for v in values)


def where(key: str, value: str) -> str:
    return f"FILTER (WHERE {key} = '{value}')"


STATEMENTS = {
    "j8_overview_rides": over("bookings drivers", "SELECT * FROM overview_rides", OVERVIEW),
    "w1_cancel_heatmap_grid": over("bookings", f"""
SELECT hour_of_day, {cells('day_of_week', WEEKDAYS, lambda d: f"coalesce(max(rate) {where('day_of_week', d)}, 0e0)")}
FROM (SELECT hour_of_day, day_of_week, {pct(CANCELLED, 'count(*)')} AS rate FROM bookings GROUP BY ALL) t
GROUP BY hour_of_day"""),
    "w2_surge_grid": over("bookings", f"""
SELECT hour_of_day, {cells('city', REGIONS, lambda c: f"coalesce(max(avg_surge) {where('city', c)}, 1e0)")}
FROM (SELECT hour_of_day, city, {AVG_SURGE} FROM bookings GROUP BY ALL) t GROUP BY hour_of_day"""),
    "w3_cancel_rates_by_hour": over("predictions", f"""
SELECT hour_of_day, CAST(sum(actual_cancelled_flag) AS BIGINT) AS actual_cancels,
  {pct('sum(actual_cancelled_flag)', 'count(*)', 4)} AS actual_rate_pct,
  {rs(rs('avg(cancel_probability)', 4) + ' * 100', 4)} AS predicted_rate_pct
FROM predictions GROUP BY hour_of_day"""),
    "w4_top_reasons": over("bookings", """
SELECT reason, CAST(sum(count) AS BIGINT) AS count FROM reasons GROUP BY reason ORDER BY count DESC, reason LIMIT 10""", REASONS),
    "w5_weekend_table": over("bookings", f"""
SELECT CASE is_weekend WHEN 1 THEN 'Weekend' ELSE 'Weekday' END AS period, count(*) AS total_rides, {AVG_FARE},
  {CANCEL_RATE}, {AVG_SURGE} FROM bookings GROUP BY is_weekend"""),
    "w6_tier_grid": over("predictions", f"""
SELECT city, {cells('cancel_risk_tier', ('High', 'Medium', 'Low'), lambda v: f"count(*) {where('cancel_risk_tier', v)}")}
FROM predictions GROUP BY city"""),
    "w7_confusion_grid": over("predictions", """
SELECT CASE actual_cancelled_flag WHEN 0 THEN 'Not Cancelled' ELSE 'Cancelled' END AS actual,
  count(*) FILTER (WHERE cancel_probability < uc3_threshold_used) AS "Predicted: No",
  count(*) FILTER (WHERE cancel_probability >= uc3_threshold_used) AS "Predicted: Yes"
FROM predictions GROUP BY actual_cancelled_flag"""),
    "w8_filtered_rides": over("bookings drivers", """
SELECT * FROM overview_rides WHERE city = 'ASIA' AND vehicle_type = 'Cab' AND hour_of_day BETWEEN 6 AND 20""", OVERVIEW),
    "w9_kpi_cards": over("bookings drivers", f"""
SELECT count(*) AS total_rides, {COMPLETED} AS completed, {CANCELLED} AS cancelled, {CANCEL_RATE}, {AVG_FARE}, {AVG_SURGE},
  {rs('avg(coalesce(avg_pickup_delay_min, 0))', 2)} AS avg_pickup_delay_min FROM overview_rides""", OVERVIEW),
    "w10a_cancel_rate_by_city": over("bookings", f"SELECT city, {CANCEL_RATE}, count(*) AS total_rides FROM bookings GROUP BY city"),
    "w10b_status_by_hour": over("bookings", f"""
SELECT hour_of_day, {cells('booking_status', ('Completed', 'Cancelled', 'Incomplete'), lambda v: f"count(*) {where('booking_status', v)}")}
FROM bookings GROUP BY hour_of_day"""),
    "w10c_surge_by_city_vehicle": over("bookings", f"""
SELECT city, vehicle_type, {rs('avg(surge_multiplier)', 4)} AS surge_multiplier FROM bookings GROUP BY ALL"""),
    "w11_requests_by_city_hour": over("location_demand", """
SELECT city, hour_of_day, CAST(sum(total_requests) AS BIGINT) AS total_requests FROM location_demand GROUP BY ALL"""),
    "w12_fare_by_vehicle": over("bookings", f"""
SELECT vehicle_type, {rs('avg(booking_value)', 2)} AS mean_fare, {rs('median(booking_value)', 2)} AS median_fare,
  count(booking_value) AS rides FROM bookings GROUP BY vehicle_type"""),
    "w13_alert_counts": over("predictions", """
SELECT count(*) FILTER (WHERE alert_level LIKE 'CRITICAL%') AS critical,
  count(*) FILTER (WHERE alert_level LIKE 'WARNING%') AS warning, count(*) FILTER (WHERE alert_level LIKE 'INFO%') AS info
FROM alerts""", ALERTS),
    "w14_demand_status_grid": over("bookings predictions", f"""
SELECT lpad(CAST(hour_of_day AS VARCHAR), 2, '0') || ':00' AS hour,
  {cells('city', REGIONS, lambda c: f"coalesce(max(CASE WHEN rides_per_driver >= 1.15e0 THEN 3 WHEN rides_per_driver >= 1.08e0 THEN 2 WHEN rides_per_driver >= 0.95e0 THEN 1 ELSE 0 END) {where('city', c)}, 0)")}
FROM demand GROUP BY hour_of_day""", SLOTS, DEMAND),
    "w15_risk_grid": over("predictions", f"""
SELECT vehicle_type, {cells('city', REGIONS, lambda c: rs(f"avg(avg_cancel_prob_pct) {where('city', c)}", 1))}
FROM risk_segments GROUP BY vehicle_type""", RISK_SEGMENTS),
    "w16_risk_volume": over("predictions", """
SELECT cancel_risk_tier, city, CAST(sum(ride_count) AS BIGINT) AS ride_count FROM risk_segments GROUP BY ALL""", RISK_SEGMENTS),
    "w17_worst_segments": over("predictions", f"""
SELECT city, vehicle_type, CAST(sum(ride_count) AS BIGINT) AS high_risk_rides, {rs('avg(avg_cancel_prob_pct)', 2)} AS avg_prob,
  {rs('avg(avg_predicted_fare)', 2)} AS avg_fare
FROM risk_segments WHERE cancel_risk_tier = 'High' GROUP BY city, vehicle_type
ORDER BY high_risk_rides DESC, city, vehicle_type LIMIT 5""", RISK_SEGMENTS),
    "w18_reassignment_kpis": over("predictions drivers", f"""
SELECT count(*) AS bookings, {rs('avg(cancel_prob_pct)', 1)} AS avg_cancel_prob_pct,
  {rs('avg(replacement_score)', 2)} AS avg_replacement_score FROM candidates""", REPLACEMENTS, CANDIDATES),
    "w19_tier_distribution": over("bookings", f"""
SELECT driver_tier, count(*) AS drivers, {rs('avg(completion_rate_pct)', 2)} AS avg_completion,
  {rs('avg(total_earned)', 2)} AS avg_earned, {rs('avg(total_rides)', 2)} AS avg_rides
FROM efficiency GROUP BY driver_tier""", EFFICIENCY),
    "w20_revenue_loss": over("bookings", f"""
SELECT {rs('sum(actual_revenue)', 2)} AS total_actual, {rs('sum(estimated_lost_revenue)', 2)} AS total_lost,
  {rs('100e0 * sum(estimated_lost_revenue) / (sum(estimated_lost_revenue) + sum(actual_revenue))', 1)} AS loss_rate_pct
FROM revenue""", REVENUE),
    "w21_few_matches": over("predictions", """
SELECT *, CASE WHEN matched_bookings < 5 THEN 1 ELSE 0 END AS few_matches FROM live""", LIVE_MATCH),
    "w22_busiest_cities": over("bookings", "SELECT * FROM city_profile ORDER BY total_rides DESC, city LIMIT 12", CITY_PROFILE),
    "w22b_city_demand_table": over("bookings", "SELECT * FROM city_profile", CITY_PROFILE),
    "w23a_city_rate_bands": over("bookings", """
SELECT city, cancel_rate_pct, CASE WHEN cancel_rate_pct > 30 THEN 'red' WHEN cancel_rate_pct > 20 THEN 'amber'
  ELSE 'green' END AS band FROM city_profile""", CITY_PROFILE),
    "w23b_probability_bands": over("predictions", """
SELECT prob_bucket, count(*) AS count, CASE WHEN prob_bucket >= 0.7e0 THEN 'High' WHEN prob_bucket >= 0.4e0 THEN 'Medium'
  ELSE 'Low' END AS band FROM (SELECT floor(cancel_probability * 10) / 10 AS prob_bucket FROM predictions) t
GROUP BY prob_bucket"""),
    "w23c_distance_bands": over("predictions", f"""
SELECT dist_bucket_km, avg_cancel_prob, CASE WHEN avg_cancel_prob * 100 >= 30 THEN 'High'
  WHEN avg_cancel_prob * 100 >= 20 THEN 'Medium' ELSE 'Low' END AS band
FROM (SELECT CAST(floor(ride_distance_km / 5) * 5 AS BIGINT) AS dist_bucket_km,
        {rs('avg(cancel_probability)', 4)} AS avg_cancel_prob
      FROM predictions WHERE ride_distance_km < 60 GROUP BY dist_bucket_km) t"""),
    "w23d_mape_bands": over("predictions", """
SELECT city, mape_pct, CASE WHEN mape_pct > 15 THEN 'red' WHEN mape_pct > 8 THEN 'amber' ELSE 'green' END AS band
FROM fare_accuracy""", FARE_ACCURACY),
    "w24_score_histogram": over("drivers", f"""
SELECT bin, {rs('any_value(low) + bin * any_value(step)', 4)} AS bin_start, count(*) AS count
FROM (SELECT CAST(least(floor((performance_score - low) / (high - low) * 20), 19) AS INT) AS bin, low, (high - low) / 20 AS step
      FROM performance, (SELECT min(performance_score) AS low, max(performance_score) AS high FROM performance) ends
      WHERE performance_score IS NOT NULL) t
GROUP BY bin""", performance()),
    "w25_alert_table": over("predictions", """
SELECT split_part(alert_level, ' ', 1) AS level, city, lpad(CAST(hour_of_day AS VARCHAR), 2, '0') || ':00' AS hour,
  vehicle_type, ride_count, high_risk_count, high_risk_pct, avg_surge, pre_position_by FROM alerts""", ALERTS),
}
