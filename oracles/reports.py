"""Check statements for the named business queries."""

from __future__ import annotations

from oracles.views import over, pct, rs

CANCELLED = "count(*) FILTER (WHERE booking_status = 'Cancelled')"
COMPLETED = "count(*) FILTER (WHERE booking_status = 'Completed')"
HIGH = "count(*) FILTER (WHERE cancel_risk_tier = 'High')"
CANCEL_RATE = pct(CANCELLED, "count(*)") + " AS cancel_rate_pct"
AVG_FARE = rs("avg(booking_value)", 2) + " AS avg_fare"
AVG_SURGE = rs("avg(surge_multiplier)", 3) + " AS avg_surge"
FARE_ERROR = "abs(predicted_fare - actual_fare)"

# Parameters of the live-inference check.
LIVE = {"city": "ASIA", "vehicle_type": "Bike", "hour_of_day": 11, "traffic_level": "High",
        "weather_condition": "Rain", "distance_km": 25.0}


def profile(key: str) -> str:
    return over("bookings", f"""
SELECT {key}, count(*) AS total_rides, {COMPLETED} AS completed, {CANCELLED} AS cancelled, {CANCEL_RATE},
       {AVG_FARE}, {AVG_SURGE}
FROM bookings GROUP BY {key}""")


def half_past(hour: str) -> str:
    return f"lpad(CAST(greatest({hour} - 1, 0) AS VARCHAR), 2, '0') || ':30'"


def score(scale: str = "1e0") -> str:
    return rs(f"avg_driver_rating / {scale} * 0.4e0 + acceptance_rate * 0.3e0 + (1e0 - delay_rate) * 0.3e0", 3)


def tiers(value: str, elite: str, reliable: str, developing: str) -> str:
    return (f"CASE WHEN {value} >= {elite} THEN 'Elite' WHEN {value} >= {reliable} THEN 'Reliable' "
            f"WHEN {value} >= {developing} THEN 'Developing' ELSE 'At Risk' END")


RISK_SEGMENTS = f"""
risk_segments AS (
  SELECT city, vehicle_type, cancel_risk_tier, count(*) AS ride_count,
    {rs('avg(cancel_probability) * 100', 2)} AS avg_cancel_prob_pct,
    {rs('avg(predicted_fare)', 2)} AS avg_predicted_fare, {AVG_SURGE}
  FROM predictions GROUP BY city, vehicle_type, cancel_risk_tier)"""

SLOTS = """
slots AS (
  SELECT b.city, b.hour_of_day, count(DISTINCT b.driver_id) AS active_drivers, count(*) AS total_rides,
    CAST(count(*) AS DOUBLE) / nullif(count(DISTINCT b.driver_id), 0) AS load,
    avg(p.cancel_probability) AS risk, count(*) FILTER (WHERE p.cancel_risk_tier = 'High') AS high
  FROM bookings b JOIN predictions p USING (booking_id) GROUP BY b.city, b.hour_of_day)"""

DEMAND = f"""
demand AS (
  SELECT city, hour_of_day, active_drivers, total_rides, {rs('load', 2)} AS rides_per_driver,
    {rs('risk', 3)} AS avg_cancel_risk, {rs('load * (risk + 1)', 2)} AS demand_pressure,
    CASE WHEN hour_of_day BETWEEN 7 AND 10 THEN 'Morning Peak' WHEN hour_of_day BETWEEN 18 AND 23 THEN 'Evening Peak'
         ELSE 'Off-Peak' END AS time_band,
    CASE WHEN load >= 1.15e0 THEN 'High Demand' WHEN load >= 1.08e0 THEN 'Peak Lean'
         WHEN load >= 0.95e0 THEN 'Balanced' ELSE 'Low Demand' END AS allocation_status,
    CASE WHEN load >= 1.15e0 AND {rs('risk', 6)} > 0.25e0 THEN 'Add Drivers Immediately'
         WHEN load >= 1.10e0 THEN 'Pre-position Drivers' WHEN load < 0.95e0 THEN 'Shift Drivers Out'
         ELSE 'Maintain' END AS recommended_action,
    {half_past('hour_of_day')} AS pre_position_by
  FROM slots)"""

REPLACEMENTS = f"""
replacements AS (
  SELECT * FROM (
    SELECT driver_id, driver_city, {rs('avg_driver_rating', 2)} AS driver_rating,
           {rs('acceptance_rate', 2)} AS acceptance_rate, {score()} AS replacement_score FROM drivers) t
  WHERE replacement_score >= 0.8e0)"""

AT_RISK = "cancel_risk_tier = 'High' AND recommended_action = 'Reassign Driver'"

PAIR = f"""
SELECT p.booking_id, p.city, p.vehicle_type, p.hour_of_day, {rs('p.cancel_probability * 100', 1)} AS cancel_prob_pct,
  p.recommended_action, {rs('p.predicted_fare', 2)} AS predicted_fare, d.driver_id AS best_replacement_driver,
  d.driver_city, d.driver_rating, d.acceptance_rate, d.replacement_score"""

CANDIDATES = f"""
candidates AS ({PAIR}
  FROM (SELECT * FROM predictions WHERE {AT_RISK} ORDER BY cancel_probability DESC, booking_id LIMIT 200) p
  JOIN (SELECT * FROM replacements ORDER BY replacement_score DESC, driver_id LIMIT 5) d ON d.driver_city = p.city)"""

EFFICIENCY = f"""
efficiency AS (
  SELECT driver_id, city, vehicle_type, total_rides, completed_rides, {rs('rate', 1)} AS completion_rate_pct,
    total_earned, avg_surge_worked, {tiers('rate', '90e0', '75e0', '60e0')} AS driver_tier
  FROM (SELECT driver_id, city, vehicle_type, count(*) AS total_rides, {COMPLETED} AS completed_rides,
          100e0 * {COMPLETED} / count(*) AS rate,
          {rs("sum(CASE WHEN booking_status = 'Completed' THEN booking_value ELSE 0 END)", 2)} AS total_earned,
          {rs('avg(surge_multiplier)', 2)} AS avg_surge_worked
        FROM bookings GROUP BY driver_id, city, vehicle_type HAVING count(*) >= 5) t
  ORDER BY completion_rate_pct DESC, total_earned DESC, driver_id, city, vehicle_type LIMIT 300)"""

DRIVER_TIERS = f"""
driver_tiers AS (
  SELECT city, driver_id, {tiers(f'100e0 * {COMPLETED} / count(*)', '90e0', '75e0', '60e0')} AS driver_tier
  FROM bookings GROUP BY city, driver_id HAVING count(*) >= 5)"""

ALERTS = f"""
alerts AS (
  SELECT * FROM (
    SELECT city, hour_of_day, vehicle_type, count(*) AS ride_count, {rs('avg(surge_multiplier)', 2)} AS avg_surge,
      {HIGH} AS high_risk_count, {pct(HIGH, 'count(*)', 1)} AS high_risk_pct,
      {rs('avg(cancel_probability)', 3)} AS avg_cancel_prob, {half_past('hour_of_day')} AS pre_position_by,
      CASE WHEN {rs('avg(surge_multiplier)', 6)} > 1.8e0 AND {HIGH} > 5 THEN 'CRITICAL — Surge + High Cancel Risk'
           WHEN {rs('avg(surge_multiplier)', 6)} > 1.8e0 THEN 'WARNING — High Surge Demand'
           WHEN {HIGH} > 10 THEN 'WARNING — High Cancellation Risk'
           WHEN {rs('avg(surge_multiplier)', 6)} > 1.4e0 THEN 'INFO — Moderate Surge' ELSE 'OK' END AS alert_level
    FROM predictions GROUP BY city, hour_of_day, vehicle_type) t
  WHERE alert_level <> 'OK')"""


def performance(scale: str = "1e0") -> str:
    return f"""
performance AS (
  SELECT *, {tiers('performance_score', '0.8e0', '0.6e0', '0.4e0')} AS driver_tier FROM (
    SELECT driver_id, driver_city AS city, driver_experience_years, avg_driver_rating, acceptance_rate, delay_rate,
      total_assigned_rides, accepted_rides, {score(scale)} AS performance_score FROM drivers) t
  ORDER BY performance_score DESC NULLS LAST, driver_id LIMIT 100)"""


REVENUE = f"""
revenue AS (
  SELECT city, {CANCELLED} AS cancelled_rides, {rs('avg(booking_value)', 2)} AS avg_booking_value,
    {rs(f'{CANCELLED} * avg(booking_value)', 2)} AS estimated_lost_revenue,
    {rs("sum(CASE WHEN booking_status = 'Completed' THEN booking_value ELSE 0 END)", 2)} AS actual_revenue
  FROM bookings GROUP BY city)"""

REASONS = """
reasons AS (
  SELECT coalesce(incomplete_ride_reason, 'Not Specified') AS reason, booking_status, count(*) AS count
  FROM bookings WHERE booking_status <> 'Completed' GROUP BY ALL
  ORDER BY count DESC, reason, booking_status LIMIT 30)"""

FARE_ACCURACY = f"""
fare_accuracy AS (
  SELECT city, {rs('avg(predicted_fare)', 2)} AS avg_predicted, {rs('avg(actual_fare)', 2)} AS avg_actual,
    {rs(f'avg({FARE_ERROR})', 2)} AS mae, {rs(f'100e0 * avg({FARE_ERROR}) / avg(actual_fare)', 1)} AS mape_pct,
    count(*) AS n
  FROM predictions WHERE actual_fare > 0 AND actual_completed_flag = 1 GROUP BY city)"""

LIVE_MATCH = f"""
live AS (
  SELECT city, vehicle_type, hour_of_day, traffic_level, weather_condition,
    {rs('avg(ride_distance_km)', 1)} AS ride_distance_km, {rs('avg(surge_multiplier)', 2)} AS surge_multiplier,
    {rs('avg(predicted_fare)', 2)} AS predicted_fare, {rs('avg(cancel_probability) * 100', 1)} AS cancel_probability_pct,
    {rs('avg(cancel_probability)', 4)} AS cancel_probability_raw,
    CASE WHEN {rs('avg(cancel_probability)', 6)} >= 0.7e0 THEN 'High' WHEN {rs('avg(cancel_probability)', 6)} >= 0.4e0 THEN 'Medium'
         ELSE 'Low' END AS cancel_risk_tier,
    CASE WHEN {rs('avg(cancel_probability)', 6)} >= 0.7e0 THEN 'Reassign Driver'
         WHEN {rs('avg(cancel_probability)', 6)} >= 0.4e0 THEN 'Send Reminder' ELSE 'Proceed' END AS recommended_action,
    max(uc3_threshold_used) AS uc3_threshold_used, count(*) AS matched_bookings
  FROM predictions
  WHERE city = '{LIVE["city"]}' AND vehicle_type = '{LIVE["vehicle_type"]}' AND hour_of_day = {LIVE["hour_of_day"]}
    AND traffic_level = '{LIVE["traffic_level"]}' AND weather_condition = '{LIVE["weather_condition"]}'
    AND abs(ride_distance_km - {LIVE["distance_km"]}) <= 5
  GROUP BY ALL)"""

STATEMENTS = {
    "q0a_cities": over("bookings", "SELECT DISTINCT city FROM bookings"),
    "q0b_vehicle_types": over("bookings", "SELECT DISTINCT vehicle_type FROM bookings"),
    "q0c_date_range": over("bookings", "SELECT min(booking_datetime) AS min_date, max(booking_datetime) AS max_date FROM bookings"),
    "q1a_kpi_summary": over("bookings", f"""
SELECT count(*) AS total_rides, {AVG_FARE}, {CANCEL_RATE},
  {rs('avg(actual_ride_time_min - estimated_ride_time_min) FILTER (WHERE actual_ride_time_min > 0)', 2)} AS avg_delay_min,
  {AVG_SURGE}, {COMPLETED} AS completed_rides, {CANCELLED} AS cancelled_rides,
  count(*) FILTER (WHERE booking_status NOT IN ('Completed', 'Cancelled')) AS incomplete_rides
FROM bookings"""),
    "q1b_city_heatmap": profile("city"),
    "q1c_pickup_demand": over("bookings", f"""
SELECT city, pickup_location, n AS ride_count, {pct('n', 'sum(n) OVER (PARTITION BY city)', 1)} AS pct_of_city
FROM (SELECT city, pickup_location, count(*) AS n FROM bookings GROUP BY city, pickup_location) t"""),
    "q1d_hourly_trends": profile("hour_of_day"),
    "q1e_vehicle_breakdown": over("bookings", f"""
SELECT vehicle_type, count(*) AS total_rides, {AVG_FARE}, {rs('avg(ride_distance_km)', 2)} AS avg_dist_km, {CANCEL_RATE}
FROM bookings GROUP BY vehicle_type"""),
    "q1f_status_distribution": over("bookings", "SELECT booking_status, count(*) AS count FROM bookings GROUP BY booking_status"),
    "q2a_prediction_kpis": over("predictions", f"""
SELECT count(*) AS total_predictions, {rs('avg(predicted_fare)', 2)} AS avg_predicted_fare,
  {rs('avg(actual_fare)', 2)} AS avg_actual_fare,
  {rs(f'avg({FARE_ERROR}) FILTER (WHERE actual_completed_flag = 1)', 2)} AS avg_fare_mae,
  {pct(HIGH, 'count(*)')} AS high_risk_pct, {HIGH} AS high_risk_count,
  count(*) FILTER (WHERE cancel_risk_tier = 'Medium') AS medium_risk_count,
  count(*) FILTER (WHERE cancel_risk_tier = 'Low') AS low_risk_count
FROM predictions"""),
    "q2b_risk_tier_distribution": over("predictions", f"""
SELECT cancel_risk_tier, n AS count, {pct('n', 'sum(n) OVER ()', 1)} AS pct
FROM (SELECT cancel_risk_tier, count(*) AS n FROM predictions GROUP BY cancel_risk_tier) t"""),
    "q2c_action_distribution": over("predictions", """
SELECT recommended_action, cancel_risk_tier, count(*) AS count FROM predictions GROUP BY ALL"""),
    "q2d_fare_accuracy_by_city": over("predictions", "SELECT * FROM fare_accuracy", FARE_ACCURACY),
    "q2e_risk_by_city": over("predictions", "SELECT city, cancel_risk_tier, count(*) AS count FROM predictions GROUP BY ALL"),
    "q2f_cancel_probability_histogram": over("predictions", """
SELECT floor(cancel_probability * 10) / 10 AS prob_bucket, count(*) AS count FROM predictions GROUP BY ALL"""),
    "q2g_high_risk_sample": over("predictions", f"""
SELECT booking_id, city, vehicle_type, hour_of_day, {rs('ride_distance_km', 1)} AS distance_km,
  {rs('surge_multiplier', 2)} AS surge, {rs('cancel_probability * 100', 1)} AS cancel_prob_pct, cancel_risk_tier,
  recommended_action, {rs('predicted_fare', 2)} AS predicted_fare, {rs('actual_fare', 2)} AS actual_fare
FROM (SELECT * FROM predictions WHERE cancel_risk_tier = 'High'
      ORDER BY cancel_probability DESC, booking_id LIMIT 200) t"""),
    "q2h_cancel_confusion": over("predictions", """
SELECT actual_cancelled_flag, CASE WHEN cancel_probability >= uc3_threshold_used THEN 1 ELSE 0 END AS predicted_cancelled,
  count(*) AS count FROM predictions GROUP BY ALL"""),
    "q2i_fare_scatter": over("predictions", f"""
SELECT {rs('actual_fare', 2)} AS actual_fare, {rs('predicted_fare', 2)} AS predicted_fare, city, vehicle_type, cancel_risk_tier
FROM (SELECT * FROM predictions WHERE actual_fare > 0 AND actual_fare < 2000 AND actual_completed_flag = 1
      ORDER BY md5(CAST(booking_id AS VARCHAR) || '-42'), booking_id LIMIT 2000) t"""),
    "q2j_live_inference": over("predictions", "SELECT * FROM live", LIVE_MATCH),
    "q3a_cancel_heatmap": over("bookings", f"""
SELECT hour_of_day, day_of_week, count(*) AS total_rides, {CANCELLED} AS cancellations, {CANCEL_RATE}
FROM bookings GROUP BY hour_of_day, day_of_week"""),
    "q3b_surge_by_hour_city": over("bookings", f"""
SELECT hour_of_day, city, {AVG_SURGE}, {rs('max(surge_multiplier)', 2)} AS max_surge, count(*) AS ride_count
FROM bookings GROUP BY hour_of_day, city"""),
    "q3c_cancel_probability_by_surge": over("predictions", f"""
SELECT {rs('surge_multiplier', 1)} AS surge_bucket, {rs('avg(cancel_probability)', 4)} AS avg_cancel_prob, count(*) AS count
FROM predictions GROUP BY surge_bucket"""),
    "q3d_cancel_probability_by_hour": over("predictions", f"""
SELECT hour_of_day, {rs('avg(cancel_probability)', 4)} AS avg_cancel_prob,
  CAST(sum(actual_cancelled_flag) AS BIGINT) AS actual_cancels, count(*) AS total
FROM predictions GROUP BY hour_of_day"""),
    "q3e_cancel_reasons": over("bookings", "SELECT * FROM reasons", REASONS),
    "q3f_cancellations_by_party": over("bookings", """
SELECT CASE WHEN incomplete_ride_reason ILIKE '%customer%' THEN 'Customer No Show'
            WHEN incomplete_ride_reason ILIKE '%driver%' THEN 'Driver'
            WHEN booking_status = 'Cancelled' THEN 'Cancelled By Customer (Assumed)'
            ELSE 'System / Unknown' END AS cancelled_by, count(*) AS count
FROM bookings WHERE booking_status <> 'Completed' GROUP BY ALL"""),
    "q3g_cancel_probability_by_distance": over("predictions", f"""
SELECT CAST(floor(ride_distance_km / 5) * 5 AS BIGINT) AS dist_bucket_km,
  {rs('avg(cancel_probability)', 4)} AS avg_cancel_prob, count(*) AS count
FROM predictions WHERE ride_distance_km < 60 GROUP BY dist_bucket_km"""),
    "q3h_weekend_comparison": over("bookings", f"""
SELECT is_weekend, count(*) AS total_rides, {AVG_FARE}, {AVG_SURGE}, {CANCEL_RATE} FROM bookings GROUP BY is_weekend"""),
    "q3i_weather_impact": over("bookings", f"""
SELECT weather_condition, count(*) AS total_rides, {AVG_SURGE}, {CANCEL_RATE}, {AVG_FARE}
FROM bookings GROUP BY weather_condition"""),
    "q3j_traffic_impact": over("bookings", f"""
SELECT traffic_level, count(*) AS total_rides,
  {rs('avg(actual_ride_time_min - estimated_ride_time_min)', 2)} AS avg_delay_min, {AVG_SURGE}, {CANCEL_RATE}
FROM bookings WHERE actual_ride_time_min > 0 GROUP BY traffic_level"""),
    "q4a_driver_demand": over("bookings predictions", "SELECT * FROM demand", SLOTS, DEMAND),
    "q4b_risk_by_city_vehicle": over("predictions", "SELECT * FROM risk_segments", RISK_SEGMENTS),
    "q4c_reassignment_candidates": over("predictions drivers", "SELECT * FROM candidates", REPLACEMENTS, CANDIDATES),
    "q4c2_best_driver_per_booking": over("predictions drivers", f"""{PAIR}
FROM predictions p JOIN (
  SELECT *, row_number() OVER (PARTITION BY driver_city ORDER BY replacement_score DESC, driver_id) AS place
  FROM replacements) d ON d.driver_city = p.city AND d.place = 1
WHERE p.cancel_risk_tier = 'High' AND p.recommended_action = 'Reassign Driver'""", REPLACEMENTS),
    "q4d_driver_efficiency": over("bookings", "SELECT * FROM efficiency", EFFICIENCY),
    "q4e_driver_tiers": over("bookings", "SELECT city, driver_tier, CAST(1 AS BIGINT) AS driver_count FROM driver_tiers", DRIVER_TIERS),
    "q4e2_driver_tier_rollup": over("bookings", """
SELECT city, driver_tier, count(*) AS driver_count FROM driver_tiers GROUP BY city, driver_tier""", DRIVER_TIERS),
    "q4f_understaffed_slots": over("bookings predictions", f"""
SELECT city, hour_of_day, active_drivers, total_rides, {rs('load', 1)} AS rides_per_driver,
  {rs('risk * 100', 1)} AS avg_cancel_prob_pct, high AS high_risk_rides, {half_past('hour_of_day')} AS pre_position_by
FROM slots WHERE {rs('load', 1)} > 1.15e0
ORDER BY rides_per_driver DESC, high_risk_rides DESC, city, hour_of_day LIMIT 30""", SLOTS),
    "q4g_ops_alerts": over("predictions", "SELECT * FROM alerts", ALERTS),
    "q4h_surge_strategy": over("bookings", f"""
SELECT hour_of_day, city, {AVG_SURGE}, count(*) AS total_rides, {CANCELLED} AS cancellations, {CANCEL_RATE},
  CASE WHEN {rs('avg(surge_multiplier)', 6)} > 1.8e0 THEN 'Reduce Surge to Retain Riders'
       WHEN {rs('avg(surge_multiplier)', 6)} > 1.4e0 THEN 'Monitor — Surge Moderate' ELSE 'Normal Operations' END AS recommendation
FROM bookings GROUP BY hour_of_day, city ORDER BY avg_surge DESC, hour_of_day, city LIMIT 50"""),
    "q4i_driver_performance": over("drivers", "SELECT * FROM performance", performance()),
    "q4i2_driver_performance_scaled": over("drivers", "SELECT * FROM performance", performance("5e0")),
    "q4j_revenue_impact": over("bookings", "SELECT * FROM revenue", REVENUE),
    "q4k_customer_segments": over("customers", f"""
SELECT CASE WHEN total_bookings >= 20 AND cancellation_rate < 0.2e0 THEN 'Champion'
            WHEN total_bookings >= 10 AND cancellation_rate < 0.3e0 THEN 'Loyal'
            WHEN total_bookings >= 5 AND cancellation_rate < 0.4e0 THEN 'Potential'
            WHEN cancellation_rate >= 0.5e0 THEN 'At Risk' ELSE 'New / Occasional' END AS segment,
  count(*) AS customer_count, {rs('avg(total_bookings)', 1)} AS avg_bookings,
  {rs('avg(cancellation_rate)', 3)} AS avg_cancel_rate, {rs('avg(avg_customer_rating)', 2)} AS avg_rating
FROM customers GROUP BY segment"""),
}
