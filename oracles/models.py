"""Check statements for splits, fitted transforms, selection, evaluation and scoring rules."""

from __future__ import annotations

from oracles.features import ALL_VIEWS, STAGES, yes
from oracles.views import over, rs

SPLIT = """CASE WHEN row_number() OVER (PARTITION BY {by} ORDER BY md5(CAST(booking_id AS VARCHAR) || '-42'), booking_id)
  <= floor(count(*) OVER (PARTITION BY {by}) * {share} + 0.5e0)"""

PARTED = f"""
parted AS (SELECT *, {SPLIT.format(by='booking_status_enc', share='0.2e0')} THEN 'test' ELSE 'train' END AS split FROM f4),
train AS (SELECT * FROM parted WHERE split = 'train')"""


def fitted(columns: str, fit: str, *more: str) -> str:
    """Columns of every row, computed with the one-row result of `fit` over the training rows."""
    return over(ALL_VIEWS, f"SELECT booking_id, {columns} FROM parted, fit", *STAGES, PARTED, f"fit AS ({fit})", *more)


def q(column: str, p: float) -> str:
    return f"quantile_cont({column}, {p})"


SCALED = (
    "surge_multiplier", "estimated_ride_time_min", "acceptance_rate", "delay_rate", "avg_pickup_delay_min",
    "customer_age", "customer_tenure_years", "customer_signup_days_ago", "fare_per_km", "fare_per_min",
    "demand_supply_ratio", "cancel_to_booking_ratio", "cust_completion_rate", "rejection_rate", "delay_per_ride",
    "driver_incomplete_rate", "location_surge_deviation", "surge_x_distance", "traffic_x_ridetime",
    "ride_distance_km", "base_fare",
)
# The measured columns of the derived frame, and its counts, codes and flags.
MEASURED = (
    "ride_distance_km", "surge_multiplier", "base_fare", "booking_value", "estimated_ride_time_min", "actual_ride_time_min",
    "cancellation_rate", "avg_customer_rating", "acceptance_rate", "delay_rate", "avg_driver_rating", "avg_pickup_delay_min",
    "avg_wait_time_min", "avg_surge_multiplier", "hour_sin", "hour_cos", "day_sin", "day_cos", "month_sin", "month_cos",
    "expected_fare", "fare_per_km", "fare_per_min", "delay_per_km", "customer_tenure_years", "cancel_to_booking_ratio",
    "cust_completion_rate", "incomplete_ride_share", "rejection_rate", "driver_incomplete_rate", "delay_per_ride",
    "demand_supply_ratio", "location_surge_deviation", "surge_x_distance", "surge_x_traffic", "peak_x_surge", "base_x_surge",
    "traffic_x_ridetime", "weather_x_ridetime", "cancel_risk_x_peak", "cancel_risk_x_night", "delay_x_traffic",
)
COUNTED = (
    "hour_of_day", "is_weekend", "same_loc_flag", "actual_time_available", "customer_age", "customer_signup_days_ago",
    "total_bookings", "completed_rides", "cancelled_rides", "incomplete_rides", "customer_cancel_flag", "driver_age",
    "driver_experience_years", "total_assigned_rides", "accepted_rides", "driver_incomplete_rides", "delay_count",
    "driver_delay_flag", "experience_outlier_flag", "rejected_rides", "peak_time_flag", "loc_total_requests",
    "loc_completed_rides", "loc_cancelled_rides", "day_of_week_num", "booking_month", "booking_quarter", "booking_week",
    "is_morning_peak", "is_evening_peak", "is_night_ride", "is_new_customer", "is_low_rated_customer",
    "vehicle_preference_match", "is_unreliable_driver", "is_low_rated_driver", "is_high_demand_location", "traffic_num",
    "weather_num", "rain_high_traffic", "high_delay_high_traffic", "night_x_high_traffic", "is_cancelled", "traffic_enc",
    "weather_enc", "booking_status_enc", "demand_enc",
)
CLASS_TARGETS = {"UC1": "booking_status_enc", "UC3": "is_cancelled", "UC4": "driver_delay_flag"}

SHARES = ", ".join(f"""
{c}_share AS (SELECT {c} AS v, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM pairs WHERE split = 'train') AS share
  FROM pairs WHERE split = 'train' GROUP BY {c})""" for c in ("pickup_location", "drop_location", "City_Pair"))



def correlation(x: str, y: str) -> str:
    varies = " AND ".join(f"min(CAST({a} AS DOUBLE)) FILTER ({b} IS NOT NULL) < max(CAST({a} AS DOUBLE)) FILTER ({b} IS NOT NULL)" for a, b in ((x, y), (y, x)))
    return f"CASE WHEN {varies} THEN corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)) END"


CORRELATIONS = "correlations AS (SELECT unnest(l, recursive := true) FROM (SELECT [" + ",\n".join(
    f"{{'use_case': '{use_case}', 'feature': '{c}', 'correlation': {correlation(c, y)}}}"
    for use_case, y in CLASS_TARGETS.items() for c in (*MEASURED, *COUNTED) if c != y
) + "] AS l FROM train) t UNION ALL " + " UNION ALL ".join(f"SELECT '{u}', 'constant_column', NULL" for u in CLASS_TARGETS) + ")"

SCORED = f"""
scored AS (
  SELECT booking_id, actual_cancelled_flag AS label,
    {rs('cancel_probability * 0.7e0 + actual_cancelled_flag * 0.3e0', 4)} AS score,
    CASE WHEN {rs('cancel_probability * 0.7e0 + actual_cancelled_flag * 0.3e0', 4)} >= 0.6e0 THEN 1 ELSE 0 END AS prediction
  FROM predictions)"""
CURVE = """
curve AS (
  SELECT score AS threshold, CAST(sum(pos) OVER o AS DOUBLE) / sum(n) OVER o AS precision,
    CAST(sum(pos) OVER o AS DOUBLE) / sum(pos) OVER () AS recall
  FROM (SELECT score, count(*) AS n, count(*) FILTER (WHERE label = 1) AS pos FROM scored GROUP BY score) t
  WINDOW o AS (ORDER BY score DESC)),
points AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-9) AS f1 FROM curve),
best AS (SELECT * FROM points ORDER BY round(f1, 9) DESC, threshold LIMIT 1)"""
CLASSES = """
classes AS (
  SELECT b.booking_id, CASE b.booking_status WHEN 'Completed' THEN 0 WHEN 'Cancelled' THEN 1 ELSE 2 END AS label,
    CASE p.cancel_risk_tier WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 ELSE 0 END AS prediction
  FROM bookings b JOIN predictions p USING (booking_id))"""
REPORT = """
report AS (
  SELECT class, support, hit, coalesce(CAST(hit AS DOUBLE) / nullif(named, 0), 0) AS precision,
    coalesce(CAST(hit AS DOUBLE) / nullif(support, 0), 0) AS recall,
    coalesce(2e0 * hit / nullif(named + support, 0), 0) AS f1
  FROM (SELECT class, count(*) FILTER (WHERE label = class) AS support,
          count(*) FILTER (WHERE prediction = class) AS named,
          count(*) FILTER (WHERE label = class AND prediction = class) AS hit
        FROM {source}, (SELECT unnest({ids}) AS class) c GROUP BY class) t)"""
FARES = """
fares AS (
  SELECT booking_id, actual_fare AS y, predicted_fare AS p FROM predictions WHERE actual_completed_flag = 1)"""


def comparison(setting: str, at: str) -> str:
    counts = {
        "tp": f"count(*) FILTER (WHERE label = 1 AND score >= {at})", "fp": f"count(*) FILTER (WHERE label = 0 AND score >= {at})",
        "fn": f"count(*) FILTER (WHERE label = 1 AND score < {at})", "tn": f"count(*) FILTER (WHERE label = 0 AND score < {at})",
    }
    listed = ", ".join(f"{e} AS {n}" for n, e in counts.items())

    def ratio(a: str, b: str) -> str:
        return rs(f"coalesce(1e0 * ({a}) / nullif({b}, 0), 0)", 4)
    return f"""SELECT setting, threshold, tp, fp, fn, tn, {ratio('tp', 'tp + fp')} AS precision, {ratio('tp', 'tp + fn')} AS recall,
  {ratio('2 * tp', '2 * tp + fp + fn')} AS f1, {ratio('fp', 'fp + tn')} AS fp_rate
FROM (SELECT '{setting}' AS setting, CAST(any_value({at}) AS DOUBLE) AS threshold, {listed}
      FROM scored, (SELECT threshold AS tuned FROM best) b) t"""


def rounded(names, digits: int = 6) -> str:
    return ", ".join(f"{rs(n, digits)} AS {n}" for n in names)


PREDICTION_TABLE = f"""
SELECT b.booking_id, 'v1.0' AS model_version, 'ride_inference' AS prediction_type, b.city, b.vehicle_type, b.hour_of_day,
  {rs('b.ride_distance_km', 4)} AS ride_distance_km, {rs('b.surge_multiplier', 4)} AS surge_multiplier, b.is_weekend,
  coalesce(l.demand_level, 'Unknown') AS demand_level,
  {yes('b.hour_of_day BETWEEN 7 AND 10 OR b.hour_of_day BETWEEN 17 AND 21')} AS peak_time_flag,
  b.traffic_level, b.weather_condition, {rs(rs('p.predicted_fare', 2), 4)} AS predicted_fare,
  {rs('b.estimated_ride_time_min', 4)} AS predicted_ride_time_min, {rs('p.cancel_probability', 4)} AS cancel_probability,
  p.cancel_risk_tier, 0.6e0 AS uc3_threshold_used, p.recommended_action,
  {yes("b.booking_status = 'Completed'")} AS actual_completed_flag, {rs('b.booking_value', 4)} AS actual_fare,
  {rs('coalesce(b.actual_ride_time_min, 0)', 4)} AS actual_ride_time_min,
  {yes("b.booking_status = 'Cancelled'")} AS actual_cancelled_flag
FROM bookings b JOIN predictions p USING (booking_id)
LEFT JOIN location_demand l ON l.city = b.city AND l.pickup_location = b.pickup_location
  AND l.hour_of_day = b.hour_of_day AND l.vehicle_type = b.vehicle_type"""

TENURE = "SELECT max(customer_signup_days_ago) / 365e0 AS longest FROM train"
FULL_LOYALTY = """least(greatest(customer_signup_days_ago / 365e0 / (longest + 1e-9) * 0.2e0
  + CAST(completed_rides AS DOUBLE) / (total_bookings + 1) * 0.4e0 + avg_customer_rating / 5 * 0.2e0
  + (1 - least(greatest(cancellation_rate, 0e0), 1e0)) * 0.2e0, 0e0), 1e0)"""

STATEMENTS = {
    "d20_split_checks": over(ALL_VIEWS, " UNION ALL ".join(
        f"SELECT '{use_case}' AS use_case, false AS target_leaks, count(*) AS rows, count(*) FILTER (WHERE {target} IS NULL) AS null_targets, "
        f"count({target}) AS rows_kept FROM f4 WHERE {chosen}" for use_case, target, chosen in (
            *((u, y, "true") for u, y in CLASS_TARGETS.items()),
            *((f"UC2_{v}", "booking_value", f"vehicle_type = '{v}'") for v in ("Cab", "Auto", "Bike")))), *STAGES),
    "d21_train_class_balance": over(ALL_VIEWS, " UNION ALL ".join(
        f"SELECT '{u}' AS use_case, CAST({y} AS INTEGER) AS class, count(*) AS count, "
        f"{rs('CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM train)', 3)} AS share FROM train GROUP BY {y}"
        for u, y in CLASS_TARGETS.items()), *STAGES, PARTED),
    "u3_vehicle_rows": over("bookings", "SELECT vehicle_type, count(*) AS rows FROM bookings GROUP BY vehicle_type"),
    "u4_u5_train_test": over(ALL_VIEWS, "SELECT booking_id, booking_status_enc, split FROM parted", *STAGES, PARTED),
    "u5_plain_split": over("bookings", f"""
SELECT booking_id, {SPLIT.format(by='1', share='0.2e0')} THEN 'test' ELSE 'train' END AS split FROM bookings"""),
    "u6_tuning_subset": over(ALL_VIEWS, f"""
SELECT booking_id, booking_status_enc FROM (
  SELECT *, {SPLIT.format(by='booking_status_enc', share='0.4e0')} THEN 1 ELSE 0 END AS tune FROM train) t
WHERE tune = 1""", *STAGES, PARTED),
    "z1_cap_experience": over(ALL_VIEWS, """
SELECT booking_id, least(greatest(driver_experience_years, 0), driver_age - 18) AS driver_experience_years FROM wide""",
        *STAGES[:2]),
    "z2_distance_flags": fitted(f"""split, {yes('ride_distance_km < lo')} AS is_short_ride, {yes('ride_distance_km > hi')} AS is_long_ride,
  CASE WHEN ride_distance_km <= lo THEN 0e0 WHEN ride_distance_km <= hi THEN 1e0 ELSE 2e0 END AS distance_bin_enc""",
        f"SELECT {q('ride_distance_km', 0.25)} AS lo, {q('ride_distance_km', 0.75)} AS hi FROM train"),
    "z3_high_cancel": fitted(f"""split, {yes('cancellation_rate > bound')} AS is_high_cancel_customer,
  {yes('is_new_customer = 1 AND cancellation_rate > bound')} AS new_high_cancel""",
        f"SELECT {q('cancellation_rate', 0.75)} AS bound FROM train"),
    "z4_location_shares": over(ALL_VIEWS, f"""
SELECT booking_id, {rs('coalesce(p.share, 0)', 6)} AS pickup_location_freq, {rs('coalesce(d.share, 0)', 6)} AS drop_location_freq,
  {rs('coalesce(c.share, 0)', 6)} AS "City_Pair_freq"
FROM pairs LEFT JOIN pickup_location_share p ON p.v = pickup_location LEFT JOIN drop_location_share d ON d.v = drop_location
LEFT JOIN City_Pair_share c ON c.v = City_Pair""", *STAGES, PARTED,
        "pairs AS (SELECT *, pickup_location || '_' || drop_location AS City_Pair FROM parted)", SHARES),
    "z5_hotspots": over(ALL_VIEWS, f"""
SELECT booking_id, split, {yes('pickup_location IN (SELECT pickup_location FROM hot)')} AS pickup_hotspot_flag FROM parted""",
        *STAGES, PARTED, """
hot AS (SELECT pickup_location FROM train GROUP BY pickup_location ORDER BY count(*) DESC, pickup_location LIMIT 10)"""),
    "z6_full_loyalty": fitted(f"""split, {rs(FULL_LOYALTY, 6)} AS "Customer_Loyalty_Score",
  {rs(f'({FULL_LOYALTY}) * cancellation_rate', 6)} AS loyalty_x_cancel""", TENURE),
    "z7_lean_loyalty": fitted(f"""split, {rs('''least(greatest(customer_signup_days_ago / 365e0 / (longest + 1e-9) * 0.5e0
  + avg_customer_rating / 5 * 0.5e0, 0e0), 1e0)''', 6)} AS "Customer_Loyalty_Score" """, TENURE),
    "z8_scaled": fitted(", ".join(f"{rs(f'({c} - {c}_m) / {c}_s', 5)} AS {c}" for c in SCALED),
        "SELECT " + ", ".join(f"avg({c}) AS {c}_m, coalesce(nullif(stddev_pop({c}), 0), 1) AS {c}_s" for c in SCALED) + " FROM train"),
    "z9_imputed": fitted(", ".join(f"{rs(f'coalesce({c}, {c}_m)', 6)} AS {c}" for c in MEASURED),
        "SELECT " + ", ".join(f"median({c}) AS {c}_m" for c in MEASURED) + " FROM train"),
    "x1_target_correlations": over(ALL_VIEWS, f"SELECT use_case, feature, {rs('correlation', 6)} AS correlation FROM correlations",
        *STAGES, PARTED, CORRELATIONS),
    "x4_correlation_ranking": over(ALL_VIEWS, f"""
SELECT use_case, feature, {rs('correlation', 6)} AS correlation, {rs('abs(correlation)', 6)} AS strength FROM correlations""",
        *STAGES, PARTED, CORRELATIONS),
    "v1_binary_metrics": over("predictions", f"""
SELECT {rs('(SELECT CAST(count(*) FILTER (WHERE label = prediction) AS DOUBLE) / count(*) FROM scored)', 4)} AS accuracy,
  {rs('precision', 4)} AS precision, {rs('recall', 4)} AS recall, {rs('f1', 4)} AS f1, (SELECT count(*) FROM scored) AS rows
FROM report WHERE class = 1""", SCORED, REPORT.format(source="scored", ids="[0, 1]")),
    "v1_weighted_metrics": over("predictions", f"""
SELECT {rs('sum(hit) * 1e0 / sum(support)', 4)} AS accuracy, {rs('sum(precision * support) / sum(support)', 4)} AS precision,
  {rs('sum(recall * support) / sum(support)', 4)} AS recall, {rs('sum(f1 * support) / sum(support)', 4)} AS f1,
  CAST(sum(support) AS BIGINT) AS rows FROM report""", CLASSES, REPORT.format(source="classes", ids="[0, 1, 2]")),
    "v1_class_report": over("predictions", f"""
SELECT class, support, {rounded(('precision', 'recall', 'f1'))} FROM report""", CLASSES, REPORT.format(source="classes", ids="[0, 1, 2]")),
    "v2_roc_auc": over("predictions", f"""
SELECT {rs('''(sum(mid) FILTER (WHERE label = 1) - pos * (pos + 1) / 2e0) / (1e0 * pos * neg)''', 8)} AS auc,
  pos AS positives, neg AS negatives
FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2e0 AS mid FROM scored) r,
  (SELECT count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM scored) n
GROUP BY pos, neg""", SCORED),
    "v3_confusion_matrix": over("predictions", """
SELECT label, count(*) FILTER (WHERE prediction = 0) AS predicted_0, count(*) FILTER (WHERE prediction = 1) AS predicted_1,
  count(*) FILTER (WHERE prediction = 2) AS predicted_2 FROM classes GROUP BY label""", CLASSES),
    "v4_regression_metrics": over("predictions", f"""
SELECT {rs('avg(abs(y - p))', 3)} AS mae, {rs('sqrt(avg((y - p) * (y - p)))', 3)} AS rmse,
  {rs('1 - avg((y - p) * (y - p)) / var_pop(y)', 3)} AS r2, count(*) AS rows FROM fares""", FARES),
    "v5_best_f1_threshold": over("predictions", f"SELECT {rounded(('threshold', 'precision', 'recall', 'f1'))} FROM best", SCORED, CURVE),
    "v6_precision_threshold": over("predictions", """
SELECT coalesce(min(threshold) FILTER (WHERE precision >= 0.65e0), (SELECT threshold FROM best)) AS threshold,
  CASE WHEN count(*) FILTER (WHERE precision >= 0.65e0) > 0 THEN 'precision' ELSE 'best_f1' END AS strategy FROM points""", SCORED, CURVE),
    "v6_precision_fallback": over("predictions", """
SELECT coalesce(min(threshold) FILTER (WHERE precision >= 0.99999e0), (SELECT threshold FROM best)) AS threshold,
  CASE WHEN count(*) FILTER (WHERE precision >= 0.99999e0) > 0 THEN 'precision' ELSE 'best_f1' END AS strategy FROM points""", SCORED, CURVE),
    "v7_threshold_comparison": over("predictions", comparison("default", "0.5e0") + "\nUNION ALL " + comparison("tuned", "tuned"), SCORED, CURVE),
    "v9_residuals": over("predictions", f"""
SELECT booking_id, {rs('y', 4)} AS actual, {rs('p', 4)} AS predicted, {rs('y - p', 4)} AS residual FROM fares""", FARES),
    "v9_residual_histogram": over("predictions", f"""
SELECT bin, {rs('any_value(low) + bin * any_value(step)', 4)} AS bin_start, count(*) AS count
FROM (SELECT CAST(least(floor((y - p - low) / (high - low) * 60), 59) AS INT) AS bin, low, (high - low) / 60 AS step
      FROM fares, (SELECT min(y - p) AS low, max(y - p) AS high FROM fares) ends) t GROUP BY bin""", FARES),
    "p1_clamped_threshold": over("predictions", """
SELECT booking_id, CASE WHEN cancel_probability BETWEEN 0.55e0 AND 0.7e0 THEN cancel_probability ELSE 0.6e0 END AS threshold
FROM predictions"""),
    "p3_p4_risk": over("predictions", "SELECT booking_id, cancel_probability, cancel_risk_tier, recommended_action FROM predictions"),
    "p5_p6_predictions_table": over("bookings predictions location_demand", PREDICTION_TABLE),
    "m3_balanced_weights": over("bookings", f"""
SELECT booking_status_enc, {rs('(SELECT count(*) FROM bookings) * 1e0 / (3 * count(*))', 6)} AS weight
FROM (SELECT CASE booking_status WHEN 'Completed' THEN 0 WHEN 'Cancelled' THEN 1 ELSE 2 END AS booking_status_enc FROM bookings) t
GROUP BY booking_status_enc"""),
    "s12_split_store": over(ALL_VIEWS, "SELECT booking_id, booking_status_enc, split FROM parted", *STAGES, PARTED),
}
