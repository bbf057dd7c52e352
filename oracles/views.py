"""The ride views as SQL, chained in front of every check statement."""

from __future__ import annotations


def rs(expr: str, digits: int) -> str:
    """The rounding rule of the engine: half up with a small nudge."""
    return f"(floor(CAST({expr} AS DOUBLE) * 1e{digits} + 0.5e0 + 1e-6) / 1e{digits})"


def pct(part: str, whole: str, digits: int = 2) -> str:
    return rs(f"100e0 * ({part}) / nullif({whole}, 0)", digits)


BOOKINGS = """
bookings AS (
  WITH legs AS (
    SELECT l_orderkey, min(l_suppkey) AS driver_id, count(*) AS legs,
           CAST(sum(CAST(l_quantity AS INT)) AS BIGINT) AS qty,
           max(CAST(round(l_discount * 100, 0) AS INT)) AS disc_pct
    FROM lineitem GROUP BY l_orderkey)
  SELECT t.*, dayname(booking_datetime) AS day_of_week,
         CASE WHEN isodow(booking_datetime) >= 6 THEN 1 ELSE 0 END AS is_weekend
  FROM (
    SELECT o.o_orderkey AS booking_id, o.o_custkey AS customer_id, legs.driver_id AS driver_id,
      r.r_name AS city, n.n_name AS pickup_location, dn.n_name AS drop_location,
      CASE o.o_orderkey % 3 WHEN 0 THEN 'Cab' WHEN 1 THEN 'Auto' ELSE 'Bike' END AS vehicle_type,
      CAST((o.o_orderkey * 7 + o.o_custkey) % 24 AS INT) AS hour_of_day,
      o.o_orderdate + INTERVAL '1' HOUR * CAST((o.o_orderkey * 7 + o.o_custkey) % 24 AS INT)
                    + INTERVAL '1' MINUTE * CAST(o.o_orderkey % 60 AS INT) AS booking_datetime,
      CASE o.o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Cancelled' ELSE 'Incomplete' END AS booking_status,
      CASE WHEN o.o_orderstatus <> 'P' THEN 'Not Applicable' WHEN o.o_orderkey % 4 = 0 THEN 'Driver Delay'
           WHEN o.o_orderkey % 4 = 1 THEN 'Customer No-Show' WHEN o.o_orderkey % 4 = 2 THEN 'Vehicle Issue'
           ELSE 'App Error' END AS incomplete_ride_reason,
      CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'High'
           WHEN o.o_orderpriority = '3-MEDIUM' THEN 'Medium' ELSE 'Low' END AS traffic_level,
      CASE o.o_custkey % 3 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Rain' ELSE 'Heavy Rain' END AS weather_condition,
      CAST(legs.qty AS DOUBLE) / 4 AS ride_distance_km,
      CAST(10 + legs.disc_pct AS DOUBLE) / 10 AS surge_multiplier,
      CAST(legs.qty * 2 + 20 AS DOUBLE) AS base_fare,
      o.o_totalprice / 1000 AS booking_value,
      CAST(legs.legs * 8 AS DOUBLE) AS estimated_ride_time_min,
      CASE WHEN o.o_orderstatus = 'F' THEN CAST(legs.legs * 8 + (o.o_orderkey % 15) - 5 AS DOUBLE) END
        AS actual_ride_time_min
    FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    JOIN legs ON legs.l_orderkey = o.o_orderkey
    JOIN supplier s ON s.s_suppkey = legs.driver_id
    JOIN nation dn ON s.s_nationkey = dn.n_nationkey) t)"""

CUSTOMERS = """
customers AS (
  SELECT t.*, CASE WHEN cancellation_rate > 0.30 THEN 1 ELSE 0 END AS customer_cancel_flag FROM (
    SELECT c.c_custkey AS customer_id,
      CASE c.c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Non-Binary' END AS customer_gender,
      CAST(18 + c.c_custkey % 47 AS INT) AS customer_age, r.r_name AS customer_city,
      CAST((c.c_custkey * 13) % 1500 AS INT) AS customer_signup_days_ago,
      CASE c.c_custkey % 3 WHEN 0 THEN 'Bike' WHEN 1 THEN 'Cab' ELSE 'Auto' END AS preferred_vehicle_type,
      count(b.booking_id) AS total_bookings,
      count(*) FILTER (WHERE b.booking_status = 'Completed') AS completed_rides,
      count(*) FILTER (WHERE b.booking_status = 'Cancelled') AS cancelled_rides,
      count(*) FILTER (WHERE b.booking_status = 'Incomplete') AS incomplete_rides,
      CAST(count(*) FILTER (WHERE b.booking_status = 'Cancelled') AS DOUBLE) / nullif(count(b.booking_id), 0)
        AS cancellation_rate,
      CAST(35 + c.c_custkey % 16 AS DOUBLE) / 10 AS avg_customer_rating
    FROM customer c
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    LEFT JOIN bookings b ON b.customer_id = c.c_custkey
    GROUP BY c.c_custkey, r.r_name) t)"""

DRIVERS = """
drivers AS (
  SELECT t.*, CASE WHEN delay_rate > 0.10 THEN 1 ELSE 0 END AS driver_delay_flag,
         CASE WHEN driver_experience_years > driver_age - 18 THEN 1 ELSE 0 END AS experience_outlier_flag FROM (
    SELECT s.s_suppkey AS driver_id, CAST(20 + s.s_suppkey % 40 AS INT) AS driver_age, r.r_name AS driver_city,
      CASE s.s_suppkey % 3 WHEN 0 THEN 'Cab' WHEN 1 THEN 'Auto' ELSE 'Bike' END AS vehicle_type,
      CAST(s.s_suppkey % 15 AS INT) AS driver_experience_years,
      count(b.booking_id) AS total_assigned_rides,
      count(*) FILTER (WHERE b.booking_id % 5 <> 0) AS accepted_rides,
      count(*) FILTER (WHERE b.booking_id % 5 = 0) AS rejected_rides,
      count(*) FILTER (WHERE b.booking_status = 'Incomplete') AS incomplete_rides,
      count(*) FILTER (WHERE b.actual_ride_time_min > b.estimated_ride_time_min + 6) AS delay_count,
      CAST(count(*) FILTER (WHERE b.booking_id % 5 <> 0) AS DOUBLE) / nullif(count(b.booking_id), 0)
        AS acceptance_rate,
      CAST(count(*) FILTER (WHERE b.actual_ride_time_min > b.estimated_ride_time_min + 6) AS DOUBLE)
        / nullif(count(b.booking_id), 0) AS delay_rate,
      CAST(30 + s.s_suppkey % 21 AS DOUBLE) / 10 AS avg_driver_rating,
      CAST(s.s_suppkey % 70 AS DOUBLE) / 10 AS avg_pickup_delay_min
    FROM supplier s
    JOIN nation n ON s.s_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    LEFT JOIN bookings b ON b.driver_id = s.s_suppkey
    GROUP BY s.s_suppkey, r.r_name) t)"""

LOCATION_DEMAND = """
location_demand AS (
  SELECT city, pickup_location, hour_of_day, vehicle_type, count(*) AS total_requests,
    count(*) FILTER (WHERE booking_status = 'Completed') AS completed_rides,
    count(*) FILTER (WHERE booking_status = 'Cancelled') AS cancelled_rides,
    avg(estimated_ride_time_min) AS avg_wait_time_min, avg(surge_multiplier) AS avg_surge_multiplier,
    CASE WHEN count(*) >= 12 THEN 'High' WHEN count(*) >= 6 THEN 'Medium' ELSE 'Low' END AS demand_level
  FROM bookings GROUP BY city, pickup_location, hour_of_day, vehicle_type)"""

TIME_FEATURES = """
time_features AS (
  SELECT h AS datetime, CAST(extract(HOUR FROM h) AS INT) AS hour_of_day, dayname(h) AS day_of_week,
    CASE WHEN isodow(h) >= 6 THEN 1 ELSE 0 END AS is_weekend, 0 AS is_holiday,
    CASE WHEN extract(HOUR FROM h) BETWEEN 7 AND 10 OR extract(HOUR FROM h) BETWEEN 17 AND 21 THEN 1 ELSE 0 END
      AS peak_time_flag,
    CASE WHEN extract(MONTH FROM h) IN (12, 1, 2) THEN 'Winter' WHEN extract(MONTH FROM h) BETWEEN 3 AND 6
         THEN 'Summer' ELSE 'Monsoon' END AS season
  FROM (SELECT DISTINCT date_trunc('hour', booking_datetime) AS h FROM bookings) t)"""

PREDICTIONS = """
predictions AS (
  SELECT booking_id, city, vehicle_type, hour_of_day, traffic_level, weather_condition, ride_distance_km,
    surge_multiplier, CAST(p AS DOUBLE) / 100 AS cancel_probability,
    CASE WHEN p >= 70 THEN 'High' WHEN p >= 40 THEN 'Medium' ELSE 'Low' END AS cancel_risk_tier,
    CASE WHEN p >= 70 THEN 'Reassign Driver' WHEN p >= 40 THEN 'Send Reminder' ELSE 'Proceed' END
      AS recommended_action,
    CAST(0.60 AS DOUBLE) AS uc3_threshold_used,
    base_fare * surge_multiplier AS predicted_fare, booking_value AS actual_fare,
    CASE WHEN booking_status = 'Completed' THEN 1 ELSE 0 END AS actual_completed_flag,
    CASE WHEN booking_status = 'Cancelled' THEN 1 ELSE 0 END AS actual_cancelled_flag
  FROM (SELECT *, (booking_id * 37 + customer_id) % 100 AS p FROM bookings) t)"""

RAW_BOOKINGS = """
raw_bookings AS (
  SELECT 'B_' || lpad(CAST(b.booking_id AS VARCHAR), 12, '0') AS booking_id,
    strftime(booking_datetime, '%Y-%m-%d') AS booking_date, strftime(booking_datetime, '%H:%M:%S') AS booking_time,
    ' ' || lower(city) || ' ' AS city, pickup_location, drop_location, upper(vehicle_type) AS vehicle_type,
    lower(traffic_level) AS traffic_level, lower(weather_condition) AS weather_condition,
    lower(booking_status) AS booking_status,
    CASE WHEN booking_status = 'Incomplete' THEN lower(incomplete_ride_reason) END AS incomplete_ride_reason,
    hour_of_day, ride_distance_km, estimated_ride_time_min, actual_ride_time_min, base_fare, surge_multiplier,
    booking_value, customer_id, driver_id
  FROM bookings b, LATERAL (SELECT unnest(CASE WHEN b.booking_id % 50 = 0 THEN [1, 2] ELSE [1] END)) copies)"""

_VIEWS = {
    "bookings": (BOOKINGS, ()),
    "customers": (CUSTOMERS, ("bookings",)),
    "drivers": (DRIVERS, ("bookings",)),
    "location_demand": (LOCATION_DEMAND, ("bookings",)),
    "time_features": (TIME_FEATURES, ("bookings",)),
    "predictions": (PREDICTIONS, ("bookings",)),
    "raw_bookings": (RAW_BOOKINGS, ("bookings",)),
}


def over(views: str, body: str, *more: str) -> str:
    """`WITH <views>[, <more named subqueries>] <body>`; `views` is a blank-separated list of view names."""
    wanted: list[str] = []
    for name in views.split():
        for needed in (*_VIEWS[name][1], name):
            if needed not in wanted:
                wanted.append(needed)
    parts = [_VIEWS[name][0].strip() for name in wanted] + [m.strip() for m in more]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
