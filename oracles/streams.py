"""Check statements for the streams."""

from __future__ import annotations

from oracles.reports import HIGH
from oracles.views import over, pct, rs

SCORED = over("predictions", """
SELECT booking_id, city, cancel_probability, cancel_risk_tier, recommended_action FROM predictions""")

STATEMENTS = {
    "t1_stream_scoring": SCORED,
    "t1_stream_scoring_once": SCORED,
    # The last hour windows are still open when the stream stops: their end lies after the watermark.
    "t2_stream_alerts": over("bookings predictions", f"""
SELECT * FROM (
  SELECT date_trunc('hour', b.booking_datetime) AS hour_start, b.city, b.vehicle_type, count(*) AS ride_count,
    {rs('avg(p.surge_multiplier)', 2)} AS avg_surge, {HIGH} AS high_risk_count, {pct(HIGH, 'count(*)', 1)} AS high_risk_pct,
    {rs('avg(p.cancel_probability)', 3)} AS avg_cancel_prob,
    CASE WHEN {rs('avg(p.surge_multiplier)', 6)} > 1.8e0 AND {HIGH} > 5 THEN 'CRITICAL — Surge + High Cancel Risk'
         WHEN {rs('avg(p.surge_multiplier)', 6)} > 1.8e0 THEN 'WARNING — High Surge Demand'
         WHEN {HIGH} > 10 THEN 'WARNING — High Cancellation Risk'
         WHEN {rs('avg(p.surge_multiplier)', 6)} > 1.4e0 THEN 'INFO — Moderate Surge' ELSE 'OK' END AS alert_level
  FROM bookings b JOIN predictions p USING (booking_id) GROUP BY 1, 2, 3) t
WHERE alert_level <> 'OK'
  AND hour_start + INTERVAL '1' HOUR <= (SELECT max(booking_datetime) - INTERVAL '10' MINUTE FROM bookings)"""),
}
