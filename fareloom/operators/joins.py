"""The left joins that build the wide booking table.

No join is hinted. Spark broadcasts a side whose measured size is under the threshold and otherwise shuffles both;
a key that holds a large share of the bookings is then split by the adaptive skew join (left side of a left join).
Each right side is reduced to one row per key first, so no join can multiply bookings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions.quantiles import quantile_values

# The columns each side brings.
CUSTOMER_COLUMNS = (
    "customer_gender", "customer_age", "customer_city", "customer_signup_days_ago", "preferred_vehicle_type",
    "total_bookings", "completed_rides", "cancelled_rides", "incomplete_rides", "cancellation_rate",
    "avg_customer_rating", "customer_cancel_flag",
)
DRIVER_COLUMNS = (
    "driver_age", "driver_city", "driver_experience_years", "total_assigned_rides", "accepted_rides",
    "driver_incomplete_rides", "delay_count", "acceptance_rate", "delay_rate", "avg_driver_rating",
    "avg_pickup_delay_min", "driver_delay_flag", "experience_outlier_flag", "rejected_rides",
)
LOCATION_KEYS = ("city", "pickup_location", "hour_of_day", "vehicle_type")
LOCATION_COLUMNS = (
    "loc_total_requests", "loc_completed_rides", "loc_cancelled_rides", "avg_wait_time_min", "avg_surge_multiplier",
    "demand_level",
)


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by its other columns. An aggregate, so copies combine before the shuffle."""
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row")).select(*keys, "_row.*")


def with_customers(bookings: DataFrame, customers: DataFrame) -> DataFrame:
    side = customers.select("customer_id", *_present(customers, CUSTOMER_COLUMNS))
    return bookings.join(side, "customer_id", "left")


def with_drivers(bookings: DataFrame, drivers: DataFrame) -> DataFrame:
    renamed = drivers.withColumnsRenamed({"incomplete_rides": "driver_incomplete_rides", "city": "driver_city"})
    side = renamed.select("driver_id", *_present(renamed, DRIVER_COLUMNS))
    return bookings.join(side, "driver_id", "left")


def with_time(bookings: DataFrame, time_features: DataFrame) -> DataFrame:
    side = one_per_key(
        time_features.select(F.col("datetime").cast("timestamp_ntz").alias("merge_hour"),
                             *_present(time_features, ("peak_time_flag", "season"))),
        ["merge_hour"],
    )
    hour = F.date_trunc("hour", F.col("booking_datetime")).cast("timestamp_ntz")
    return bookings.withColumn("merge_hour", hour).join(side, "merge_hour", "left").drop("merge_hour")


def with_location(bookings: DataFrame, location_demand: DataFrame) -> DataFrame:
    renamed = location_demand.withColumnsRenamed({
        "completed_rides": "loc_completed_rides", "cancelled_rides": "loc_cancelled_rides",
        "total_requests": "loc_total_requests",
    })
    side = one_per_key(renamed.select(*LOCATION_KEYS, *_present(renamed, LOCATION_COLUMNS)), LOCATION_KEYS)
    return bookings.join(side, list(LOCATION_KEYS), "left")


def wide_bookings(bookings: DataFrame, customers: DataFrame, drivers: DataFrame, location_demand: DataFrame,
                  time_features: DataFrame) -> DataFrame:
    """All five tables on one row per booking."""
    return (
        bookings
        .transform(with_customers, customers)
        .transform(with_drivers, drivers)
        .transform(with_time, time_features)
        .transform(with_location, location_demand)
    )


def with_predictions(bookings: DataFrame, predictions: DataFrame) -> DataFrame:
    """Bookings that have a prediction, with the prediction's own columns."""
    own = [c for c in predictions.columns if c == "booking_id" or c not in bookings.columns]
    return bookings.join(predictions.select(*own), "booking_id")


def align_predictions(bookings: DataFrame, predicted: DataFrame, column: str) -> DataFrame:
    """Every booking with its predicted value; a booking without one gets the median of the predictions."""
    middle = quantile_values(predicted, [column], [0.5]).get(column, [None])[0]
    return (
        bookings.join(predicted.select("booking_id", column), "booking_id", "left")
        .withColumn(column, F.coalesce(F.col(column), F.lit(middle).cast("double")))
    )
