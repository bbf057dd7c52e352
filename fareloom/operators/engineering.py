"""The row-wise feature chain from the five tables to the model-ready frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.operators import encoding, features, joins

# The raw vehicle type under a name of its own: the fare models need it after one-hot encoding.
VEHICLE = "ride_vehicle_type"


def derive_features(wide: DataFrame) -> DataFrame:
    """Features up to, not including, the encodings."""
    return (
        wide.withColumn(VEHICLE, F.col("vehicle_type"))
        .transform(features.add_datetime_features)
        .transform(features.add_ride_features)
        .transform(features.add_customer_features)
        .transform(features.add_driver_features)
        .transform(features.add_location_features)
        .transform(features.add_interaction_features)
    )


def engineer_wide(wide: DataFrame, categories: Mapping[str, Sequence[str]],
                  keep: tuple[str, ...] = ("booking_id",)) -> DataFrame:
    """Interactions use the unlogged values, so logs come after them."""
    return (
        derive_features(wide)
        .transform(encoding.encode_features, categories)
        .transform(features.add_outcome_interactions)
        .transform(features.log_transform)
        .transform(features.drop_raw_columns, keep)
    )


def engineer(bookings: DataFrame, customers: DataFrame, drivers: DataFrame, location_demand: DataFrame,
             time_features: DataFrame, categories: Mapping[str, Sequence[str]] | None = None,
             keep: tuple[str, ...] = ("booking_id",)) -> DataFrame:
    """The whole chain. Without `categories` they are fitted on the wide table first."""
    wide = joins.wide_bookings(bookings, customers, drivers, location_demand, time_features)
    return engineer_wide(wide, categories or encoding.fit_categories(wide), keep)
