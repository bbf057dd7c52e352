"""Catalog entries of the joins, features and encodings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions.exprs import peak_flag, round_stable
from fareloom.operators import cleaning, encoding, engineering, features, joins
from fareloom.sources.ride_views import RideTables


def rides_of(t: RideTables) -> DataFrame:
    """Bookings with the two flags that cleaning adds."""
    return t.bookings.transform(cleaning.flag_same_location).transform(cleaning.flag_measured_time)


def wide_of(t: RideTables) -> DataFrame:
    return joins.wide_bookings(rides_of(t), t.customers, t.drivers, t.location_demand, t.time_features)


def engineered_of(t: RideTables, keep: tuple[str, ...] = ("booking_id",)) -> DataFrame:
    wide = wide_of(t)
    return engineering.engineer_wide(wide, encoding.fit_categories(wide), keep)


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that last-bit differences of math libraries do not count."""
    return df.select(*[
        round_stable(F.col(f"`{c}`"), digits).alias(c) if kind == "double" else F.col(f"`{c}`")
        for c, kind in df.dtypes
    ])


def _made_by(*steps: Callable[[DataFrame], DataFrame], changed: tuple[str, ...] = ()) -> Callable[[RideTables], DataFrame]:
    """The columns that the last step adds (or changes) after the earlier ones have run."""
    def build(t: RideTables) -> DataFrame:
        df = wide_of(t)
        for step in steps[:-1]:
            df = df.transform(step)
        made = df.transform(steps[-1])
        names = [c for c in made.columns if c in changed or c not in df.columns]
        return comparable(made.select("booking_id", *names))
    return build


def _encode(t: RideTables, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    before = engineering.derive_features(wide_of(t))
    after = before.transform(step)
    return after.select("booking_id", *[F.col(f"`{c}`") for c in after.columns if c not in before.columns])


def _one_hot(t: RideTables) -> DataFrame:
    wide = wide_of(t)
    hot = encoding.one_hot(wide, encoding.fit_categories(wide))
    return hot.select("booking_id", *[F.col(f"`{c}`") for c in hot.columns if c not in wide.columns])


def _align(t: RideTables) -> DataFrame:
    modelled = t.predictions.filter(F.col("vehicle_type").isin("Cab", "Auto"))
    aligned = joins.align_predictions(t.bookings.select("booking_id"), modelled, "predicted_fare")
    return comparable(aligned, 4)


_BASE = (features.add_datetime_features, features.add_ride_features, features.add_customer_features,
         features.add_driver_features, features.add_location_features)

ENTRIES: dict[str, Callable[[RideTables], DataFrame]] = {
    "j1_with_customers": lambda t: joins.with_customers(rides_of(t), t.customers),
    "j2_with_drivers": lambda t: joins.with_drivers(rides_of(t), t.drivers),
    "j3_with_time": lambda t: joins.with_time(rides_of(t), t.time_features),
    "j4_with_location": lambda t: joins.with_location(rides_of(t), t.location_demand),
    "j5_wide_bookings": wide_of,
    "j6_with_predictions": lambda t: joins.with_predictions(t.bookings, t.predictions),
    "j9_align_predictions": _align,
    "f1_datetime_features": _made_by(features.add_datetime_features, changed=("is_weekend",)),
    "f2_ride_features": _made_by(features.add_ride_features),
    "f3_customer_features": _made_by(features.add_customer_features),
    "f4_driver_features": _made_by(features.add_driver_features),
    "f5_location_features": _made_by(features.add_location_features),
    "f6_interaction_features": _made_by(*_BASE, features.add_interaction_features),
    "f7_outcome_interactions": _made_by(*_BASE, encoding.add_ordinal_codes, features.add_outcome_interactions),
    "f8_log_transform": _made_by(features.log_transform, changed=features.LOG_COLUMNS),
    "f9_f10_engineered": lambda t: comparable(engineered_of(t)),
    "f11_peak_flag": lambda t: t.bookings.select("booking_id", peak_flag(F.col("hour_of_day")).alias("peak_time_flag")),
    "e1_e2_ordinal_codes": lambda t: _encode(t, encoding.add_ordinal_codes),
    "e3_one_hot": _one_hot,
    "e4_bin_codes": lambda t: _encode(t, encoding.add_bin_codes),
    "e5_booleans_to_int": lambda t: encoding.booleans_to_int(t.bookings.select(
        "booking_id", (F.col("booking_status") == "Completed").alias("done"),
        (F.col("surge_multiplier") > 1.05).alias("surged"))),
    "e6_tidy_columns": lambda t: encoding.tidy_columns(_one_hot(t)),
}
