"""Transforms fitted on the training part and applied alike to training, test, new and streamed rows.

Fitting is one aggregate per kind. Its numbers are few and become literals; location shares grow with the data and
stay a DataFrame that is joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.functions.exprs import clip, flag
from fareloom.functions.quantiles import quantile_values
from fareloom.functions.small import one_row
from fareloom.operators.encoding import tidy_columns
from fareloom.operators.quality import numeric_columns
from fareloom.sources import tables

# Columns that are standardised.
SCALED_COLUMNS = (
    "surge_multiplier", "estimated_ride_time_min", "acceptance_rate", "delay_rate", "avg_pickup_delay_min",
    "customer_age", "customer_tenure_years", "customer_signup_days_ago", "fare_per_km", "fare_per_min",
    "demand_supply_ratio", "cancel_to_booking_ratio", "cust_completion_rate", "rejection_rate", "delay_per_ride",
    "driver_incomplete_rate", "location_surge_deviation", "surge_x_distance", "traffic_x_ridetime",
    "ride_distance_km", "base_fare",
)
# Location columns that are replaced by their share of the training rows.
SHARE_COLUMNS = ("pickup_location", "drop_location", "City_Pair")
HOTSPOTS = 10
TENURE_GUARD = 1e-9


def cap_experience(df: DataFrame) -> DataFrame:
    years, legal = F.col("driver_experience_years"), F.col("driver_age") - 18
    return df.withColumn("driver_experience_years", clip(years, F.lit(0), legal))


def add_city_pair(df: DataFrame) -> DataFrame:
    return df.withColumn("City_Pair", F.concat_ws("_", "pickup_location", "drop_location"))


# Distance quartiles ------------------------------------------------------------------------------------------------

def fit_distance(train: DataFrame) -> list[float] | None:
    """Quartiles, or None (not fitted, the step is skipped) if no row has a distance."""
    return quantile_values(train, ["ride_distance_km"], [0.25, 0.75]).get("ride_distance_km")


def apply_distance(df: DataFrame, quartiles: Sequence[float] | None) -> DataFrame:
    if quartiles is None:
        return df
    short, long = quartiles
    km = F.col("ride_distance_km")
    return df.withColumns({
        "is_short_ride": flag(km < short),
        "is_long_ride": flag(km > long),
        "distance_bin_enc": F.when(km <= short, 0.0).when(km <= long, 1.0).when(km > long, 2.0),
    })


# High-cancel customers ---------------------------------------------------------------------------------------------

def fit_high_cancel(train: DataFrame) -> float | None:
    """The bound, or None (not fitted, the step is skipped) if no row has a rate."""
    return quantile_values(train, ["cancellation_rate"], [0.75]).get("cancellation_rate", [None])[0]


def apply_high_cancel(df: DataFrame, bound: float | None) -> DataFrame:
    if bound is None:
        return df
    high = flag(F.col("cancellation_rate") > bound)
    return df.withColumns({
        "is_high_cancel_customer": high,
        "new_high_cancel": flag((F.col("is_new_customer") == 1) & (F.col("cancellation_rate") > bound)),
    })


# Location shares ---------------------------------------------------------------------------------------------------

def fit_shares(train: DataFrame, column: str) -> DataFrame:
    """Share of the training rows per value; a row per value, however many there are."""
    total = train.agg(F.count(column).alias("n"))
    return (
        train.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        .select("value", (F.col("n").cast("double") / total.scalar()).alias("share"))
    )


def apply_shares(df: DataFrame, column: str, shares: DataFrame) -> DataFrame:
    """`<column>_freq`; a value that training has not seen gets 0."""
    side = shares.select(F.col("value").alias(column), F.col("share").alias(f"{column}_freq"))
    return df.join(side, column, "left").fillna({f"{column}_freq": 0.0})


def fit_hotspots(train: DataFrame, limit: int = HOTSPOTS) -> list[str]:
    top = (
        train.filter(F.col("pickup_location").isNotNull())
        .groupBy("pickup_location").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "pickup_location").limit(limit)
    )
    return [r["pickup_location"] for r in top.collect()]


def apply_hotspots(df: DataFrame, hotspots: Sequence[str]) -> DataFrame:
    return df.withColumn("pickup_hotspot_flag", flag(F.col("pickup_location").isin(*hotspots)))


# Loyalty -----------------------------------------------------------------------------------------------------------

def fit_tenure(train: DataFrame) -> float | None:
    """The longest tenure in years, or None (not fitted, the step is skipped) if no row has one."""
    longest = one_row(train.agg(F.max("customer_signup_days_ago").alias("m")))["m"]
    return None if longest is None else float(longest) / 365


def _loyalty(weighted: Column) -> Column:
    return clip(weighted, F.lit(0.0), F.lit(1.0))


def _tenure_share(longest: float) -> Column:
    return F.col("customer_signup_days_ago") / 365 / (longest + TENURE_GUARD)


def apply_full_loyalty(df: DataFrame, longest: float) -> DataFrame:
    """Loyalty from tenure, completed rides, rating and few cancellations."""
    completed = F.col("completed_rides") / (F.col("total_bookings") + 1)
    steady_rider = 1 - clip(F.col("cancellation_rate"), F.lit(0.0), F.lit(1.0))
    score = _loyalty(_tenure_share(longest) * 0.20 + completed * 0.40
                     + F.col("avg_customer_rating") / 5 * 0.20 + steady_rider * 0.20)
    return df.withColumns({
        "Customer_Loyalty_Score": score, "loyalty_x_cancel": score * F.col("cancellation_rate")})


def apply_lean_loyalty(df: DataFrame, longest: float) -> DataFrame:
    """Loyalty from tenure and rating alone, for the cancellation model."""
    return df.withColumn("Customer_Loyalty_Score", _loyalty(
        _tenure_share(longest) * 0.50 + F.col("avg_customer_rating") / 5 * 0.50))


# Scaling and imputing ----------------------------------------------------------------------------------------------

def fit_scaler(train: DataFrame, columns: Sequence[str] = SCALED_COLUMNS) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column is divided by 1."""
    present = [c for c in columns if c in train.columns]
    # Constant is told by the extremes: merged partial deviations can be tiny instead of zero.
    row = one_row(train.agg(
        *[F.avg(c).alias(f"{c}__mean") for c in present],
        *[F.when(F.min(c) < F.max(c), F.stddev_pop(c)).alias(f"{c}__std") for c in present],
    ))
    return {c: (row[f"{c}__mean"] or 0.0, row[f"{c}__std"] or 1.0) for c in present}


def apply_scaler(df: DataFrame, scale: Mapping[str, Sequence[float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - mean) / std for c, (mean, std) in scale.items() if c in df.columns})


def fit_medians(train: DataFrame, columns: Sequence[str] | None = None) -> dict[str, float]:
    """Exact medians of all numeric columns, or of the named ones: a gap may show first in test, new or streamed rows."""
    if columns is None:
        columns = [c for c in numeric_columns(train) if c != "booking_id"]
    if not columns:
        return {}
    return {c: q[0] for c, q in quantile_values(train, columns, [0.5]).items()}


def apply_medians(df: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    """Missing numbers become the training median (0 where training has no value at all)."""
    return df.withColumns({
        c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float(medians.get(c, 0.0))))
        for c in numeric_columns(df) if c != "booking_id"
    })


def numeric_only(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Tidy names and leave out columns that are no numbers, except the named ones."""
    tidy = tidy_columns(df)
    numbers = set(numeric_columns(tidy))
    return tidy.select(*[c for c in tidy.columns if c in numbers or c in keep])


# The chain ---------------------------------------------------------------------------------------------------------

@dataclass
class Fitted:
    """Everything learned from the training part of one use case."""

    use_case: str
    distance: list[float] | None = None
    high_cancel: float | None = None
    hotspots: list[str] | None = None
    full_tenure: float | None = None
    lean_tenure: float | None = None
    scale: dict[str, tuple[float, float]] = field(default_factory=dict)
    medians: dict[str, float] = field(default_factory=dict)
    shares: dict[str, DataFrame] = field(default_factory=dict)

    def save(self, spark: SparkSession, folder: str) -> None:
        numbers = {k: v for k, v in self.__dict__.items() if k != "shares"}
        tables.save_json(spark, {**numbers, "share_columns": sorted(self.shares)}, f"{folder}/numbers")
        for column, shares in self.shares.items():
            shares.write.mode("overwrite").parquet(f"{folder}/shares/{column}")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> Fitted:
        content = dict(tables.load_json(spark, f"{folder}/numbers"))
        columns = content.pop("share_columns")
        content["scale"] = {c: tuple(v) for c, v in content["scale"].items()}
        return Fitted(**content, shares={c: spark.read.parquet(f"{folder}/shares/{c}") for c in columns})


def fit_post_split(train: DataFrame, use_case: str) -> Fitted:
    """Learn what the columns of `train` call for. A step whose inputs were dropped before is left out."""
    base, have = use_case.split("_")[0], set(train.columns)
    out = Fitted(use_case)
    if "driver_experience_years" in have:
        train = cap_experience(train)
    if "ride_distance_km" in have and base in ("UC1", "UC2", "UC3"):
        out.distance = fit_distance(train)
    if "cancellation_rate" in have and base == "UC1":
        out.high_cancel = fit_high_cancel(train)
    if base in ("UC1", "UC2"):
        # Stored, so that their size is known to the joins: shares of few places are broadcast and no booking is shuffled.
        out.shares = {c: tables.settled(fit_shares(train, c), f"shares_{c}") for c in SHARE_COLUMNS if c in have}
        if "pickup_location" in have:
            out.hotspots = fit_hotspots(train)
    if base == "UC1" and {"cancellation_rate", "completed_rides", "total_bookings"} <= have:
        out.full_tenure = fit_tenure(train)
    if base == "UC3":
        out.lean_tenure = fit_tenure(train)
    out.scale = fit_scaler(train)
    return out


def apply_post_split(df: DataFrame, fitted: Fitted) -> DataFrame:
    if "driver_experience_years" in df.columns:
        df = cap_experience(df)
    if fitted.distance:
        df = apply_distance(df, fitted.distance)
    if fitted.high_cancel is not None:
        df = apply_high_cancel(df, fitted.high_cancel)
    for column, shares in fitted.shares.items():
        df = apply_shares(df, column, shares)
    if fitted.hotspots:
        df = apply_hotspots(df, fitted.hotspots)
    if fitted.full_tenure is not None:
        df = apply_full_loyalty(df, fitted.full_tenure)
    if fitted.lean_tenure is not None:
        df = apply_lean_loyalty(df, fitted.lean_tenure)
    return apply_scaler(df, fitted.scale)
