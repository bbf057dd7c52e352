"""Ordinal, binary and one-hot encodings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions.exprs import flag, mapped
from fareloom.operators.features import ACCEPTANCE_BINS, AGE_BINS, EXPERIENCE_BINS, WAIT_BINS

# Ordinal codes.
LEVEL_CODES = {"Low": 0, "Medium": 1, "High": 2}
WEATHER_CODES = {"Clear": 0, "Rain": 1, "Heavy Rain": 2}
STATUS_CODES = {"Completed": 0, "Cancelled": 1, "Incomplete": 2}

# One-hot columns and the prefix of their outputs.
ONE_HOT_PREFIX = {"incomplete_ride_reason": "reason"}
ONE_HOT_COLUMNS = (
    "incomplete_ride_reason", "customer_city", "driver_city", "preferred_vehicle_type", "season", "day_of_week",
    "vehicle_type", "city", "customer_gender",
)
Categories = dict[str, list[str]]


def add_ordinal_codes(df: DataFrame) -> DataFrame:
    made = {
        "is_cancelled": flag(F.col("booking_status") == "Cancelled"),
        "traffic_enc": mapped(F.col("traffic_level"), LEVEL_CODES),
        "weather_enc": mapped(F.col("weather_condition"), WEATHER_CODES),
        "booking_status_enc": mapped(F.col("booking_status"), STATUS_CODES),
    }
    if "demand_level" in df.columns:
        made["demand_enc"] = mapped(F.col("demand_level"), LEVEL_CODES)
    return df.withColumns(made)


def add_bin_codes(df: DataFrame) -> DataFrame:
    """Codes of the interval columns. A value outside all intervals has no code and is imputed later."""
    sources = {
        "driver_experience_enc": ("driver_experience_bin", EXPERIENCE_BINS),
        "driver_acceptance_enc": ("driver_acceptance_tier", ACCEPTANCE_BINS),
        "customer_age_enc": ("customer_age_bin", AGE_BINS),
        "wait_time_enc": ("wait_time_bin", WAIT_BINS),
    }
    return df.withColumns({
        name: mapped(F.col(source), {label: code for code, label in enumerate(labels)})
        for name, (source, (_, labels)) in sources.items() if source in df.columns
    })


def fit_categories(df: DataFrame, columns: Sequence[str] = ONE_HOT_COLUMNS) -> Categories:
    """Sorted distinct values per column, read in one pass. Values combine on the map side before the shuffle."""
    columns = [c for c in columns if c in df.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    found = df.select(F.inline(pairs)).filter(F.col("value").isNotNull()).distinct()
    # a column per value is the wanted output, so the values are as few as the columns that a frame can have
    values = {r["column"]: r["values"] for r in found.groupBy("column").agg(F.sort_array(F.collect_list("value")).alias("values")).collect()}
    return {c: values.get(c, []) for c in columns}


def one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """A 0/1 column per fitted value but the first; the source column goes. An unknown value or null is all 0."""
    made = {
        f"{ONE_HOT_PREFIX.get(c, c)}_{value}": flag(F.col(c) == value)
        for c, values in categories.items() if c in df.columns for value in values[1:]
    }
    return df.withColumns(made).drop(*categories)


def booleans_to_int(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("int") for name, kind in df.dtypes if kind == "boolean"})


def encode_features(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    return (
        df.transform(add_ordinal_codes)
        .transform(one_hot, categories)
        .transform(add_bin_codes)
        .transform(booleans_to_int)
    )


def tidy_name(name: str) -> str:
    return name.translate({ord(c): "_" for c in "[]<> ,"})


def tidy_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: tidy_name(c) for c in df.columns if tidy_name(c) != c})
