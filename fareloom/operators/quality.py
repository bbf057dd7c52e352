"""Profiling and data-quality reports. Each is one pass per table plus work on the small result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fareloom.functions.exprs import percent, round_stable, safe_ratio
from fareloom.functions.quantiles import quantile_values

# Fixed value: the relative tolerance that goes with each absolute one.
RELATIVE_TOLERANCE = 1e-5

# The categorical columns of bookings whose values are counted.
BOOKING_CATEGORIES = (
    "day_of_week", "city", "pickup_location", "drop_location", "vehicle_type", "traffic_level", "weather_condition",
    "booking_status", "incomplete_ride_reason",
)

_NUMERIC = ("int", "bigint", "double", "float", "smallint", "tinyint")


def numeric_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind in _NUMERIC]


def text_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


def _per_column(df: DataFrame, measures: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """One aggregate pass, then one row per column; `measures` is column -> measure name -> aggregate."""
    names = list(measures)
    aggregates = [expr.alias(f"{i}_{m}") for i, c in enumerate(names) for m, expr in measures[c].items()]
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"{i}_{m}").alias(m) for m in measures[c]])
        for i, c in enumerate(names)
    ])
    return df.agg(*aggregates).select(F.inline(rows))


def shapes(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).alias("columns"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def column_info(df: DataFrame) -> DataFrame:
    kinds = dict(df.dtypes)
    return _per_column(df, {c: {"dtype": F.any_value(F.lit(kinds[c])), "non_null": F.count(c)} for c in df.columns})


def null_counts(df: DataFrame) -> DataFrame:
    return _per_column(df, {c: {"nulls": F.count_if(F.col(c).isNull())} for c in df.columns})


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row. Copies combine on the map side, so one much-copied row is no hot spot."""
    return (
        df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
        .agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates"))
    )


def key_check(df: DataFrame, *keys: str) -> DataFrame:
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
    ).withColumn("is_unique", F.col("rows") == F.col("distinct_keys"))


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 4) -> DataFrame:
    columns = list(columns or numeric_columns(df))
    basics = _per_column(df, {c: {
        "count": F.count(c),
        "mean": round_stable(F.avg(c), digits),
        "std": round_stable(F.stddev_samp(c), digits),
        "min": F.min(c).cast("double"),
        "max": F.max(c).cast("double"),
    } for c in columns})
    found = quantile_values(df, columns, [0.25, 0.5, 0.75])
    quartiles = F.create_map(*[x for c, q in found.items() for x in (F.lit(c), F.array(*map(F.lit, q)))]) if found else F.create_map()
    return basics.select("*", *[
        round_stable(F.get(quartiles[F.col("column")], F.lit(i)), digits).alias(n) if found else F.lit(None).cast("double").alias(n)
        for i, n in enumerate(["q25", "q50", "q75"])])


def _value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])
    return df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def categorical_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per text column: non-null rows, distinct values, the most frequent value and its rows (ties by value)."""
    return (
        _value_counts(df, columns or text_columns(df))
        .filter(F.col("value").isNotNull())
        .groupBy("column")
        .agg(
            F.sum("count").alias("count"),
            F.count("value").alias("unique"),
            F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("top"),
            F.max("count").alias("freq"),
        )
    )


def top_values(df: DataFrame, columns: Sequence[str] | None = None, limit: int = 10) -> DataFrame:
    """Most frequent values per column; null is a value. The rank filter is pushed below the shuffle by Spark."""
    best = Window.partitionBy("column").orderBy(F.desc("count"), F.col("value").asc_nulls_last())
    return (
        _value_counts(df, columns or text_columns(df))
        .withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= limit)
        .select("column", "value", "count", "place")
    )


def nulls_by_group(df: DataFrame, group: str, column: str) -> DataFrame:
    return df.groupBy(group).agg(F.count_if(F.col(column).isNull()).alias("nulls"))


def _off(observed: Column, expected: Column, tolerance: float) -> Column:
    """True where two figures are not close; a missing figure is not close to anything."""
    close = F.abs(observed - expected) <= F.abs(expected) * RELATIVE_TOLERANCE + tolerance
    return ~F.coalesce(close, F.lit(False))


def _failures(df: DataFrame, failed: Column) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("checked"), F.count_if(failed).alias("failed"))


def booking_value_check(bookings: DataFrame) -> DataFrame:
    expected = round_stable(F.col("base_fare") * F.col("surge_multiplier"), 2)
    return _failures(bookings, _off(F.col("booking_value"), expected, 1.0))


def age_check(df: DataFrame, column: str, youngest: int, oldest: int) -> DataFrame:
    return _failures(df, (F.col(column) < youngest) | (F.col(column) > oldest))


def cancellation_rate_check(customers: DataFrame) -> DataFrame:
    expected = round_stable(safe_ratio(F.col("cancelled_rides"), F.col("total_bookings")), 6)
    return _failures(customers, _off(F.col("cancellation_rate"), expected, 0.001))


def total_bookings_check(customers: DataFrame) -> DataFrame:
    total = F.col("completed_rides") + F.col("cancelled_rides") + F.col("incomplete_rides")
    return _failures(customers, F.col("total_bookings") != total)


def driver_rate_checks(drivers: DataFrame) -> DataFrame:
    """Stated acceptance and delay rates against the counts they come from."""
    assigned = F.col("total_assigned_rides")
    accept = round_stable(safe_ratio(F.col("accepted_rides"), assigned), 2)
    delay = round_stable(safe_ratio(F.col("delay_count"), assigned), 2)
    return drivers.agg(
        F.count(F.lit(1)).alias("checked"),
        F.count_if(_off(F.col("acceptance_rate"), accept, 0.01)).alias("acceptance_failed"),
        F.count_if(_off(F.col("delay_rate"), delay, 0.01)).alias("delay_failed"),
    )


def rejected_rides_check(drivers: DataFrame) -> DataFrame:
    negative = drivers.agg(F.count_if(F.col("rejected_rides") < 0).alias("negative"))
    return numeric_summary(drivers, ["rejected_rides"], 2).withColumn("negative", negative.scalar())


def requests_check(location_demand: DataFrame) -> DataFrame:
    return _failures(location_demand, F.col("completed_rides") + F.col("cancelled_rides") > F.col("total_requests"))


def constant_check(df: DataFrame, column: str) -> DataFrame:
    """Whether a column holds a single value, which one, and its sum."""
    return df.agg(
        F.min(column).alias("smallest"), F.max(column).alias("largest"), F.sum(column).alias("total")
    ).withColumn("is_constant", F.col("smallest") == F.col("largest"))


def final_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns, nulls and repeated rows per table, from one grouping of its rows."""
    parts = []
    for name, df in tables.items():
        nulls = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in df.columns])
        parts.append(
            df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
            .agg(
                F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
                F.coalesce(F.sum(nulls * F.col("_copies")), F.lit(0)).alias("nulls"),
                F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates"),
            )
            .select(F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).alias("columns"), "nulls", "duplicates")
        )
    return reduce(DataFrame.unionByName, parts)


def join_check(before: DataFrame, after: DataFrame) -> DataFrame:
    """Whether a join kept the row count and left no suffixed columns."""
    clashes = [c for c in after.columns if c.endswith(("_x", "_y"))]
    count = F.count(F.lit(1))
    return (
        before.agg(count.alias("rows_before"))
        .withColumn("rows_after", after.agg(count).scalar())
        .withColumns({"suffix_columns": F.lit(len(clashes)), "preserved": F.col("rows_before") == F.col("rows_after")})
    )


def require_preserved(before: DataFrame, after: DataFrame) -> None:
    row = join_check(before, after).first()
    if not row["preserved"] or row["suffix_columns"]:
        raise ValueError(f"join changed the rows or left suffixed columns: {row.asDict()}")


def require_sound_split(split: DataFrame, features: Sequence[str], target: str) -> None:
    """Fail when the target is among the features or is missing somewhere."""
    if target in features:
        raise ValueError(f"target {target} is among the features")
    missing = split.agg(F.count_if(F.col(target).isNull())).first()[0]
    if missing:
        raise ValueError(f"{missing} rows have no {target}")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Share of each class; the window runs over one row per class."""
    all_classes = Window.partitionBy(F.lit(0))
    return (
        df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
        .withColumn("share", round_stable(percent(F.col("count"), F.sum("count").over(all_classes)) / 100, 3))
    )
