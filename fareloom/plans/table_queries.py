"""Catalog entries of the readers and writers: each writes a table derived from the sources and reads it back."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.operators import cleaning
from fareloom.plans.model_queries import rule_predictions
from fareloom.plans.quality_queries import five_tables
from fareloom.sources import schemas, tables
from fareloom.sources.ride_views import RideTables, StoredRideTables


def _raw_roundtrip(t: RideTables) -> DataFrame:
    path = tables.scratch_path(t.spark, "raw")
    tables.write_csv(t.raw_bookings, f"{path}/bookings.csv")
    return tables.read_csv(t.spark, f"{path}/bookings.csv", schemas.RAW_BOOKINGS)


def _raw_table(name: str) -> Callable[[RideTables], DataFrame]:
    """One of the five delivered CSV files, written and loaded together."""
    def loaded(t: RideTables) -> DataFrame:
        folder = tables.scratch_path(t.spark, "raw")
        tables.write_tables({**five_tables(t), "bookings": t.raw_bookings}, folder, "csv")
        return tables.load_raw_data(t.spark, folder)[name]
    return loaded


def _append_all(t: RideTables) -> DataFrame:
    """All five tables, each appended in three pieces; rows and distinct rows of what is stored."""
    folder, found = tables.scratch_path(t.spark, "appended"), {}
    for name, df in five_tables(t).items():
        for piece in range(3):
            rows = df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(3)) == piece)
            tables.append_rows(rows, f"{folder}/{name}", name)
        found[name] = t.spark.read.schema(schemas.TABLES[name]).parquet(f"{folder}/{name}")
    return tables.row_counts(found)


def _cleaned_roundtrip(t: RideTables) -> DataFrame:
    folder = tables.scratch_path(t.spark, "cleaned")
    tables.write_tables({**five_tables(t), "bookings": cleaning.clean_bookings(t.raw_bookings)}, folder)
    loaded = tables.load_cleaned_data(t.spark, folder)
    return tables.row_counts(loaded)


def _typed(t: RideTables) -> DataFrame:
    return schemas.narrow(cleaning.clean_bookings(t.raw_bookings), "bookings")


def _ride_time(t: RideTables) -> DataFrame:
    return schemas.load_form(t.bookings).select("booking_id", "booking_status", "actual_ride_time_min")


def _append(t: RideTables) -> DataFrame:
    path = f"{tables.scratch_path(t.spark, 'demand')}/location_demand"
    for level in ("High", "Medium", "Low"):
        tables.append_rows(t.location_demand.filter(F.col("demand_level") == level), path, "location_demand")
    stored = t.spark.read.schema(schemas.LOCATION_DEMAND).parquet(path)
    return stored.groupBy("demand_level").agg(F.count(F.lit(1)).alias("count"))


def _replace(t: RideTables) -> DataFrame:
    path = f"{tables.scratch_path(t.spark, 'predictions')}/predictions"
    t.predictions.filter(F.col("cancel_risk_tier") == "High").write.parquet(path)
    return tables.replace_predictions(t.predictions, path)


def _versions(t: RideTables) -> DataFrame:
    """Two model versions, the second at first with a part of its rows, both written again at the end."""
    path = f"{tables.scratch_path(t.spark, 'versions')}/predictions"
    first = t.predictions.withColumn("model_version", F.lit("v1"))
    second = t.predictions.withColumn("model_version", F.lit("v2"))
    tables.replace_versions(first, path)
    tables.replace_versions(second.filter(F.col("cancel_risk_tier") == "High"), path)
    tables.replace_versions(second.filter(F.col("cancel_risk_tier") != "Low"), path)
    stored = tables.replace_versions(first, path)
    return stored.groupBy("model_version", "cancel_risk_tier").agg(F.count(F.lit(1)).alias("count"))


def query_cache(t: StoredRideTables) -> tables.QueryCache:
    return t.kept("query cache", lambda: tables.QueryCache(t.spark))


def _cached(t: StoredRideTables) -> DataFrame:
    return query_cache(t).query("SELECT city, count(*) AS rides FROM {bookings} GROUP BY city", bookings=t.bookings)


def _typed_tables(t: RideTables) -> DataFrame:
    """The six empty typed tables in a database of their own, two of them filled."""
    database = f"rides_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {database}")
    location = tables.scratch_path(t.spark, "tables")
    tables.create_tables(t.spark, database, location)
    tables.append_rows(t.location_demand, f"{location}/location_demand", "location_demand")
    tables.append_rows(rule_predictions(t), f"{location}/predictions", "predictions")
    filled = {}
    for name in schemas.TABLES:
        t.spark.catalog.refreshTable(f"{database}.{name}")
        filled[name] = t.spark.table(f"{database}.{name}")
    counts = t.spark.createDataFrame(tables.row_counts(filled).collect(), "table_name STRING, row_count BIGINT")
    t.spark.sql(f"DROP DATABASE {database} CASCADE")  # one row per table is all that is left of it
    return counts


def _parameterised(t: RideTables) -> DataFrame:
    return tables.run_query(
        t.spark,
        """SELECT vehicle_type, count(*) AS rides FROM {bookings}
           WHERE city = :city AND hour_of_day BETWEEN :first AND :last GROUP BY vehicle_type""",
        {"city": "EUROPE", "first": 6, "last": 12}, bookings=t.bookings,
    )


ENTRIES: dict[str, Callable[[RideTables], DataFrame]] = {
    "s1_raw_csv": _raw_roundtrip,
    "s1_raw_customers": _raw_table("customers"),
    "s1_raw_drivers": _raw_table("drivers"),
    "s1_raw_location_demand": _raw_table("location_demand"),
    "s1_raw_time_features": _raw_table("time_features"),
    "s2_s3_cleaned_tables": _cleaned_roundtrip,
    "s4_typed_tables": _typed_tables,
    "s5_typed_bookings": _typed,
    "s6_known_ride_time": _ride_time,
    "s7_append": _append,
    "s7_append_all": _append_all,
    "s8_replace_predictions": _replace,
    "s8_versioned_predictions": _versions,
    "s9_row_counts": lambda t: tables.row_counts({**five_tables(t), "predictions": t.predictions}),
    "s10_run_query": _parameterised,
    "s11_cached_query": _cached,
}
