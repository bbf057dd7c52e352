"""The ride tables derived from the supplied order tables.

Each view is a lazy plan over `<sf_dir>/<table>.parquet`, so every query prunes and pushes down on its own.
The joins carry no hints: Spark broadcasts a side only when its measured size is under the session threshold.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property
from threading import Lock, RLock
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.functions.exprs import recommended_action, risk_tier, weekday_name
from fareloom.sources import schemas
from fareloom.sources.tables import drop_path, path_exists, scratch_path, settled


def _count(condition) -> F.Column:
    return F.count_if(condition)


class RideTables:
    """bookings, customers, drivers, location_demand, time_features and predictions of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def source(self, name: str) -> DataFrame:
        return self.spark.read.schema(schemas.SOURCES[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def order_legs(self) -> DataFrame:
        """One row per order: driver, legs, distance and discount taken from its lines."""
        return (
            self.source("lineitem")
            .groupBy("l_orderkey")
            .agg(
                F.min("l_suppkey").alias("driver_id"),
                F.count(F.lit(1)).alias("legs"),
                F.sum(F.col("l_quantity").cast("int")).alias("qty"),
                F.max(F.round(F.col("l_discount") * 100, 0).cast("int")).alias("disc_pct"),
            )
        )

    @cached_property
    def _rider_places(self) -> DataFrame:
        nation, region = self.source("nation"), self.source("region")
        return (
            self.source("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("c_custkey", F.col("r_name").alias("city"), F.col("n_name").alias("pickup_location"))
        )

    @cached_property
    def _driver_places(self) -> DataFrame:
        return (
            self.source("supplier")
            .join(self.source("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", F.col("n_name").alias("drop_location"))
        )

    def bookings_from(self, orders: DataFrame) -> DataFrame:
        """The bookings rows of an orders frame; `orders` may be a stream."""
        key, rider = F.col("o_orderkey"), F.col("o_custkey")
        hour = ((key * 7 + rider) % 24).cast("int")
        status = (
            F.when(F.col("o_orderstatus") == "F", "Completed")
            .when(F.col("o_orderstatus") == "O", "Cancelled")
            .otherwise("Incomplete")
        )
        reason = (
            F.when(F.col("o_orderstatus") != "P", "Not Applicable")
            .when(key % 4 == 0, "Driver Delay")
            .when(key % 4 == 1, "Customer No-Show")
            .when(key % 4 == 2, "Vehicle Issue")
            .otherwise("App Error")
        )
        traffic = (
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "High")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "Medium")
            .otherwise("Low")
        )
        when_booked = F.col("o_orderdate") + F.make_dt_interval(
            F.lit(0), hour, (key % 60).cast("int"), F.lit(0)
        )
        return (
            orders
            .join(self._rider_places, rider == F.col("c_custkey"))
            .join(self.order_legs, key == F.col("l_orderkey"))
            .join(self._driver_places, F.col("driver_id") == F.col("s_suppkey"))
            .select(
                key.alias("booking_id"),
                rider.alias("customer_id"),
                "driver_id",
                "city",
                "pickup_location",
                "drop_location",
                F.when(key % 3 == 0, "Cab").when(key % 3 == 1, "Auto").otherwise("Bike").alias("vehicle_type"),
                hour.alias("hour_of_day"),
                when_booked.alias("booking_datetime"),
                status.alias("booking_status"),
                reason.alias("incomplete_ride_reason"),
                traffic.alias("traffic_level"),
                F.when(rider % 3 == 0, "Clear").when(rider % 3 == 1, "Rain").otherwise("Heavy Rain")
                .alias("weather_condition"),
                (F.col("qty").cast("double") / 4).alias("ride_distance_km"),
                ((F.col("disc_pct") + 10).cast("double") / 10).alias("surge_multiplier"),
                (F.col("qty") * 2 + 20).cast("double").alias("base_fare"),
                (F.col("o_totalprice") / 1000).alias("booking_value"),
                (F.col("legs") * 8).cast("double").alias("estimated_ride_time_min"),
                F.when(F.col("o_orderstatus") == "F", (F.col("legs") * 8 + key % 15 - 5).cast("double"))
                .alias("actual_ride_time_min"),
            )
            .withColumns({
                "day_of_week": weekday_name(F.col("booking_datetime")),
                "is_weekend": (F.weekday("booking_datetime") >= 5).cast("int"),
            })
        )

    @cached_property
    def bookings(self) -> DataFrame:
        return self.bookings_from(self.source("orders"))

    @cached_property
    def customers(self) -> DataFrame:
        # Pre-aggregated per customer before the join, so a customer with very many bookings is one row.
        status = F.col("booking_status")
        rides = self.bookings.groupBy("customer_id").agg(
            F.count(F.lit(1)).alias("total_bookings"),
            _count(status == "Completed").alias("completed_rides"),
            _count(status == "Cancelled").alias("cancelled_rides"),
            _count(status == "Incomplete").alias("incomplete_rides"),
        )
        key = F.col("c_custkey")
        counts = ["total_bookings", "completed_rides", "cancelled_rides", "incomplete_rides"]
        return (
            self._rider_places
            .join(rides, key == F.col("customer_id"), "left")
            .select(
                key.alias("customer_id"),
                F.when(key % 3 == 0, "Male").when(key % 3 == 1, "Female").otherwise("Non-Binary")
                .alias("customer_gender"),
                (F.lit(18) + key % 47).cast("int").alias("customer_age"),
                F.col("city").alias("customer_city"),
                ((key * 13) % 1500).cast("int").alias("customer_signup_days_ago"),
                F.when(key % 3 == 0, "Bike").when(key % 3 == 1, "Cab").otherwise("Auto")
                .alias("preferred_vehicle_type"),
                *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
                (F.col("cancelled_rides").cast("double") / F.col("total_bookings")).alias("cancellation_rate"),
                ((F.lit(35) + key % 16).cast("double") / 10).alias("avg_customer_rating"),
            )
            .withColumn("customer_cancel_flag", F.coalesce(F.col("cancellation_rate") > 0.30, F.lit(False)).cast("int"))
        )

    @cached_property
    def drivers(self) -> DataFrame:
        ride, status = F.col("booking_id"), F.col("booking_status")
        rides = self.bookings.groupBy("driver_id").agg(
            F.count(F.lit(1)).alias("total_assigned_rides"),
            _count(ride % 5 != 0).alias("accepted_rides"),
            _count(ride % 5 == 0).alias("rejected_rides"),
            _count(status == "Incomplete").alias("incomplete_rides"),
            _count(F.col("actual_ride_time_min") > F.col("estimated_ride_time_min") + 6).alias("delay_count"),
        )
        key = F.col("s_suppkey")
        counts = ["total_assigned_rides", "accepted_rides", "rejected_rides", "incomplete_rides", "delay_count"]
        places = (
            self.source("supplier")
            .join(self.source("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.source("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("s_suppkey", F.col("r_name").alias("driver_city"))
        )
        return (
            places
            .join(rides, key == F.col("driver_id"), "left")
            .select(
                key.alias("driver_id"),
                (F.lit(20) + key % 40).cast("int").alias("driver_age"),
                "driver_city",
                F.when(key % 3 == 0, "Cab").when(key % 3 == 1, "Auto").otherwise("Bike").alias("vehicle_type"),
                (key % 15).cast("int").alias("driver_experience_years"),
                *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
                (F.col("accepted_rides").cast("double") / F.col("total_assigned_rides")).alias("acceptance_rate"),
                (F.col("delay_count").cast("double") / F.col("total_assigned_rides")).alias("delay_rate"),
                ((F.lit(30) + key % 21).cast("double") / 10).alias("avg_driver_rating"),
                ((key % 70).cast("double") / 10).alias("avg_pickup_delay_min"),
            )
            .withColumns({
                "driver_delay_flag": F.coalesce(F.col("delay_rate") > 0.10, F.lit(False)).cast("int"),
                "experience_outlier_flag": (F.col("driver_experience_years") > F.col("driver_age") - 18).cast("int"),
            })
        )

    @cached_property
    def location_demand(self) -> DataFrame:
        status, n = F.col("booking_status"), F.col("total_requests")
        return (
            self.bookings
            .groupBy("city", "pickup_location", "hour_of_day", "vehicle_type")
            .agg(
                F.count(F.lit(1)).alias("total_requests"),
                _count(status == "Completed").alias("completed_rides"),
                _count(status == "Cancelled").alias("cancelled_rides"),
                F.avg("estimated_ride_time_min").alias("avg_wait_time_min"),
                F.avg("surge_multiplier").alias("avg_surge_multiplier"),
            )
            .withColumn("demand_level", F.when(n >= 12, "High").when(n >= 6, "Medium").otherwise("Low"))
        )

    @cached_property
    def time_features(self) -> DataFrame:
        hour, month = F.hour("datetime"), F.month("datetime")
        return (
            self.bookings
            .select(F.date_trunc("hour", "booking_datetime").cast("timestamp_ntz").alias("datetime"))
            .distinct()
            .select(
                "datetime",
                hour.alias("hour_of_day"),
                weekday_name(F.col("datetime")).alias("day_of_week"),
                (F.weekday("datetime") >= 5).cast("int").alias("is_weekend"),
                F.lit(0).alias("is_holiday"),
                (hour.between(7, 10) | hour.between(17, 21)).cast("int").alias("peak_time_flag"),
                F.when(month.isin(12, 1, 2), "Winter").when(month.between(3, 6), "Summer").otherwise("Monsoon")
                .alias("season"),
            )
        )

    def predictions_from(self, bookings: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """Rule-scored predictions; the rule stands in for a model so that results can be checked exactly."""
        score = ((F.col("booking_id") * 37 + F.col("customer_id")) % 100).cast("double") / 100
        return bookings.select(
            *keep, "booking_id", "city", "vehicle_type", "hour_of_day", "traffic_level", "weather_condition",
            "ride_distance_km", "surge_multiplier",
            score.alias("cancel_probability"),
            risk_tier(score).alias("cancel_risk_tier"),
            recommended_action(risk_tier(score)).alias("recommended_action"),
            F.lit(0.60).alias("uc3_threshold_used"),
            (F.col("base_fare") * F.col("surge_multiplier")).alias("predicted_fare"),
            F.col("booking_value").alias("actual_fare"),
            (F.col("booking_status") == "Completed").cast("int").alias("actual_completed_flag"),
            (F.col("booking_status") == "Cancelled").cast("int").alias("actual_cancelled_flag"),
        )

    @cached_property
    def predictions(self) -> DataFrame:
        return self.predictions_from(self.bookings)

    @cached_property
    def raw_bookings(self) -> DataFrame:
        """Bookings in delivery form: text ids and dates, untidy categories, open reasons, repeated rows."""
        tidy = self.bookings.select(
            F.concat(F.lit("B_"), F.lpad(F.col("booking_id").cast("string"), 12, "0")).alias("booking_id"),
            F.date_format("booking_datetime", "yyyy-MM-dd").alias("booking_date"),
            F.date_format("booking_datetime", "HH:mm:ss").alias("booking_time"),
            F.concat(F.lit(" "), F.lower("city"), F.lit(" ")).alias("city"),
            "pickup_location", "drop_location",
            F.upper("vehicle_type").alias("vehicle_type"),
            F.lower("traffic_level").alias("traffic_level"),
            F.lower("weather_condition").alias("weather_condition"),
            F.lower("booking_status").alias("booking_status"),
            F.when(F.col("booking_status") == "Incomplete", F.lower("incomplete_ride_reason"))
            .alias("incomplete_ride_reason"),
            "hour_of_day", "ride_distance_km", "estimated_ride_time_min", "actual_ride_time_min",
            "base_fare", "surge_multiplier", "booking_value", "customer_id", "driver_id",
            F.col("booking_id").alias("_ride"),
        )
        copies = F.when(F.col("_ride") % 50 == 0, 2).otherwise(1)
        return (
            tidy.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
            .drop("_copy", "_ride")
        )


class StoredRideTables(RideTables):
    """The same tables, each written once to the scratch folder and then read from there.

    For work that reads them many times (the wide table reads bookings five times, training far more often).
    Stored sides also have a known size, so Spark can broadcast the small ones.
    """

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, folder)
        self.root = scratch_path(spark, "rides")
        self._kept: dict[str, Any] = {}
        self._guard, self._builds = Lock(), {}

    def _store(self, df: DataFrame, name: str, even: bool = False) -> DataFrame:
        return settled(df, name.replace(" ", "_"), even, self.root)

    def kept(self, name: str, build: Callable[[], Any]) -> Any:
        """The result of `build`, made once, also where several threads ask for it; a DataFrame is stored in the scratch folder."""
        with self._guard:
            building = self._builds.setdefault(name, RLock())
        with building:
            if name not in self._kept:
                made = build()
                self._kept[name] = self._store(made, name) if isinstance(made, DataFrame) else made
            return self._kept[name]

    # Sides of the booking join are stored as well: a stream joins each of its batches with them.
    @cached_property
    def order_legs(self) -> DataFrame:
        return self._store(RideTables.order_legs.func(self), "order_legs")

    @cached_property
    def _rider_places(self) -> DataFrame:
        return self._store(RideTables._rider_places.func(self), "rider_places")

    @cached_property
    def _driver_places(self) -> DataFrame:
        return self._store(RideTables._driver_places.func(self), "driver_places")

    @cached_property
    def bookings(self) -> DataFrame:
        return self._store(RideTables.bookings.func(self), "bookings", even=True)

    @cached_property
    def customers(self) -> DataFrame:
        return self._store(RideTables.customers.func(self), "customers")

    @cached_property
    def drivers(self) -> DataFrame:
        return self._store(RideTables.drivers.func(self), "drivers")

    @cached_property
    def location_demand(self) -> DataFrame:
        return self._store(RideTables.location_demand.func(self), "location_demand")

    @cached_property
    def time_features(self) -> DataFrame:
        return self._store(RideTables.time_features.func(self), "time_features")


_stored: dict[tuple[str, str], StoredRideTables] = {}


def ride_tables(spark: SparkSession, folder: str) -> RideTables:
    return RideTables(spark, folder)


def stored_ride_tables(spark: SparkSession, folder: str) -> StoredRideTables:
    """Stored tables of a folder, written at most once per application (see `forget_stored`)."""
    key = (spark.sparkContext.applicationId, folder)
    known = _stored.get(key)
    if known is None or ("bookings" in known.__dict__ and not path_exists(spark, known.root)):
        _stored[key] = StoredRideTables(spark, folder)
    return _stored[key]


def forget_stored(spark: SparkSession, folder: str) -> None:
    """Have the tables of a folder derived anew at the next use, after its sources have changed."""
    known = _stored.pop((spark.sparkContext.applicationId, folder), None)
    if known is not None:
        drop_path(spark, known.root)
