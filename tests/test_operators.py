"""Cleaning, joins, encodings, fitted transforms, selection and quality checks on small hand-made frames."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from fareloom.operators import cleaning, encoding, features, fitted, joins, quality, scoring, selection, usecases
from fareloom.sources import schemas, tables


def test_clean_bookings(spark):
    rows = [
        ("B_000001", "2024-01-02", "03:04:05", " delhi ", "L1", "L1", "CAB", "high", "heavy rain", "incomplete",
         "customer no-show", 3, 1.0, 2.0, None, 3.0, 1.0, 3.0, "C1", "D1"),
        ("B_000002", "2024-01-02", "23:59:59", "Pune", None, "L1", "auto", "low", "clear", "completed",
         None, 23, 1.0, 2.0, 5.0, 3.0, 1.0, 3.0, "C1", "D1"),
    ]
    raw = spark.createDataFrame(rows + rows[:1], schemas.RAW_BOOKINGS)
    clean = {r["booking_id"]: r for r in cleaning.clean_bookings(raw).collect()}
    first, second = clean["B_000001"], clean["B_000002"]
    assert len(clean) == 2 and str(first["booking_datetime"]) == "2024-01-02 03:04:05"
    assert (first["city"], first["weather_condition"], first["incomplete_ride_reason"]) == (
        "Delhi", "Heavy Rain", "Customer No-Show")
    assert (first["same_loc_flag"], second["same_loc_flag"]) == (1, 0)
    assert (first["actual_time_available"], second["actual_time_available"]) == (0, 1)
    assert second["incomplete_ride_reason"] == "Not Applicable"
    typed = schemas.load_form(cleaning.clean_bookings(raw))
    assert dict(typed.dtypes)["booking_id"] == "bigint"
    assert {r["booking_id"]: r["actual_ride_time_min"] for r in typed.collect()} == {1: 0.0, 2: 5.0}


def test_ids_and_nan(spark):
    ids = spark.createDataFrame([("B_0042",), ("x",), (None,)], "t STRING").select(schemas.digits_of(F.col("t")))
    assert [r[0] for r in ids.collect()] == [42, None, None]
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "acceptance_rate DOUBLE")
    assert [r[0] for r in schemas.narrow(df, "drivers").collect()] == [None, 1.0]


def test_joins_never_multiply_bookings(spark):
    bookings = spark.createDataFrame([(1, "C", 7), (2, "C", 7), (3, "X", 9)], "booking_id INT, city STRING, hour_of_day INT")
    bookings = bookings.withColumns({"pickup_location": F.lit("p"), "vehicle_type": F.lit("Cab")})
    side = spark.createDataFrame([("C", "p", 7, "Cab", 5, "High"), ("C", "p", 7, "Cab", 4, "Low")],
                                 "city STRING, pickup_location STRING, hour_of_day INT, vehicle_type STRING, total_requests INT, demand_level STRING")
    joined = joins.with_location(bookings, side)
    assert {r["booking_id"]: r["loc_total_requests"] for r in joined.collect()} == {1: 4, 2: 4, 3: None}
    quality.require_preserved(bookings, joined)
    with pytest.raises(ValueError):
        quality.require_preserved(bookings, bookings.unionByName(bookings))


def test_one_hot_drops_the_first_and_ignores_unknown(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c")], "i INT, city STRING")
    cats = encoding.fit_categories(df, ["city"])
    assert cats == {"city": ["a", "b", "c"]}
    fresh = spark.createDataFrame([(1, "c"), (2, "zzz"), (3, None)], "i INT, city STRING")
    hot = encoding.one_hot(fresh, cats).orderBy("i")
    assert hot.columns == ["i", "city_b", "city_c"] and [tuple(r)[1:] for r in hot.collect()] == [(0, 1), (0, 0), (0, 0)]
    many = spark.range(1500).select(F.format_string("c%04d", "id").alias("city"))
    assert encoding.fit_categories(many, ["city"]) == {"city": [f"c{i:04d}" for i in range(1500)]}


def test_tidy_names():
    assert encoding.tidy_name("reason_Customer No-Show") == "reason_Customer_No-Show"
    assert encoding.tidy_name("a[b]<c>,d e") == "a_b__c__d_e"


def test_log_transform_keeps_nulls_and_clips(spark):
    df = spark.createDataFrame([(1, -5.0), (2, None), (3, math.e - 1)], "i INT, base_fare DOUBLE")
    got = [r["base_fare"] for r in features.log_transform(df).orderBy("i").collect()]
    assert got[0] == 0.0 and got[1] is None and got[2] == pytest.approx(1.0)


def test_outcome_interactions_need_their_inputs(spark):
    df = spark.createDataFrame([(1, 2)], "is_low_rated_customer INT, is_low_rated_driver INT")
    assert features.add_outcome_interactions(df).columns == [
        "is_low_rated_customer", "is_low_rated_driver", "dual_low_rating"]


def test_scaler_uses_population_deviation_and_keeps_constants(spark):
    train = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0), (None, 4.0)], "base_fare DOUBLE, delay_rate DOUBLE")
    scale = fitted.fit_scaler(train)
    assert scale == {"base_fare": (2.0, 1.0), "delay_rate": (4.0, 1.0)}
    assert [tuple(r) for r in fitted.apply_scaler(train, scale).collect()] == [(-1.0, 0.0), (1.0, 0.0), (None, 0.0)]


def test_unseen_location_and_experience_cap(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "pickup_location STRING")
    shares = fitted.fit_shares(train, "pickup_location")
    fresh = spark.createDataFrame([("a",), ("new",), (None,)], "pickup_location STRING")
    got = {r["pickup_location"]: r["pickup_location_freq"] for r in
           fitted.apply_shares(fresh, "pickup_location", shares).collect()}
    assert got == {"a": pytest.approx(2 / 3), "new": 0.0, None: 0.0}
    df = spark.createDataFrame([(20, 9), (40, 9), (40, -1), (None, 3)], "driver_age INT, driver_experience_years INT")
    assert [r["driver_experience_years"] for r in fitted.cap_experience(df).collect()] == [2, 9, 0, None]


def test_fitted_parameters_survive_storage(spark):
    learned = fitted.Fitted("UC1", distance=[1.0, 2.0], hotspots=["a"], scale={"x": (1.0, 2.0)}, medians={"x": 3.0},
                            shares={"pickup_location": spark.createDataFrame([("a", 0.5)], "value STRING, share DOUBLE")})
    path = tables.scratch_path(spark, "fitted")
    learned.save(spark, path)
    back = fitted.Fitted.load(spark, path)
    assert (back.distance, back.hotspots, back.scale, back.medians) == ([1.0, 2.0], ["a"], {"x": (1.0, 2.0)}, {"x": 3.0})
    assert back.shares["pickup_location"].collect() == learned.shares["pickup_location"].collect()
    assert tables.load_json(spark, path + "/absent", "none") == "none"


def test_medians_fill_and_default(spark):
    df = spark.createDataFrame([(1, None, None), (2, 4.0, None), (3, 8.0, None)], "booking_id INT, x DOUBLE, y DOUBLE")
    medians = fitted.fit_medians(df)
    assert medians == {"x": 6.0}
    assert [tuple(r) for r in fitted.apply_medians(df, medians).orderBy("booking_id").collect()] == [
        (1, 6.0, 0.0), (2, 4.0, 0.0), (3, 8.0, 0.0)]


def test_medians_fill_gaps_that_training_has_not(spark):
    train = spark.createDataFrame([(1, 4.0, 1), (2, 5.0, 3)], "booking_id INT, rating DOUBLE, k INT")
    medians = fitted.fit_medians(train)
    assert medians == {"rating": 4.5, "k": 2.0}
    fresh = spark.createDataFrame([(9, None, None)], "booking_id INT, rating DOUBLE, k INT")
    assert [tuple(r) for r in fitted.apply_medians(fresh, medians).collect()] == [(9, 4.5, 2.0)]


def test_nothing_to_fit_skips_the_step(spark):
    df = spark.createDataFrame([(1, None, None, None)], "booking_id INT, ride_distance_km DOUBLE, cancellation_rate DOUBLE, customer_signup_days_ago INT")
    for frame in (df, df.filter("false")):
        assert fitted.fit_distance(frame) is None and fitted.fit_high_cancel(frame) is None and fitted.fit_tenure(frame) is None
    assert fitted.apply_distance(df, None) is df and fitted.apply_high_cancel(df, None) is df


def test_rows_without_a_class_are_split_too(spark):
    from fareloom.operators import splitting

    df = spark.createDataFrame([(i, None if i < 10 else 1) for i in range(30)], "booking_id INT, y INT")
    counts = {(r["y"], r["split"]): r["count"] for r in splitting.train_test(df, "booking_id", "y").groupBy("y", "split").count().collect()}
    assert counts == {(None, "test"): 2, (None, "train"): 8, (1, "test"): 4, (1, "train"): 16}


def test_constant_column_has_no_correlation_and_is_kept(spark):
    rows = [(float(i), float(2 * i), 1.0, float(i % 2), float(i % 2 if i < 38 else 1 - i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE, y DOUBLE, d DOUBLE")
    found = {r["feature"]: r["correlation"] for r in selection.target_correlations(df, ["a", "b", "c", "d"], "y").collect()}
    assert found["c"] is None and found["a"] == pytest.approx(found["b"]) and found["d"] > 0.8
    kept, report = selection.correlation_filter(df, ["a", "b", "c", "d"], "y", 0.01, 0.95)
    assert kept == ["b", "c", "d"] and report["redundant"] == ["a"] and report["low_target_correlation"] == []


@pytest.mark.parametrize("strength, expected", [
    ({"a": 0.5, "b": 0.4, "c": 0.3}, {"b", "c"}),
    ({"a": 0.3, "b": 0.4, "c": 0.5}, {"a", "b"}),
    ({"a": 0.5, "b": 0.5, "c": 0.5}, {"a", "b"}),
])
def test_redundancy_keeps_the_strongest(strength, expected):
    ones = [[1.0] * 3 for _ in range(3)]
    assert selection.redundant_features(["a", "b", "c"], ones, strength, 0.95) == expected


def test_importance_filter_needs_one_rule(spark):
    df = spark.createDataFrame([(0.0, 1.0)], "x DOUBLE, y DOUBLE")
    for kwargs in ({}, {"top_n": 1, "threshold": 0.1}):
        with pytest.raises(ValueError):
            selection.importance_filter(df, ["x"], "y", False, **kwargs)


def test_leakage_lists_leave_the_target(spark):
    columns = ["booking_id", "is_cancelled", "booking_status_enc", "reason_Vehicle Issue", "reason_App Error", "delay_per_km", "x"]
    df = spark.createDataFrame([tuple([1] * len(columns))], columns).withColumn("ride_vehicle_type", F.lit("Cab"))
    assert usecases.project(df, "UC3").columns == ["booking_id", "is_cancelled", "x"]
    assert usecases.project(df, "UC1").columns == ["booking_id", "booking_status_enc", "delay_per_km", "x"]
    assert usecases.project(df, "UC2_Bike").count() == 0 and usecases.project(df, "UC2_Cab").count() == 1
    with pytest.raises(ValueError):
        quality.require_sound_split(df, ["is_cancelled"], "is_cancelled")


def test_threshold_clamp(spark):
    df = spark.createDataFrame([(0.54,), (0.55,), (0.7,), (0.71,), (None,)], "x DOUBLE")
    assert [r[0] for r in df.select(scoring.clamp_threshold(F.col("x"))).collect()] == [0.6, 0.55, 0.7, 0.6, 0.6]
    assert [scoring.clamped(v) for v in (0.54, 0.55, 0.7, 0.71)] == [0.6, 0.55, 0.7, 0.6]


def test_quality_on_empty_and_null_frames(spark):
    empty = spark.createDataFrame([], "a INT, b STRING")
    assert quality.duplicate_rows(empty).first()[0] == 0
    assert quality.key_check(empty, "a").first().asDict() == {"rows": 0, "distinct_keys": 0, "is_unique": True}
    assert {r["column"]: r["nulls"] for r in quality.null_counts(empty).collect()} == {"a": 0, "b": 0}
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a INT, b STRING")
    assert quality.duplicate_rows(df).first()[0] == 1
    assert {(r["value"], r["count"]) for r in quality.top_values(df).collect()} == {(None, 2), ("x", 1)}
    off = spark.createDataFrame([(10.0, 10.0, 1.0), (10.0, 12.0, 1.0), (None, 1.0, 1.0)],
                                "booking_value DOUBLE, base_fare DOUBLE, surge_multiplier DOUBLE")
    assert quality.booking_value_check(off).first()["failed"] == 2


def test_csv_and_query(spark):
    path = tables.scratch_path(spark, "csv")
    df = spark.createDataFrame([(" a ", 1.5), (None, None)], "city STRING, base_fare DOUBLE")
    tables.write_csv(df, path)
    assert {tuple(r) for r in tables.read_csv(spark, path, df.schema).collect()} == {(" a ", 1.5), (None, None)}
    got = tables.run_query(spark, "SELECT city FROM {t} WHERE base_fare > :low", {"low": 1}, t=df)
    assert [r[0] for r in got.collect()] == [" a "]
    kept = tables.QueryCache(spark).query("SELECT count(*) AS n FROM {t}", t=df)
    assert kept.is_cached and kept.first()["n"] == 2
    kept.unpersist()
    with pytest.raises(Exception):
        tables.run_query(spark, "SELECT nothing_here FROM {t}", t=df)


def test_catalog_tables(spark, tmp_path):
    made = tables.create_tables(spark, location=str(tmp_path))
    assert made == list(schemas.TABLES)
    assert spark.table("predictions").schema.fieldNames() == schemas.PREDICTIONS.names
    for name in made:
        spark.sql(f"DROP TABLE {name}")


def test_stored_tables_are_made_again_after_their_folder_is_gone(spark, sf_dir):
    from fareloom.sources.ride_views import forget_stored, stored_ride_tables

    first = stored_ride_tables(spark, sf_dir + "/")
    rows = first.time_features.count()
    assert stored_ride_tables(spark, sf_dir + "/") is first
    first.root += "-gone"
    second = stored_ride_tables(spark, sf_dir + "/")
    assert second is not first and second.time_features.count() == rows
    forget_stored(spark, sf_dir + "/")
    assert stored_ride_tables(spark, sf_dir + "/") is not second


def test_constant_over_many_partitions(spark):
    """Partial deviations of a constant do not add up to exactly zero over partitions, some of them empty."""
    df = spark.range(0, 4900, 1, 100).filter("id % 7 <> 3 OR id > 400").select(
        F.lit(1.1).alias("base_fare"), (F.col("id") % 13).cast("double").alias("delay_rate"),
        (F.col("id") % 2).cast("double").alias("y")).filter("y >= 0")
    found = {r["feature"]: r["correlation"] for r in
             selection.target_correlations(df, ["base_fare", "delay_rate"], "y").collect()}
    assert found["base_fare"] is None and found["delay_rate"] is not None
    assert fitted.fit_scaler(df)["base_fare"][1] == 1.0
    matrix = selection.correlation_matrix(df, ["base_fare", "delay_rate", "y"])
    assert math.isnan(matrix[0][2]) and not math.isnan(matrix[1][2])


def test_correlations_of_many_features_are_one_narrow_aggregate(spark):
    """A wide aggregate of all features is too long for compiled code; nulls and features without values stay as they were."""
    names = [f"f{i}" for i in range(60)]
    df = spark.range(40).select(
        F.sin("id").alias("y"), F.lit(None).cast("double").alias("none"),
        *[F.when(F.col("id") % 7 != i % 7, F.cos(F.col("id") * (i + 1))).alias(n) for i, n in enumerate(names)])
    made = selection.target_correlations(df, ["none", *names], "y")
    assert made._jdf.queryExecution().optimizedPlan().toString().count("stddev_pop") <= 2
    found = {r["feature"]: r["correlation"] for r in made.collect()}
    assert len(found) == 61 and found["none"] is None
    for i in (0, 13, 59):
        pairs = [(math.cos(k * (i + 1)), math.sin(k)) for k in range(40) if k % 7 != i % 7]
        mx, my = (sum(p[j] for p in pairs) / len(pairs) for j in (0, 1))
        cov = sum((x - mx) * (y - my) for x, y in pairs)
        spread = math.sqrt(sum((x - mx) ** 2 for x, _ in pairs) * sum((y - my) ** 2 for _, y in pairs))
        assert found[f"f{i}"] == pytest.approx(cov / spread)
    empty = selection.target_correlations(df.filter("id < 0"), ["f0"], "y").collect()
    assert [tuple(r) for r in empty] == [("f0", None)]
