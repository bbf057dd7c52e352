"""Versioned predictions, the query cache, artifact sets, and the sink that counts each row once."""

from __future__ import annotations

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from fareloom.operators import artifacts
from fareloom.operators.fitted import Fitted
from fareloom.plans import model_queries as models
from fareloom.sources import tables as store
from fareloom.streaming import rides

PREDICTION = "booking_id BIGINT, model_version STRING, score DOUBLE"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


# Versioned predictions ---------------------------------------------------------------------------------------------

def test_versions_replace_only_themselves(spark):
    path = store.scratch_path(spark, "versions")
    one = spark.createDataFrame([(1, "a", 0.1), (2, "a", 0.2)], PREDICTION)
    two = spark.createDataFrame([(1, "b/c d", 0.3)], PREDICTION)
    assert rows_of(store.replace_versions(one, path)) == rows_of(one)
    assert rows_of(store.replace_versions(two, path)) == rows_of(one.union(two))
    fewer = one.filter("booking_id = 2").withColumn("score", F.lit(0.9))
    assert rows_of(store.replace_versions(fewer, path)) == rows_of(fewer.union(two))
    again = store.replace_versions(fewer, path)
    assert rows_of(again) == rows_of(fewer.union(two)) and again.columns == one.columns
    assert rows_of(store.replace_versions(one.limit(0), path)) == rows_of(fewer.union(two))


def test_versions_may_be_replaced_from_the_table_itself(spark):
    path = store.scratch_path(spark, "versions")
    stored = store.replace_versions(spark.createDataFrame([(i, "a", 0.5) for i in range(20)], PREDICTION), path)
    raised = store.replace_versions(stored.withColumn("score", F.col("score") + 1), path)
    assert {r["score"] for r in raised.collect()} == {1.5} and raised.count() == 20


@pytest.mark.parametrize("bad", [
    [(1, "a", 0.1), (1, "a", 0.2)],
    [(None, "a", 0.1)],
    [(1, None, 0.1)],
])
def test_a_bad_key_leaves_the_table(spark, bad):
    path = store.scratch_path(spark, "versions")
    good = spark.createDataFrame([(7, "a", 0.7)], PREDICTION)
    store.replace_versions(good, path)
    with pytest.raises(ValueError, match="unique"):
        store.replace_versions(spark.createDataFrame(bad, PREDICTION), path)
    assert rows_of(spark.read.schema(good.schema).parquet(path).select(*good.columns)) == rows_of(good)


def test_a_failing_write_leaves_the_table(spark):
    path = store.scratch_path(spark, "versions")
    good = spark.createDataFrame([(i, "a", 0.7) for i in range(50)], PREDICTION)
    store.replace_versions(good, path)
    failing = good.repartition(5).withColumn("score", F.when(F.col("booking_id") == 33, F.raise_error(F.lit("stop")).cast("double"))
                                             .otherwise(F.lit(0.0)))
    with pytest.raises(Exception, match="stop"):
        store.replace_versions(failing, path)
    assert rows_of(spark.read.schema(good.schema).parquet(path).select(*good.columns)) == rows_of(good)


# Query cache -------------------------------------------------------------------------------------------------------

class Clock:
    now = 0.0

    def __call__(self):
        return self.now


def test_cache_hits_expires_and_releases(spark):
    clock = Clock()
    cache = store.QueryCache(spark, 300, clock)
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "k INT, v STRING")
    sql = "SELECT count(*) AS n FROM {t} WHERE v = :v"
    first = cache.query(sql, {"v": "b"}, t=df)
    assert first.first()["n"] == 2 and first.is_cached
    clock.now = 299.0
    assert cache.query(sql, {"v": "b"}, t=df) is first
    assert cache.query(sql, {"v": "a"}, t=df).first()["n"] == 1 and len(cache) == 2
    assert cache.query(sql, {"v": "b"}, t=df.filter("k < 3")).first()["n"] == 1 and len(cache) == 3
    clock.now = 300.0
    second = cache.query(sql, {"v": "b"}, t=df)
    assert second is not first and second.first()["n"] == 2 and len(cache) == 3
    clock.now = 10_000.0
    cache.query("SELECT 1 AS one")
    assert len(cache) == 1 and not second.is_cached and second.first()["n"] == 2
    cache.release()
    assert len(cache) == 0


def test_a_failing_query_is_not_kept(spark):
    cache = store.QueryCache(spark)
    with pytest.raises(Exception):
        cache.query("SELECT no_such_column FROM {t}", t=spark.range(3))
    assert len(cache) == 0


# Artifacts ---------------------------------------------------------------------------------------------------------

def test_fingerprint_sees_rows_nulls_and_parameters_but_no_order(spark):
    kind = "a DOUBLE, b DOUBLE, c STRING"
    rows = [(1.0, None, "x"), (None, 1.0, "y"), (2.5, 3.5, None)]
    df = spark.createDataFrame(rows, kind)
    mark = artifacts.fingerprint(df, {"p": 1})
    assert artifacts.fingerprint(spark.createDataFrame(rows[::-1], kind).repartition(3), {"p": 1}) == mark
    moved = spark.createDataFrame([(None, 1.0, "x"), (1.0, None, "y"), rows[2]], kind)
    others = [
        artifacts.fingerprint(df, {"p": 2}), artifacts.fingerprint(df.union(df.limit(1)), {"p": 1}),
        artifacts.fingerprint(moved, {"p": 1}), artifacts.fingerprint(df.limit(0), {"p": 1}),
        artifacts.fingerprint(df.withColumnRenamed("a", "z"), {"p": 1}),
    ]
    assert len({mark, *others}) == 6
    assert artifacts.fingerprint(df.withColumn("a", F.col("a") + 1e-15), {"p": 1}) == mark


def test_once_computes_once(spark):
    folder, calls = store.scratch_path(spark, "artifacts"), []

    def compute():
        calls.append(1)
        return {"value": [1, 0.1, None]}

    assert [artifacts.once(spark, folder, "m", compute) for _ in range(2)] == [{"value": [1, 0.1, None]}] * 2
    assert len(calls) == 1


def test_half_a_set_is_no_set(spark, monkeypatch):
    folder = store.scratch_path(spark, "artifacts")
    df = spark.createDataFrame([(float(i), float(i % 3 > 0)) for i in range(30)], "x DOUBLE, label DOUBLE")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), LogisticRegression(maxIter=3)]).fit(df)
    shares = spark.createDataFrame([("p", 0.25)], "pickup_location STRING, share DOUBLE")
    made = artifacts.ArtifactSet(model, ["x"], Fitted("UC1", scale={"x": (1.0, 2.0)}, shares={"pickup_location": shares}),
                                 {"city": ["A", "B"]}, {"t": 0.6}, {"chosen": "L"}, {"L": {"f1": 0.5}})
    whole = store.save_json
    monkeypatch.setattr(store, "save_json", lambda spark, content, path: (_ for _ in ()).throw(RuntimeError("lost"))
                        if path.endswith("manifest") else whole(spark, content, path))
    with pytest.raises(RuntimeError):
        artifacts.save_set(spark, folder, "m", made)
    assert artifacts.load_set(spark, folder, "m") is None
    monkeypatch.setattr(store, "save_json", whole)
    artifacts.save_set(spark, folder, "m", made)
    found = artifacts.load_set(spark.newSession(), folder, "m")
    assert (found.features, found.categories, found.thresholds) == (["x"], {"city": ["A", "B"]}, {"t": 0.6})
    assert found.fitted.scale == {"x": (1.0, 2.0)} and rows_of(found.fitted.shares["pickup_location"]) == rows_of(shares)
    assert rows_of(found.model.transform(df).select("x", "prediction")) == rows_of(model.transform(df).select("x", "prediction"))


def test_a_three_class_model_predicts_the_same_once_loaded(spark):
    df = spark.createDataFrame([(i, float(i % 7), float(i * 5 % 11), float(i % 7 // 3)) for i in range(90)],
                               "booking_id BIGINT, a DOUBLE, b DOUBLE, label DOUBLE").coalesce(1)
    sizes = {**models.training.OUTCOME_SIZES, "boost_rounds": 2, "boost_depth": 2}
    model = models.training.fit(models.training.outcome_classifier(sizes),
                                models.training.with_class_weights(df, "label"), ["a", "b"])
    folder = store.scratch_path(spark, "artifacts")
    artifacts.save_set(spark, folder, "m", artifacts.ArtifactSet(model, ["a", "b"], Fitted("UC1"), {}))
    found = artifacts.load_set(spark, folder, "m")
    wanted = rows_of(models.scoring.predict(df, model, "UC1"))
    assert len(wanted) == 90 and rows_of(models.scoring.predict(df, found.model, "UC1")) == wanted


def test_stored_sets_predict_without_training(tables, monkeypatch):
    before = models.ENTRIES["s13_model_store"](tables)
    direct = models.scoring.predict(models._prepared(tables, "UC3"), models.cancel_models(tables).model, "UC3",
                                    models.stored_set(tables, "UC3").thresholds)
    assert before.exceptAll(direct).count() == 0 and before.count() == tables.bookings.count()

    def refuse(*_):
        raise AssertionError("trained again")

    tables._kept.pop("artifacts UC3")
    for name in ("cancel_models", "_validated_threshold"):
        monkeypatch.setattr(models, name, refuse)
    after = models.ENTRIES["p8_predict_cancel"](tables)
    assert after.exceptAll(before).count() == 0


# The sink that counts each row once --------------------------------------------------------------------------------

def test_a_batch_that_died_after_its_write_counts_once(spark):
    arrived, path = store.scratch_path(spark, "arrived"), store.scratch_path(spark, "once")
    rows = spark.createDataFrame([(i, i / 2) for i in range(60)], "k INT, v DOUBLE")
    for part in range(3):
        rows.filter(F.col("k") % 3 == part).coalesce(1).write.mode("append").parquet(arrived)

    def stream():
        return rides.read_stream(spark, arrived, rows.schema, max_files=1)

    died = []

    def die(batch):
        if batch == 1 and not died:
            died.append(batch)
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        rides.run_once(stream(), path, die)
    half = spark.read.parquet(f"{path}/rows")
    assert half.count() == 40  # the second batch is there, but not marked as done
    assert rows_of(rides.run_once(stream(), path, die)) == rows_of(rows)
    assert rows_of(rides.run_once(stream(), path, die)) == rows_of(rows)


def test_no_arrivals_and_a_clashing_column(spark):
    arrived = store.scratch_path(spark, "arrived")
    empty = spark.createDataFrame([], "k INT")
    empty.write.parquet(arrived)
    assert rides.run_once(rides.read_stream(spark, arrived, empty.schema), store.scratch_path(spark, "once")).count() == 0
    with pytest.raises(ValueError, match="own column"):
        rides.run_once(spark.readStream.schema(f"{rides.BATCH} INT").parquet(arrived), store.scratch_path(spark, "once"))
