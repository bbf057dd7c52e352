"""Training, oversampling, scoring and streams on the smallest data."""

from __future__ import annotations

import random
import time
from types import SimpleNamespace

import pytest
from pyspark.ml.classification import OneVsRest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from fareloom.operators import scoring, training, usecases
from fareloom.plans import model_queries as models
from fareloom.plans import stream_queries as streams
from fareloom.sources.tables import scratch_path
from fareloom.streaming import rides


def imbalanced(spark, copies=0):
    draw = random.Random(5)
    rows = [(i, draw.gauss(0, 1), draw.gauss(0, 1), 0.0 if i < 300 else 1.0 if i < 400 else 2.0) for i in range(430)]
    rows += [(1000 + i, 0.5, 0.5, 2.0) for i in range(copies)]
    return spark.createDataFrame(rows, "booking_id BIGINT, a DOUBLE, b DOUBLE, label DOUBLE"), rows


@pytest.mark.parametrize("copies", [0, 15])
def test_oversampled_rows_lie_between_two_of_their_class(spark, copies):
    df, rows = imbalanced(spark, copies)
    made = training.oversample(df, "booking_id", ["a", "b"], "label", 2, 120)
    counts = {r["label"]: r["count"] for r in made.groupBy("label").count().collect()}
    assert counts == {0.0: 300, 1.0: 100, 2.0: 120}
    parents = [(a, b) for _, a, b, y in rows if y == 2.0]
    new = [(r["a"], r["b"]) for r in made.filter("booking_id < 0").collect()]
    assert len(new) == 120 - len(parents) and made.select("booking_id").distinct().count() == made.count()

    def between(p):
        for x in parents:
            for y in parents:
                cross = (y[0] - x[0]) * (p[1] - x[1]) - (y[1] - x[1]) * (p[0] - x[0])
                inside = min(x[0], y[0]) - 1e-9 <= p[0] <= max(x[0], y[0]) + 1e-9
                if abs(cross) < 1e-9 and inside:
                    return True
        return False

    assert all(between(p) for p in new)
    again = training.oversample(df.repartition(7), "booking_id", ["a", "b"], "label", 2, 120)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, made.collect()))


def test_equalise_and_weights(spark):
    df, _ = imbalanced(spark)
    counts = {r["label"]: r["count"] for r in training.equalise(df, "booking_id", ["a", "b"], "label").groupBy("label").count().collect()}
    assert counts == {0.0: 300, 1.0: 300, 2.0: 300}
    assert training.oversample(df, "booking_id", ["a", "b"], "label", 2, 10) is df
    weights = {r["label"]: r["weight"] for r in training.balanced_weights(df, "label").collect()}
    assert weights[2.0] == pytest.approx(430 / (3 * 30))
    fixed = training.with_class_weights(df, "label", training.OUTCOME_WEIGHTS).groupBy("label").agg(F.max("weight")).collect()
    assert dict(map(tuple, fixed)) == {0.0: 1.0, 1.0: 3.0, 2.0: 6.0}


def test_forests_keep_reached_nodes_and_fit_the_same_trees(spark):
    df, _ = imbalanced(spark)
    rows = training.with_class_weights(df, "label").coalesce(2).cache()
    small = {"forest_trees": 3, "forest_depth": 15, "min_leaf": 1}
    for made, kinds in ((training.classifiers, training.CLASSIFIER_SIZES), (training.regressors, training.REGRESSOR_SIZES)):
        forest = made(sizes={**kinds, **small})["Random Forest"]
        assert forest.getCacheNodeIds()
        plain = forest.copy({forest.cacheNodeIds: False})
        trees = [training.fit(f, rows, ["a", "b"]).stages[-1].toDebugString.split("\n", 1)[1] for f in (forest, plain)]
        assert trees[0] == trees[1]
    rows.unpersist()


def test_search_draws_and_final_choice():
    first, second = training.random_settings(5), training.random_settings(5)
    assert first == second and len(first) == 5
    assert all(75 <= s["maxIter"] <= 300 and 0.05 <= s["stepSize"] <= 0.2 for s in first)
    assert training.choose_final(0.8, 0.8) == "baseline" and training.choose_final(0.8, 0.81) == "tuned"
    assert training.choose_final(0.8, None) == "baseline"


def test_the_catalog_trains_and_searches_at_the_full_sizes(spark, monkeypatch):
    """Of 300 boosting rounds 40 were left, of 50, 30 and 30 settings 6, and most of these ran for a quarter of their rounds."""
    sizes = models.LIBRARY_SIZES
    boosted = [training.classifiers(2, sizes.classifiers), training.regressors(sizes.regressors)]
    assert [m["Gradient Boosting"].getMaxIter() for m in boosted] == [300, 300]
    assert training.classifiers(3, sizes.classifiers)["Gradient Boosting"].getClassifier().getMaxIter() == 300
    assert training.outcome_classifier(sizes.outcome).getClassifier().getMaxIter() == 300
    assert sizes.trials == {"UC1": 50, "UC3": 30, "UC4": 30} and sizes.space["maxIter"] == (75, 300)

    t, fitted = FewRows(spark), []
    monkeypatch.setattr(models, "one_split", lambda t, use_case: t.kept(f"split {use_case}", lambda: t.split(use_case)))
    monkeypatch.setattr(models, "artifact_folder", lambda t: scratch_path(spark, "artifacts"))
    monkeypatch.setattr(models, "SIZES", sizes)

    def fit_and_score(estimators, features, score, parallelism):
        fitted.append([(e.getClassifier() if isinstance(e, OneVsRest) else e).getMaxIter() for e, _ in estimators.values()])
        return {}, {n: n / 100 for n in estimators}

    monkeypatch.setattr(training, "fit_and_score", fit_and_score)
    settings = models.ENTRIES["s14_settings_store"](t).collect()
    drawn = {use_case: [s["maxIter"] for s in training.random_settings(n)] for use_case, n in training.SEARCH_TRIALS.items()}
    assert fitted == [drawn[use_case] for use_case in usecases.CLASSIFICATION]
    assert {r["use_case"]: r["value"] for r in settings if r["setting"] == "maxIter"} == {u: d[-1] for u, d in drawn.items()}


def test_split_is_sound(tables):
    split = models.one_split(tables, "UC3")
    train, test = split.train, split.test
    assert split.target not in split.features and len(split.features) <= usecases.KEEP_FEATURES["UC3"]
    assert train.join(test, "booking_id").count() == 0
    assert train.count() + test.count() == tables.bookings.count()
    assert train.columns == test.columns == ["booking_id", split.target, *split.features]
    missing = train.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in train.columns]).first()
    assert sum(missing) == 0


def test_stream_and_batch_scores_agree(tables):
    found = models.cancel_models(tables)
    assert set(found.metrics) == {"Logistic Regression", "Random Forest", "Gradient Boosting"}
    streamed = streams.stream_model_scoring(tables)
    batch = tables.bookings.transform(streams.model_scorer(tables)).transform(scoring.add_risk)

    def rounded(df):
        return df.select("booking_id", F.round("cancel_probability", 9), "cancel_risk_tier", "recommended_action")

    assert rounded(streamed).exceptAll(rounded(batch)).count() == 0 and streamed.count() == tables.bookings.count()


def test_prepared_rows_of_train_equal_the_split(tables):
    """A booking prepared on its own has the very features it was trained with."""
    split = models.one_split(tables, "UC3")
    fresh = models._prepared(tables, "UC3").select("booking_id", *[F.round(f"`{c}`", 9).alias(c) for c in split.features])
    trained = split.train.select("booking_id", *[F.round(f"`{c}`", 9).alias(c) for c in split.features])
    assert trained.exceptAll(fresh).count() == 0


def test_missing_feature_becomes_zero(tables):
    split = models.one_split(tables, "UC3")
    rows = scoring.prepare(models.wide_of(tables), models.categories(tables), split.fitted, ["hour_sin", "not_there"])
    assert rows.select("not_there").distinct().collect()[0][0] == 0.0


def test_alert_windows_stream_equals_batch(tables):
    scored = tables.bookings.transform(lambda b: tables.predictions_from(b, keep=("booking_datetime",)))
    batch = rides.alert_windows(scored)
    last = scored.agg(F.max("booking_datetime") - F.expr("INTERVAL 10 MINUTES")).first()[0]
    closed = batch.filter(F.col("hour_start") + F.expr("INTERVAL 1 HOUR") <= F.lit(last))
    streamed = streams.stream_alerts(tables)
    assert streamed.exceptAll(closed).count() == 0 and closed.exceptAll(streamed).count() == 0


def test_predictions_of_every_kind(tables):
    frame = models.model_predictions(tables)
    assert frame.count() == tables.bookings.count()
    assert frame.filter("predicted_fare IS NULL OR cancel_probability IS NULL").count() == 0
    bound = frame.select("uc3_threshold_used").distinct().collect()
    assert len(bound) == 1 and 0.55 <= bound[0][0] <= 0.70
    outcome = scoring.predict(models._prepared(tables, "UC1"), models.outcome_models(tables).model, "UC1")
    assert {r[0] for r in outcome.select("label").distinct().collect()} <= set(scoring.OUTCOME_LABELS.values())
    shares = outcome.select(*[F.col(n) for n in scoring.OUTCOME_LABELS.values()])
    assert shares.filter(F.abs(F.col("Completed") + F.col("Cancelled") + F.col("Incomplete") - 1) > 2e-4).count() == 0


def test_thresholds_come_from_held_training_rows_and_are_stored(tables):
    bounds = models.thresholds(tables)
    assert 0.55 <= bounds["uc3_threshold"] <= 0.70 and 0 < bounds["uc4_threshold"] < 1
    cancels = models.ENTRIES["p8_predict_cancel"](tables)
    assert [r[0] for r in cancels.select("threshold").distinct().collect()] == [bounds["uc3_threshold"]]
    fares = models.ENTRIES["p8_predict_fare"](tables)
    assert fares.count() == tables.bookings.count() and fares.select("vehicle_type").distinct().count() == 3


def test_search_is_the_same_whatever_the_parallelism(spark):
    df, _ = imbalanced(spark)
    rows = df.filter("label < 2").cache()
    space = {"maxIter": (2, 4), "maxDepth": (1, 2), "stepSize": (0.05, 0.2, True), "subsamplingRate": (0.7, 1.0, False),
             "minInstancesPerNode": (1, 10)}
    found = [training.search(rows, rows, ["a", "b"], "label", 2, 6, space=space, first_share=0.5, parallelism=p) for p in (1, 4)]
    assert found[0] == found[1]
    best, tried = found[0]
    assert sum(not x["stopped"] for x in tried) == 3 and len(tried) == 6
    ahead = [x for x in tried if not x["stopped"]]
    assert max(x["score"] for x in ahead) == next(x["score"] for x in ahead if all(x[k] == v for k, v in best.items()))


class FewRows:
    """Stands in for the ride tables: a small made-up split per task, so that the whole chain of fits takes seconds."""

    def __init__(self, spark):
        self.spark, self.held = spark, {}

    def kept(self, name, build):
        if name not in self.held:
            self.held[name] = build()
        return self.held[name]

    def split(self, use_case):
        draw = random.Random(len(use_case))
        classes = 3 if use_case == "UC1" else 2
        rows = []
        for i in range(160):
            a, b = draw.gauss(0, 1), draw.gauss(0, 1)
            y = abs(a) + 1 if use_case.startswith("UC2") else float(min(classes - 1, (a > 0) + (a + b > 0.8)))
            rows.append((i, a, b, y))
        df = self.spark.createDataFrame(rows, "booking_id BIGINT, a DOUBLE, b DOUBLE, y DOUBLE").coalesce(1)
        return SimpleNamespace(train=df.filter("booking_id < 120"), test=df.filter("booking_id >= 120"), features=["a", "b"], target="y")


def test_finals_of_every_task(spark, monkeypatch):
    t = FewRows(spark)
    monkeypatch.setattr(models, "one_split", lambda t, use_case: t.kept(f"split {use_case}", lambda: t.split(use_case)))
    sizes = {"logistic_iterations": 5, "forest_trees": 3, "forest_depth": 3, "boost_rounds": 2, "boost_depth": 2}
    monkeypatch.setattr(models, "SIZES", models.Sizes(
        {**training.CLASSIFIER_SIZES, **sizes}, {**training.REGRESSOR_SIZES, **sizes}, {**training.OUTCOME_SIZES, **sizes},
        {**training.SEARCH_SPACE, "maxIter": (2, 4), "maxDepth": (1, 2)}, dict.fromkeys(training.SEARCH_TRIALS, 3)))
    finals = {r["use_case"]: r for r in models.ENTRIES["m10_finals"](t).collect()}
    assert set(finals) == {"UC1", "UC3", "UC4", "UC2_Cab", "UC2_Auto", "UC2_Bike"}
    for use_case, r in finals.items():
        assert (r["tuned"] is None) == use_case.startswith("UC2")
        assert r["winner"] in ("baseline", "tuned") and (r["winner"] == "baseline" or r["tuned"] >= r["baseline"])
    tried = models.ENTRIES["m8_search"](t).collect()
    assert {r["use_case"] for r in tried if r["best"]} == {"UC1", "UC3", "UC4"}
    retrained = models.ENTRIES["m9_retrain"](t).collect()
    assert {(r["use_case"], r["model"]) for r in retrained} == {(u, m) for u in ("UC1", "UC3", "UC4") for m in ("tuned", "runner-up")}


def test_queries_of_few_columns_store_no_wide_rows(spark, sf_dir):
    from fareloom.operators import encoding
    from fareloom.sources.ride_views import StoredRideTables

    t = StoredRideTables(spark, sf_dir)
    for name in ("z1_cap_experience", "u1_u2_projection", "u3_vehicle_rows"):
        assert models.ENTRIES[name](t).count() > 0
    assert "derived" not in t._kept and "engineered" not in t._kept
    assert models.categories(t) == encoding.fit_categories(models.derived(t))


def test_balanced_weights_do_not_gather_classes(spark):
    """Two classes: joined by shuffling, all rows would be in two tasks."""
    rows = spark.range(0, 4_000, 1, 8).selectExpr("id", "CAST(id % 2 AS DOUBLE) AS label")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        weighted = training.with_class_weights(rows, "label")
        held = weighted.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sorted(r["count"] for r in held) == [500] * 8


def test_method_limit_is_set_once(spark):
    from fareloom import session

    old = spark.conf.get(session.METHOD_LIMIT, "65535")
    try:
        for given, wanted in (("65535", "8000"), ("4000", "4000")):
            spark.conf.set(session.METHOD_LIMIT, given)
            session.compile_in_short_methods(spark)
            assert spark.conf.get(session.METHOD_LIMIT) == wanted
    finally:
        spark.conf.set(session.METHOD_LIMIT, old)


def test_near_rows_travel_as_lists(spark):
    """A row per candidate pair was shuffled for each direction; only the copies of a base row are still multiplied."""
    df, rows = imbalanced(spark, 15)
    minority = df.filter("label = 2").select("booking_id", "a", "b")
    near = training._near_rows(minority, "booking_id", ["a", "b"], 5, 4, 42)
    assert "Generate" not in near._jdf.queryExecution().optimizedPlan().toString()
    points = {r[0]: r[1:3] for r in rows if r[3] == 2.0}
    found = {r["booking_id"]: r["others"] for r in near.collect()}
    assert found.keys() == points.keys()
    for key, others in found.items():
        gaps = [(sum((p - q) ** 2 for p, q in zip(points[key], points[o])), o) for o in others]
        assert len(set(others)) == 5 and key not in others and gaps == sorted(gaps)
    made = training.oversample(df, "booking_id", ["a", "b"], "label", 2, 120)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1


def test_a_model_scores_its_test_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return float(x)

    class Model:
        def transform(self, df):
            half = F.array(F.lit(0.5), counted("x"))
            return df.select("label", F.col("x").alias("prediction"), array_to_vector(half).alias("probability"))

    rows = spark.range(0, 200, 1, 4).selectExpr("CAST(id % 2 AS DOUBLE) AS label", "CAST(id % 3 > 0 AS DOUBLE) AS x")
    found = training.classification_scores(Model(), rows, 2)
    assert seen.value == 200 and found["rows"] == 200 and 0 < found["auc"] < 1


def test_stored_frames_are_built_once_by_several_threads(spark, sf_dir):
    from fareloom.sources.ride_views import StoredRideTables

    t, built = StoredRideTables(spark, sf_dir), []

    def build():
        time.sleep(0.2)
        built.append(1)
        return len(built)

    found = training.at_once(spark, {str(i): lambda: t.kept("slow", build) for i in range(4)})
    assert found == {str(i): 1 for i in range(4)} and built == [1]
