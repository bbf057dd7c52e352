"""Catalog entries of splits, fitted transforms, selection, evaluation, scoring and training."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions.exprs import VEHICLE_TYPES, mapped, round_stable
from fareloom.operators import artifacts, encoding, engineering, evaluation, fitted, quality, scoring, selection, splitting, training, usecases
from fareloom.plans.dashboard import equal_width_histogram
from fareloom.plans.feature_queries import comparable, wide_of
from fareloom.sources import tables
from fareloom.sources.ride_views import StoredRideTables

Build = Callable[[StoredRideTables], DataFrame]


@dataclass(frozen=True)
class Sizes:
    """Sizes of the models of the catalog; data is never reduced. `rounds` is that of every boosted model."""

    classifiers: Mapping[str, float]
    regressors: Mapping[str, float]
    outcome: Mapping[str, float]
    space: Mapping[str, tuple]
    trials: Mapping[str, int]


def sizes_of(rounds: int, trials: int) -> Sizes:
    """Other boosting rounds, and as many settings tried for every task; the rest are the library's sizes."""
    boosting = {"boost_rounds": rounds}
    return Sizes({**training.CLASSIFIER_SIZES, **boosting}, {**training.REGRESSOR_SIZES, **boosting},
                 {**training.OUTCOME_SIZES, **boosting},
                 {**training.SEARCH_SPACE, "maxIter": (max(1, rounds // 4), rounds)},
                 {use_case: trials for use_case in training.SEARCH_TRIALS})


LIBRARY_SIZES = Sizes(training.CLASSIFIER_SIZES, training.REGRESSOR_SIZES, training.OUTCOME_SIZES, training.SEARCH_SPACE,
                      training.SEARCH_TRIALS)
# The catalog trains at the library's sizes; README gives the measured times.
SIZES = LIBRARY_SIZES


SPLITS_AT_ONCE = 3
FARE_TASKS = tuple(f"UC2_{v}" for v in VEHICLE_TYPES)


# Shared stages -----------------------------------------------------------------------------------------------------

def derived_rows(t: StoredRideTables) -> DataFrame:
    """All features with raw columns and unlogged values, and the status code as a class. Not stored: a query of few
    columns makes no others."""
    return encoding.add_ordinal_codes(engineering.derive_features(wide_of(t)))


def derived(t: StoredRideTables) -> DataFrame:
    return t.kept("derived", lambda: derived_rows(t))


def categories(t: StoredRideTables) -> dict[str, list[str]]:
    """The features leave the columns that these come from as they are in the wide table."""
    return t.kept("categories", lambda: encoding.fit_categories(wide_of(t)))


def engineered_rows(t: StoredRideTables) -> DataFrame:
    return engineering.engineer_wide(wide_of(t), categories(t))


def engineered(t: StoredRideTables) -> DataFrame:
    return t.kept("engineered", lambda: engineered_rows(t))


def parted(t: StoredRideTables) -> DataFrame:
    return t.kept("parted", lambda: splitting.train_test(derived(t), "booking_id", "booking_status_enc"))


def train_part(t: StoredRideTables) -> DataFrame:
    return parted(t).filter(F.col("split") == "train")


def one_split(t: StoredRideTables, use_case: str) -> usecases.Split:
    def build() -> usecases.Split:
        split = usecases.get_split(engineered(t), use_case)
        split.train, split.test = tables.settled(split.train, "train"), tables.settled(split.test, "test")
        return split
    return t.kept(f"split {use_case}", build)


def make_splits(t: StoredRideTables, use_cases: Sequence[str]) -> None:
    """Makes the splits that are still missing at one time, for a query that works on all of them."""
    training.at_once(t.spark, {use_case: partial(one_split, t, use_case) for use_case in use_cases}, SPLITS_AT_ONCE)


def rows_from(t: StoredRideTables, rows: list[tuple], schema: str) -> DataFrame:
    return t.spark.createDataFrame(rows, schema)


# Splits ------------------------------------------------------------------------------------------------------------

def _projection_report(t: StoredRideTables) -> DataFrame:
    frame = engineered_rows(t)
    rows = []
    for use_case in ("UC1", "UC2_Cab", "UC2_Auto", "UC2_Bike", "UC3", "UC4"):
        left = usecases.project(frame, use_case)
        rows.append((use_case, len(usecases.leakage_columns(frame, use_case)),
                     len(usecases.unwanted_columns(frame, use_case)), len(left.columns), left.count()))
    return rows_from(t, rows, "use_case STRING, leaking INT, unwanted INT, columns_left INT, rows BIGINT")


def _soundness(t: StoredRideTables) -> DataFrame:
    """Per task, of the rows before and after those without a target go: whether a giveaway column is left, and counts."""
    frame, rows = engineered(t), []
    for use_case in ("UC1", "UC2_Cab", "UC2_Auto", "UC2_Bike", "UC3", "UC4"):
        target = usecases.TARGETS[usecases.base_of(use_case)]
        given = usecases.project(frame, use_case)
        leaking = set(usecases.leakage_columns(frame, use_case)) & set(given.columns)
        features = [c for c in given.columns if c not in (usecases.KEY, target)]
        before, without = given.agg(F.count(F.lit(1)), F.count_if(F.col(target).isNull())).first()
        kept = splitting.drop_missing_target(given, target)
        quality.require_sound_split(kept, features, target)
        rows.append((use_case, target in features or bool(leaking), before, without, kept.count()))
    return rows_from(t, rows, "use_case STRING, target_leaks BOOLEAN, rows BIGINT, null_targets BIGINT, rows_kept BIGINT")


def _class_balance(t: StoredRideTables) -> DataFrame:
    """Share of each class among the training rows, for every classification task."""
    return reduce(DataFrame.unionByName, [
        quality.class_balance(train_part(t), usecases.TARGETS[use_case]).select(
            F.lit(use_case).alias("use_case"), F.col(usecases.TARGETS[use_case]).cast("int").alias("class"), "count", "share")
        for use_case in usecases.CLASSIFICATION])


def _vehicle_rows(t: StoredRideTables) -> DataFrame:
    counts = [
        rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name.split("_")[1]).alias("vehicle_type"), "rows")
        for name, rows in usecases.vehicle_subsets(engineered_rows(t)).items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _split_report(t: StoredRideTables, use_case: str) -> DataFrame:
    split = one_split(t, use_case)
    usecases_ok = split.target not in split.features
    return (
        split.train.withColumn("part", F.lit("train")).unionByName(split.test.withColumn("part", F.lit("test")))
        .groupBy("part")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(split.target).isNull()).alias("null_targets"))
        .withColumns({"use_case": F.lit(use_case), "features": F.lit(len(split.features)),
                      "target_left_out": F.lit(usecases_ok)})
    )


def _tuning(t: StoredRideTables) -> DataFrame:
    train = train_part(t).select("booking_id", "booking_status_enc")
    return splitting.tuning_subset(train, "booking_id", "booking_status_enc")


# Fitted transforms -------------------------------------------------------------------------------------------------

def _fitted(fit: Callable[[DataFrame], object], apply: Callable[[DataFrame, object], DataFrame], *shown: str) -> Build:
    def build(t: StoredRideTables) -> DataFrame:
        return comparable(apply(parted(t), fit(train_part(t))).select("booking_id", "split", *shown))
    return build


def _shares(t: StoredRideTables) -> DataFrame:
    train, everything = fitted.add_city_pair(train_part(t)), fitted.add_city_pair(parted(t))
    for column in fitted.SHARE_COLUMNS:
        everything = fitted.apply_shares(everything, column, fitted.fit_shares(train, column))
    return comparable(everything.select("booking_id", *[f"{c}_freq" for c in fitted.SHARE_COLUMNS]))


def _scaled(t: StoredRideTables) -> DataFrame:
    scale = fitted.fit_scaler(train_part(t))
    return comparable(fitted.apply_scaler(parted(t), scale).select("booking_id", *scale), 5)


def _imputed(t: StoredRideTables) -> DataFrame:
    """Every measured column, its gaps filled by the training median."""
    measured = [c for c, kind in parted(t).dtypes if kind == "double"]
    medians = fitted.fit_medians(train_part(t), measured)
    return comparable(fitted.apply_medians(parted(t).select("booking_id", *measured), medians))


def _post_split(t: StoredRideTables) -> DataFrame:
    rows = splitting.train_test(usecases.project(engineered(t), "UC3"), "booking_id", "is_cancelled")
    learned = fitted.fit_post_split(rows.filter(F.col("split") == "train"), "UC3")
    path = tables.scratch_path(t.spark, "fitted")
    learned.save(t.spark, path)
    return comparable(fitted.apply_post_split(rows, fitted.Fitted.load(t.spark, path)))


# Selection ---------------------------------------------------------------------------------------------------------

IDENTIFIERS = ("booking_id", "customer_id", "driver_id")


def _of_each_class_target(t: StoredRideTables, report: Callable[[DataFrame, list[str], str], DataFrame]) -> DataFrame:
    """A correlation report of all numeric columns but ids and the target itself, for every classification task."""
    rows = train_part(t).withColumn("constant_column", F.lit(1.0))
    parts = []
    for use_case in usecases.CLASSIFICATION:
        target = usecases.TARGETS[use_case]
        features = [c for c in quality.numeric_columns(rows) if c not in (*IDENTIFIERS, target)]
        parts.append(report(rows, features, target).withColumn("use_case", F.lit(use_case)))
    return comparable(reduce(DataFrame.unionByName, parts))


def _correlation_report(t: StoredRideTables) -> DataFrame:
    split = one_split(t, "UC3")
    found = split.report["correlation"]
    rows = [(f, "low_target_correlation", None) for f in found["low_target_correlation"]]
    rows += [(f, "redundant", None) for f in found["redundant"]]
    rows += [(f, "kept", s) for f, s in found["ranking"]]
    return rows_from(t, rows, "feature STRING, decision STRING, strength DOUBLE")


def _importance_report(t: StoredRideTables) -> DataFrame:
    found = one_split(t, "UC3").report["importance"]
    kept = set(found["kept"])
    return rows_from(t, [(f, w, f in kept) for f, w in found["importance"]], "feature STRING, importance DOUBLE, kept BOOLEAN")


# Evaluation over the rule-scored table -----------------------------------------------------------------------------

def rule_scored(t: StoredRideTables) -> DataFrame:
    """A score that leans towards the outcome, so that the curve has a shape."""
    leaning = round_stable(F.col("cancel_probability") * 0.7 + F.col("actual_cancelled_flag") * 0.3, 4)
    return t.predictions.select(
        "booking_id", F.col("actual_cancelled_flag").alias("label"), leaning.alias("score"),
        F.when(leaning >= F.col("uc3_threshold_used"), 1).otherwise(0).alias("prediction"),
    )


def rule_classes(t: StoredRideTables) -> DataFrame:
    guess = mapped(F.col("cancel_risk_tier"), {"High": 1, "Medium": 2, "Low": 0})
    status = t.bookings.select("booking_id", mapped(F.col("booking_status"), encoding.STATUS_CODES).alias("label"))
    return t.predictions.select("booking_id", guess.alias("prediction")).join(status, "booking_id")


def rule_fares(t: StoredRideTables) -> DataFrame:
    return t.predictions.filter(F.col("actual_completed_flag") == 1).select(
        "booking_id", F.log1p("actual_fare").alias("label"), F.log1p("predicted_fare").alias("prediction"))


def _auc(t: StoredRideTables) -> DataFrame:
    return comparable(evaluation.roc_auc(rule_scored(t)), 8)


def _comparison(t: StoredRideTables) -> DataFrame:
    tuned = evaluation.best_f1_threshold(rule_scored(t)).first()["threshold"]
    return evaluation.threshold_comparison(rule_scored(t), tuned)


def _residual_histogram(t: StoredRideTables) -> DataFrame:
    gaps = t.predictions.filter(F.col("actual_completed_flag") == 1).select(
        (F.col("actual_fare") - F.col("predicted_fare")).alias("residual"))
    return equal_width_histogram(gaps, "residual", 60)


def _per_class(t: StoredRideTables) -> DataFrame:
    return comparable(evaluation.class_report(rule_classes(t)).drop("hit"))


# Scoring -----------------------------------------------------------------------------------------------------------

def _clamped(t: StoredRideTables) -> DataFrame:
    p = F.col("cancel_probability")
    return t.predictions.select("booking_id", scoring.clamp_threshold(p).alias("threshold"))


def _risk(t: StoredRideTables) -> DataFrame:
    return scoring.add_risk(t.predictions.select("booking_id", "cancel_probability"))


def rule_predictions(t: StoredRideTables) -> DataFrame:
    fares = t.predictions.select("booking_id", "predicted_fare")
    cancels = t.predictions.select("booking_id", "cancel_probability")
    scored = scoring.score_bookings(t.bookings, fares, cancels)
    return scoring.build_predictions(scored, 0.6, t.location_demand)


def _rule_table(t: StoredRideTables) -> DataFrame:
    return rule_predictions(t).drop("predicted_at")


# Training ----------------------------------------------------------------------------------------------------------

def _classifiers(classes: int) -> dict:
    return training.classifiers(classes, SIZES.classifiers)


def cancel_models(t: StoredRideTables) -> training.Trained:
    s = one_split(t, "UC3")
    return t.kept("models UC3", lambda: training.train_binary(s.train, s.test, s.features, s.target, _classifiers(2)))


def delay_models(t: StoredRideTables) -> training.Trained:
    s = one_split(t, "UC4")
    return t.kept("models UC4", lambda: training.train_binary(s.train, s.test, s.features, s.target, _classifiers(2)))


def outcome_models(t: StoredRideTables) -> training.Trained:
    s = one_split(t, "UC1")
    return t.kept("models UC1", lambda: training.train_outcome(
        s.train, s.test, s.features, s.target, candidates=_classifiers(3),
        final=training.outcome_classifier(SIZES.outcome)))


def fare_models(t: StoredRideTables, use_case: str) -> training.Trained:
    s = one_split(t, use_case)
    return t.kept(f"models {use_case}", lambda: training.train_fare(
        s.train, s.test, s.features, s.target, training.regressors(SIZES.regressors)))


def _metric_rows(t: StoredRideTables, *trained: tuple[str, training.Trained]) -> DataFrame:
    rows = [(use_case, name, metric, float(value), name == found.best)
            for use_case, found in trained for name, values in found.metrics.items() for metric, value in values.items()]
    return rows_from(t, rows, "use_case STRING, model STRING, metric STRING, value DOUBLE, chosen BOOLEAN")


def _fare_metrics(t: StoredRideTables) -> DataFrame:
    make_splits(t, FARE_TASKS)
    return _metric_rows(t, *[(f"UC2_{v}", fare_models(t, f"UC2_{v}")) for v in VEHICLE_TYPES])


def _weights(t: StoredRideTables) -> DataFrame:
    return comparable(training.balanced_weights(derived(t), "booking_status_enc"))


def _oversampled(t: StoredRideTables) -> DataFrame:
    """Cancelled rides brought up to the number of the others."""
    s = one_split(t, "UC3")
    made = training.equalise(s.train, "booking_id", s.features, s.target)
    return made.groupBy(s.target).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("booking_id") < 0).alias("made"))


def _equalised(t: StoredRideTables) -> DataFrame:
    s = one_split(t, "UC1")
    return _metric_rows(t, ("UC1", training.train_equalised(
        s.train, s.test, s.features, s.target, 3, _classifiers(3)["Random Forest"])))


def artifact_folder(t: StoredRideTables) -> str:
    """Artifacts outlive the application where the cluster's shared folder does."""
    return f"{tables.scratch_root(t.spark)}/artifacts"


def fingerprint(t: StoredRideTables, use_case: str, purpose: str, sizes: object) -> str:
    s = one_split(t, use_case)
    return artifacts.fingerprint(s.train, {"use_case": use_case, "purpose": purpose, "sizes": sizes, "features": s.features})


def tuned_settings(t: StoredRideTables, use_case: str) -> tuple[dict, list[dict]]:
    """The best settings and all tried ones; no search where a run over the same rows and space has stored them."""
    def search() -> tuple[dict, list[dict]]:
        s = one_split(t, use_case)
        subset = splitting.tuning_subset(s.train, "booking_id", s.target)
        rest = splitting.mark_share(s.train, "booking_id", 0.4, s.target).filter(~F.col("chosen")).drop("chosen")
        return training.search(subset, rest, s.features, s.target, 3 if use_case == "UC1" else 2,
                               trials=SIZES.trials[use_case], space=SIZES.space)

    def build() -> tuple[dict, list[dict]]:
        mark = fingerprint(t, use_case, "search", [SIZES.trials[use_case], SIZES.space])
        return tuple(artifacts.once(t.spark, artifact_folder(t), mark, search))
    return t.kept(f"search {use_case}", build)


def _search(t: StoredRideTables) -> DataFrame:
    make_splits(t, usecases.CLASSIFICATION)
    rows = []
    for use_case in usecases.CLASSIFICATION:
        best, tried = tuned_settings(t, use_case)
        rows += [(use_case, i, float(x["score"]), int(x["maxIter"]), int(x["maxDepth"]), x["stopped"],
                  all(x[k] == v for k, v in best.items())) for i, x in enumerate(tried)]
    return rows_from(t, rows, "use_case STRING, trial INT, score DOUBLE, max_iter INT, max_depth INT, stopped BOOLEAN, best BOOLEAN")


def tuned_models(t: StoredRideTables, use_case: str) -> training.Trained:
    """The two best settings of the search, refitted on the whole training part."""
    def build() -> training.Trained:
        s = one_split(t, use_case)
        best, tried = tuned_settings(t, use_case)
        others = [x for x in tried if any(x[k] != v for k, v in best.items())]
        settings = {"tuned": best}
        if others:
            second = max(others, key=lambda x: (not x["stopped"], x["score"]))
            settings["runner-up"] = {k: second[k] for k in best}
        return training.retrain(s.train, s.test, s.features, s.target, 3 if use_case == "UC1" else 2, settings)
    return t.kept(f"tuned {use_case}", build)


def _retrained(t: StoredRideTables) -> DataFrame:
    make_splits(t, usecases.CLASSIFICATION)
    return _metric_rows(t, *[(use_case, tuned_models(t, use_case)) for use_case in usecases.CLASSIFICATION])


def _finals(t: StoredRideTables) -> DataFrame:
    make_splits(t, (*usecases.CLASSIFICATION, *FARE_TASKS))
    rows = []
    for use_case, base, metric in (("UC1", outcome_models(t), "f1"), ("UC3", cancel_models(t), "auc"), ("UC4", delay_models(t), "auc")):
        tuned = tuned_models(t, use_case)
        rows.append((use_case, {"auc": "roc_auc"}.get(metric, metric), base.metrics[base.best][metric], tuned.metrics[tuned.best][metric]))
    rows += [(f"UC2_{v}", "r2", (m := fare_models(t, f"UC2_{v}")).metrics[m.best]["r2"], None) for v in VEHICLE_TYPES]
    report = training.selection_report(rows)
    path = tables.scratch_path(t.spark, "report")
    tables.save_json(t.spark, report, path)
    stored = tables.load_json(t.spark, path)
    return rows_from(t, [(r["use_case"], r["metric"], r["baseline"], r["tuned"], r["winner"]) for r in stored],
                     "use_case STRING, metric STRING, baseline DOUBLE, tuned DOUBLE, winner STRING")


def _importance(t: StoredRideTables) -> DataFrame:
    s, found = one_split(t, "UC3"), cancel_models(t)
    top = training.feature_importance(found.models["Random Forest"], s.features)
    return rows_from(t, [(i + 1, f, w) for i, (f, w) in enumerate(top)], "place INT, feature STRING, importance DOUBLE")


VALIDATION_SHARE = 0.2


def _validated_threshold(t: StoredRideTables, use_case: str) -> float:
    """The threshold of the best learner, found on a part of the training rows that this fit has not seen."""
    s, found = one_split(t, use_case), cancel_models(t) if use_case == "UC3" else delay_models(t)
    marked = splitting.mark_share(s.train, usecases.KEY, VALIDATION_SHARE, s.target, seed=7, name="_held").withColumn(
        "label", F.col(s.target).cast("double"))
    seen = training.with_class_weights(marked.filter(~F.col("_held")).drop("_held"), "label")
    model = training.fit(_classifiers(2)[found.best], seen, s.features)
    held = tables.settled(training.scored(model, marked.filter("_held")).select("label", "score"), "validation")
    pick = evaluation.precision_threshold if use_case == "UC3" else evaluation.best_f1_threshold
    return float(pick(held).first()["threshold"])


def stored_set(t: StoredRideTables, use_case: str) -> artifacts.ArtifactSet:
    """The chosen model of a classification task with all that its predictions need, as it was stored.

    It is trained only if there is no complete set of the same training rows and sizes. The cancellation threshold keeps
    to its safe range.
    """
    def train() -> artifacts.ArtifactSet:
        s, bounds = one_split(t, use_case), {}
        found = {"UC1": outcome_models, "UC3": cancel_models, "UC4": delay_models}[use_case](t)
        if use_case == "UC3":
            bounds = {"uc3_threshold": scoring.clamped(_validated_threshold(t, "UC3"))}
        elif use_case == "UC4":
            bounds = {"uc4_threshold": _validated_threshold(t, "UC4")}
        return artifacts.ArtifactSet(found.model, s.features, s.fitted, categories(t), bounds,
                                     {"chosen": found.best, "sizes": asdict(SIZES)}, found.metrics)

    def build() -> artifacts.ArtifactSet:
        folder, mark = artifact_folder(t), fingerprint(t, use_case, "training", asdict(SIZES))
        found = artifacts.load_set(t.spark, folder, mark)
        if found is None:
            artifacts.save_set(t.spark, folder, mark, train())
            found = artifacts.load_set(t.spark, folder, mark)
        return found
    return t.kept(f"artifacts {use_case}", build)


def thresholds(t: StoredRideTables) -> dict[str, float]:
    return {**stored_set(t, "UC3").thresholds, **stored_set(t, "UC4").thresholds}


def _prepared(t: StoredRideTables, use_case: str) -> DataFrame:
    s = one_split(t, use_case)
    return scoring.prepare(wide_of(t), categories(t), s.fitted, s.features)


def model_predictions(t: StoredRideTables) -> DataFrame:
    """All bookings scored by the trained fare and cancellation models."""
    def build() -> DataFrame:
        make_splits(t, (*FARE_TASKS, "UC3"))
        parts = {}
        for v in VEHICLE_TYPES:
            rows = _prepared(t, f"UC2_{v}").filter(F.col(engineering.VEHICLE) == v)
            parts[v] = (fare_models(t, f"UC2_{v}").model, rows)
        fares = scoring.fare_predictions(parts)
        found = stored_set(t, "UC3")
        bound = found.thresholds["uc3_threshold"]
        cancels = scoring.cancel_predictions(found.model, _prepared(t, "UC3"))
        scored = scoring.score_bookings(t.bookings, tables.settled(fares, "fares"), cancels)
        return scoring.build_predictions(scored, bound, t.location_demand)
    return t.kept("model predictions", build)


def _predicted_fares(t: StoredRideTables) -> DataFrame:
    """Fares of every vehicle type, each by its own model."""
    make_splits(t, FARE_TASKS)
    return reduce(DataFrame.unionByName, [
        scoring.predict(_prepared(t, f"UC2_{v}").filter(F.col(engineering.VEHICLE) == v), fare_models(t, f"UC2_{v}").model, f"UC2_{v}")
        .withColumn("vehicle_type", F.lit(v)) for v in VEHICLE_TYPES])


def _predicted(t: StoredRideTables, use_case: str) -> DataFrame:
    """Predictions of all bookings from nothing but the stored set and the joined tables."""
    found = stored_set(t, use_case)
    rows = scoring.prepare(wide_of(t), found.categories, found.fitted, found.features)
    return scoring.predict(rows, found.model, use_case, found.thresholds)


def _stored_report(t: StoredRideTables) -> DataFrame:
    """What the stored sets say of their training."""
    make_splits(t, usecases.CLASSIFICATION)
    rows = [(use_case, model, metric, float(value), model == found.settings["chosen"], len(found.features))
            for use_case in usecases.CLASSIFICATION for found in [stored_set(t, use_case)]
            for model, values in found.report.items() for metric, value in values.items()]
    return rows_from(t, rows, "use_case STRING, model STRING, metric STRING, value DOUBLE, chosen BOOLEAN, features INT")


def _split_roundtrip(t: StoredRideTables) -> DataFrame:
    folder = tables.scratch_path(t.spark, "splits")
    tables.save_split(parted(t).select("booking_id", "booking_status_enc", "split"), folder, "uc1")
    train, test = tables.load_split(t.spark, folder, "uc1")
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


def _stored_settings(t: StoredRideTables) -> DataFrame:
    make_splits(t, usecases.CLASSIFICATION)
    rows = [(use_case, k, float(v)) for use_case in usecases.CLASSIFICATION
            for k, v in sorted(tuned_settings(t, use_case)[0].items())]
    return rows_from(t, rows, "use_case STRING, setting STRING, value DOUBLE")


ENTRIES: dict[str, Build] = {
    "u1_u2_projection": _projection_report,
    "d20_split_checks": _soundness,
    "d21_train_class_balance": _class_balance,
    "u3_vehicle_rows": _vehicle_rows,
    "u4_u5_train_test": lambda t: parted(t).select("booking_id", "booking_status_enc", "split"),
    "u5_plain_split": lambda t: splitting.train_test(t.bookings.select("booking_id"), "booking_id"),
    "u6_tuning_subset": _tuning,
    "u7_split_uc1": lambda t: _split_report(t, "UC1"),
    "u7_split_uc2_cab": lambda t: _split_report(t, "UC2_Cab"),
    "u7_split_uc2_auto": lambda t: _split_report(t, "UC2_Auto"),
    "u7_split_uc2_bike": lambda t: _split_report(t, "UC2_Bike"),
    "u7_split_uc3": lambda t: _split_report(t, "UC3"),
    "u7_split_uc4": lambda t: _split_report(t, "UC4"),
    "z1_cap_experience": lambda t: fitted.cap_experience(derived_rows(t)).select("booking_id", "driver_experience_years"),
    "z2_distance_flags": _fitted(fitted.fit_distance, fitted.apply_distance, "is_short_ride", "is_long_ride", "distance_bin_enc"),
    "z3_high_cancel": _fitted(fitted.fit_high_cancel, fitted.apply_high_cancel, "is_high_cancel_customer", "new_high_cancel"),
    "z4_location_shares": _shares,
    "z5_hotspots": _fitted(fitted.fit_hotspots, fitted.apply_hotspots, "pickup_hotspot_flag"),
    "z6_full_loyalty": _fitted(fitted.fit_tenure, fitted.apply_full_loyalty, "Customer_Loyalty_Score", "loyalty_x_cancel"),
    "z7_lean_loyalty": _fitted(fitted.fit_tenure, fitted.apply_lean_loyalty, "Customer_Loyalty_Score"),
    "z8_scaled": _scaled,
    "z9_imputed": _imputed,
    "z10_post_split": _post_split,
    "x1_target_correlations": lambda t: _of_each_class_target(t, selection.target_correlations),
    "x2_correlation_filter": _correlation_report,
    "x3_importance_filter": _importance_report,
    "x4_correlation_ranking": lambda t: _of_each_class_target(t, selection.correlation_ranking),
    "v1_binary_metrics": lambda t: evaluation.classification_metrics(rule_scored(t), positive=1),
    "v1_weighted_metrics": lambda t: evaluation.classification_metrics(rule_classes(t)),
    "v1_class_report": _per_class,
    "v2_roc_auc": _auc,
    "v3_confusion_matrix": lambda t: evaluation.confusion_matrix(rule_classes(t), [0, 1, 2]),
    "v4_regression_metrics": lambda t: evaluation.regression_metrics(rule_fares(t), digits=3),
    "v5_best_f1_threshold": lambda t: comparable(evaluation.best_f1_threshold(rule_scored(t))),
    "v6_precision_threshold": lambda t: evaluation.precision_threshold(rule_scored(t)),
    "v6_precision_fallback": lambda t: evaluation.precision_threshold(rule_scored(t), 0.99999),
    "v7_threshold_comparison": _comparison,
    "v8_feature_importance": _importance,
    "v9_residuals": lambda t: comparable(evaluation.residuals(rule_fares(t)).select("booking_id", "actual", "predicted", "residual"), 4),
    "v9_residual_histogram": _residual_histogram,
    "p1_clamped_threshold": _clamped,
    "p2_model_predictions": model_predictions,
    "p3_p4_risk": _risk,
    "p5_p6_predictions_table": _rule_table,
    "p7_prepared_rows": lambda t: _prepared(t, "UC3"),
    "p8_predict_outcome": lambda t: _predicted(t, "UC1"),
    "p8_predict_fare": _predicted_fares,
    "p8_predict_cancel": lambda t: _predicted(t, "UC3"),
    "p8_predict_delay": lambda t: _predicted(t, "UC4"),
    "m3_balanced_weights": _weights,
    "m4_oversampled": _oversampled,
    "m4_train_equalised": _equalised,
    "m1_m5_train_outcome": lambda t: _metric_rows(t, ("UC1", outcome_models(t))),
    "m2_m6_train_fare": _fare_metrics,
    "m7_train_cancel": lambda t: _metric_rows(t, ("UC3", cancel_models(t))),
    "m7_train_delay": lambda t: _metric_rows(t, ("UC4", delay_models(t))),
    "m8_search": _search,
    "m9_retrain": _retrained,
    "m10_finals": _finals,
    "s12_split_store": _split_roundtrip,
    "s13_model_store": lambda t: _predicted(t, "UC3"),
    "s13_stored_report": _stored_report,
    "s14_settings_store": _stored_settings,
}
