"""Model training with Spark ML: candidate sets, class weights, oversampling, search, and the choice of finals."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.util import inheritable_thread_target

from fareloom.operators import evaluation
from fareloom.operators.splitting import mark_share

T = TypeVar("T")

SEED = 42

# Sizes of the candidate models.
CLASSIFIER_SIZES = {"logistic_iterations": 1000, "forest_trees": 300, "forest_depth": 15, "min_leaf": 5,
                    "boost_rounds": 300, "boost_depth": 6, "boost_step": 0.05, "boost_rows": 0.8}
REGRESSOR_SIZES = {"forest_trees": 200, "forest_depth": 15, "min_leaf": 5, "boost_rounds": 300, "boost_depth": 6,
                   "boost_step": 0.05, "boost_rows": 0.8}
# Misclassification weights and settings of the final outcome model.
OUTCOME_WEIGHTS = {0: 1.0, 1: 3.0, 2: 6.0}
OUTCOME_SIZES = {"boost_rounds": 300, "boost_depth": 6, "boost_step": 0.05, "boost_rows": 0.85, "min_leaf": 20}
# Search ranges, (low, high, logarithmic) for numbers with a fraction.
SEARCH_SPACE = {"maxIter": (75, 300), "maxDepth": (4, 7), "stepSize": (0.05, 0.2, True),
                "subsamplingRate": (0.7, 1.0, False), "minInstancesPerNode": (1, 50)}
# Settings tried per task.
SEARCH_TRIALS = {"UC1": 50, "UC3": 30, "UC4": 30}
# Of a search, all settings run for this share of their rounds, and this share of them (the best) for all rounds: with 1, none
# is stopped early.
FIRST_SHARE = 1.0
PARALLEL_FITS = 8
# How deep forests are fitted; their trees are the same. Each row keeps the node it has reached in every tree, else all trees
# go to all tasks at every level and every row walks down from the root again.
FOREST_WAY = {"cacheNodeIds": True}
OVERSAMPLE_SHARE = 0.5
NEIGHBOURS = 5
SLICE_ROWS = 5_000


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features")


# Class weights -----------------------------------------------------------------------------------------------------

def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """One row per class: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(F.lit(0))
    return counts.select(
        label, (F.sum("_n").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("_n"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str, weights: Mapping[int, float] | None = None) -> DataFrame:
    """Column `weight`: the given weight of a row's class, or the balanced one.

    The balanced weights, one row per class, are broadcast: a join by shuffling would put each class in one task.
    """
    if weights is None:
        return df.join(F.broadcast(balanced_weights(df, label)), label)
    steps: Column | None = None
    for value, weight in weights.items():
        hit = F.col(label) == value
        steps = F.when(hit, weight) if steps is None else steps.when(hit, weight)
    return df.withColumn("weight", steps.otherwise(1.0))


# Oversampling ------------------------------------------------------------------------------------------------------

def _near_rows(rows: DataFrame, key: str, features: Sequence[str], neighbours: int, projections: int,
               seed: int) -> DataFrame:
    """`key`, `others`: near rows of each row, nearest first, found along several random directions.

    Along one direction the rows are ordered within slices of equal size (cut at quantiles; equal values are spread
    by a hash), and each row looks at the next ones before and after it. The candidates grow with the rows, never
    with the square of a slice. The nearest by true distance are kept. A row's candidates of one direction travel as one
    list, so that the rows are shuffled once for each direction and once for all of them.
    """
    generator = random.Random(seed)
    total = rows.count()
    slices = max(1, -(-total // SLICE_ROWS))
    spread = F.xxhash64(F.col(key), F.lit(seed)).cast("double") / 2.0 ** 63 * 1e-9
    packed = rows.select(key, F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("x"))
    places = []
    for _ in range(projections):
        weights = [generator.gauss(0.0, 1.0) for _ in features]
        direction = sum((F.get("x", F.lit(i)) * w for i, w in enumerate(weights)), F.lit(0.0))
        places.append(direction + spread * F.greatest(F.abs(direction), F.lit(1.0)))
    steps = [i / slices for i in range(1, slices)] or [0.5]
    cuts = packed.agg(*[F.percentile_approx(along, steps, max(10_000, 10 * slices)) for along in places]).first()

    def gap(n: Column) -> Column:
        steps = (F.get("x", F.lit(i)) - F.get(n["y"], F.lit(i)) for i in range(len(features)))
        return sum((d * d for d in steps), F.lit(0.0))

    found: DataFrame | None = None
    for along, marks in zip(places, cuts):
        bounds = [float("-inf"), *(sorted(set(marks or [])) or [0.0]), float("inf")]
        sliced = Bucketizer(splits=bounds, inputCol="along", outputCol="slice").transform(
            packed.select(key, "x", along.alias("along")))
        order = Window.partitionBy("slice").orderBy("along", key)
        row = F.struct(F.col(key).alias("other"), F.col("x").alias("y"))
        looks = [f(row, k).over(order) for f in (F.lag, F.lead) for k in range(1, neighbours + 1)]
        seen = sliced.select(key, "x", *[look.alias(f"n{i}") for i, look in enumerate(looks)])
        near = F.filter(F.array(*[f"n{i}" for i in range(len(looks))]), lambda n: n.isNotNull())
        lists = seen.select(key, F.transform(near, lambda n: F.struct(gap(n).alias("gap"), n["other"].alias("other"))).alias("near"))
        found = lists if found is None else found.unionByName(lists)
    ordered = F.transform(F.sort_array(F.flatten(F.collect_list("near"))), lambda n: n["other"])
    return (
        found.groupBy(key).agg(F.slice(F.array_distinct(ordered), 1, neighbours).alias("others"))
        .filter(F.size("others") > 0)
    )


def oversample(df: DataFrame, key: str, features: Sequence[str], label: str, minority: int, target_rows: int,
               neighbours: int = NEIGHBOURS, projections: int = 4, seed: int = SEED) -> DataFrame:
    """Add rows of the minority class until it has `target_rows`, each between a row and one of its near rows.

    Every row is a base equally often (to within one); which near row and how far along is drawn from a hash, so a
    rerun of a lost task makes the same rows. The new rows have negative keys.
    """
    minority_rows = df.filter(F.col(label) == minority).select(key, *[F.col(f"`{c}`") for c in features])
    have = minority_rows.count()
    missing = target_rows - have
    if missing <= 0 or have < 2:
        return df
    whole, rest = divmod(missing, have)
    based = mark_share(minority_rows, key, rest / have, None, seed, "_one_more")
    copies = F.lit(whole) + F.col("_one_more").cast("int")
    near = _near_rows(minority_rows, key, features, neighbours, projections, seed)
    seeds = (
        based.filter(copies > 0).join(near, key)
        .withColumn("_turn", F.explode(F.sequence(F.lit(1), copies)))
        .withColumn("other", F.get("others", F.pmod(F.xxhash64(F.col(key), F.col("_turn"), F.lit(seed)), F.size("others")).cast("int")))
    )
    share = F.pmod(F.xxhash64(F.col(key), F.col("_turn"), F.lit(seed + 1)), F.lit(1_000_003)) / 1_000_003.0
    others = minority_rows.select(F.col(key).alias("other"), F.struct(*[F.col(f"`{c}`") for c in features]).alias("o"))
    made = (
        seeds.join(others, "other")
        .select(
            (-F.shiftrightunsigned(F.xxhash64(F.col(key), F.col("_turn")), 1) - 1).alias(key),
            *[(F.col(f"`{c}`") + (F.col("o").getField(c) - F.col(f"`{c}`")) * share).alias(c) for c in features],
            F.lit(minority).cast(dict(df.dtypes)[label]).alias(label),
        )
    )
    kinds = dict(df.dtypes)
    return df.select(key, *[F.col(f"`{c}`").cast("double").alias(c) for c in features], label).unionByName(
        made.select(F.col(key).cast(kinds[key]), *[F.col(f"`{c}`").cast("double").alias(c) for c in features], label))


def equalise(df: DataFrame, key: str, features: Sequence[str], label: str, seed: int = SEED) -> DataFrame:
    """Oversample every class up to the size of the largest."""
    sizes = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    largest = max(sizes.values())
    for value in sorted(sizes):
        if sizes[value] < largest:
            df = oversample(df, key, features, label, value, largest, seed=seed)
    return df


def train_equalised(train: DataFrame, test: DataFrame, features: Sequence[str], target: str, classes: int,
                    estimator: Estimator, key: str = "booking_id") -> Trained:
    """One estimator refitted on rows in which all classes are equally frequent."""
    name = "Equalised"
    rows = equalise(_labelled(train, target).select(key, "label", *features), key, features, "label")
    model = fit(estimator, with_class_weights(rows, "label"), features)
    return Trained({name: model}, {name: classification_scores(model, _labelled(test, target), classes)}, name)


# Candidates --------------------------------------------------------------------------------------------------------

def classifiers(classes: int = 2, sizes: Mapping[str, float] = CLASSIFIER_SIZES, seed: int = SEED) -> dict[str, Estimator]:
    boosted = GBTClassifier(maxIter=int(sizes["boost_rounds"]), maxDepth=int(sizes["boost_depth"]),
                            stepSize=sizes["boost_step"], subsamplingRate=sizes["boost_rows"], seed=seed,
                            weightCol="weight")
    return {
        "Logistic Regression": LogisticRegression(maxIter=int(sizes["logistic_iterations"]), weightCol="weight",
                                                  family="multinomial" if classes > 2 else "binomial"),
        "Random Forest": RandomForestClassifier(numTrees=int(sizes["forest_trees"]), maxDepth=int(sizes["forest_depth"]),
                                                minInstancesPerNode=int(sizes["min_leaf"]), seed=seed, weightCol="weight",
                                                **FOREST_WAY),
        "Gradient Boosting": OneVsRest(classifier=boosted, weightCol="weight", parallelism=classes) if classes > 2 else boosted,
    }


def regressors(sizes: Mapping[str, float] = REGRESSOR_SIZES, seed: int = SEED) -> dict[str, Estimator]:
    return {
        "Linear Regression": LinearRegression(),
        "Random Forest": RandomForestRegressor(numTrees=int(sizes["forest_trees"]), maxDepth=int(sizes["forest_depth"]),
                                               minInstancesPerNode=int(sizes["min_leaf"]), seed=seed, **FOREST_WAY),
        "Gradient Boosting": GBTRegressor(maxIter=int(sizes["boost_rounds"]), maxDepth=int(sizes["boost_depth"]),
                                          stepSize=sizes["boost_step"], subsamplingRate=sizes["boost_rows"], seed=seed),
    }


def outcome_classifier(sizes: Mapping[str, float] = OUTCOME_SIZES, seed: int = SEED) -> Estimator:
    """Boosted one-vs-rest model of the outcome task, trained with `OUTCOME_WEIGHTS`."""
    boosted = GBTClassifier(maxIter=int(sizes["boost_rounds"]), maxDepth=int(sizes["boost_depth"]),
                            stepSize=sizes["boost_step"], subsamplingRate=sizes["boost_rows"],
                            minInstancesPerNode=int(sizes["min_leaf"]), seed=seed, weightCol="weight")
    return OneVsRest(classifier=boosted, weightCol="weight", parallelism=len(OUTCOME_WEIGHTS))


def fit(estimator: Estimator, train: DataFrame, features: Sequence[str]) -> PipelineModel:
    return Pipeline(stages=[assembler(features), estimator]).fit(train)


def at_once(spark: SparkSession, tasks: Mapping[str, Callable[[], T]], parallelism: int = PARALLEL_FITS) -> dict[str, T]:
    """The results of tasks that run Spark jobs, by name; up to `parallelism` of them run at a time. A boosted model or a split
    is a long row of short jobs, which leave most cores idle."""
    def run(name: str) -> Callable[[], T]:
        return inheritable_thread_target(spark)(tasks[name])

    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        return dict(zip(tasks, pool.map(lambda task: task(), [run(name) for name in tasks], chunksize=1)))


def fit_and_score(estimators: Mapping[str, tuple[Estimator, DataFrame]], features: Sequence[str],
                  score: Callable[[PipelineModel], T], parallelism: int = PARALLEL_FITS) -> tuple[dict[str, PipelineModel], dict[str, T]]:
    """The models of several estimators, each over its own frame, and the score of each, taken while others are still fitted.
    Both are the same whatever the parallelism, as each estimator has its own seed."""
    def one(estimator: Estimator, train: DataFrame) -> tuple[PipelineModel, T]:
        model = fit(estimator, train, features)
        return model, score(model)

    spark = next(train.sparkSession for _, train in estimators.values())
    found = at_once(spark, {n: partial(one, *given) for n, given in estimators.items()}, parallelism)
    return {n: model for n, (model, _) in found.items()}, {n: value for n, (_, value) in found.items()}


def positive_probability() -> Column:
    return vector_to_array(F.col("probability"))[1]


def scored(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows with `prediction`, and `score` (probability of class 1) where the model gives one."""
    out = model.transform(df)
    if "probability" in out.columns:
        out = out.withColumn("score", positive_probability())
    return out


# Training per task -------------------------------------------------------------------------------------------------

@dataclass
class Trained:
    """Models of a task by name, their test metrics, and the name of the chosen one."""

    models: dict[str, PipelineModel]
    metrics: dict[str, dict[str, float]]
    best: str

    @property
    def model(self) -> PipelineModel:
        return self.models[self.best]


def _labelled(df: DataFrame, target: str) -> DataFrame:
    return df.withColumn("label", F.col(target).cast("double"))


def classification_scores(model: PipelineModel, test: DataFrame, classes: int) -> dict[str, float]:
    out = scored(model, test)
    pairs = out.withColumns({"label": F.col("label").cast("int"), "prediction": F.col("prediction").cast("int")})
    if classes > 2:
        return evaluation.classification_metrics(pairs, digits=6).first().asDict()
    # The model scores the rows once for both aggregates.
    pairs = pairs.select("label", "prediction", "score").cache()
    found = evaluation.classification_metrics(pairs, positive=1, digits=6).first().asDict()
    found["auc"] = evaluation.roc_auc(pairs).first()["auc"] or 0.0
    pairs.unpersist()
    return found


def regression_scores(model: PipelineModel, test: DataFrame) -> dict[str, float]:
    return evaluation.regression_metrics(scored(model, test), digits=6).first().asDict()


def train_binary(train: DataFrame, test: DataFrame, features: Sequence[str], target: str,
                 candidates: Mapping[str, Estimator] | None = None) -> Trained:
    """Balanced candidates; the best area under the ROC curve wins (the first on a tie)."""
    train, test = with_class_weights(_labelled(train, target), "label").cache(), _labelled(test, target)
    models, metrics = fit_and_score(
        {n: (e, train) for n, e in (candidates or classifiers(2)).items()}, features, lambda m: classification_scores(m, test, 2))
    train.unpersist()
    return Trained(models, metrics, max(metrics, key=lambda n: metrics[n]["auc"]))


def train_outcome(train: DataFrame, test: DataFrame, features: Sequence[str], target: str, key: str = "booking_id",
                  candidates: Mapping[str, Estimator] | None = None, final: Estimator | None = None,
                  oversample_share: float = OVERSAMPLE_SHARE) -> Trained:
    """Balanced candidates for comparison, and the weighted model on oversampled rows, which is always the final one."""
    train, test = _labelled(train, target), _labelled(test, target)
    balanced = with_class_weights(train, "label").cache()
    cancelled = train.filter(F.col("label") == 1).count()
    enriched = oversample(train, key, features, "label", 2, int(cancelled * oversample_share))
    weighted = with_class_weights(enriched, "label", OUTCOME_WEIGHTS).cache()
    estimators = {n: (e, balanced) for n, e in (candidates or classifiers(3)).items()}
    estimators["Weighted + Oversampled"] = (final or outcome_classifier(), weighted)
    models, metrics = fit_and_score(estimators, features, lambda m: classification_scores(m, test, 3))
    balanced.unpersist()
    weighted.unpersist()
    return Trained(models, metrics, "Weighted + Oversampled")


def best_baseline(trained: Trained, metric: str = "f1") -> str:
    names = [n for n in trained.metrics if n != "Weighted + Oversampled"]
    return max(names, key=lambda n: trained.metrics[n][metric])


def train_fare(train: DataFrame, test: DataFrame, features: Sequence[str], target: str,
               candidates: Mapping[str, Estimator] | None = None) -> Trained:
    """Fare candidates of one vehicle type; the best R2 on the original scale wins."""
    train, test = _labelled(train, target).cache(), _labelled(test, target)
    models, metrics = fit_and_score(
        {n: (e, train) for n, e in (candidates or regressors()).items()}, features, lambda m: regression_scores(m, test))
    train.unpersist()
    return Trained(models, metrics, max(metrics, key=lambda n: metrics[n]["r2"]))


# Search ------------------------------------------------------------------------------------------------------------

def random_settings(trials: int, seed: int = SEED, space: Mapping[str, tuple] = SEARCH_SPACE) -> list[dict[str, float]]:
    """Seeded draws from the search ranges."""
    generator = random.Random(seed)

    def one(bounds: tuple) -> float:
        if len(bounds) == 2:
            return generator.randint(*bounds)
        low, high, logarithmic = bounds
        return low * (high / low) ** generator.random() if logarithmic else generator.uniform(low, high)

    return [{name: one(bounds) for name, bounds in space.items()} for _ in range(trials)]


def _tunable(settings: Mapping[str, float], classes: int, seed: int = SEED) -> Estimator:
    boosted = GBTClassifier(seed=seed, weightCol="weight", **settings)
    return OneVsRest(classifier=boosted, weightCol="weight", parallelism=classes) if classes > 2 else boosted


def search(train: DataFrame, validation: DataFrame, features: Sequence[str], target: str, classes: int, trials: int,
           seed: int = SEED, space: Mapping[str, tuple] = SEARCH_SPACE, first_share: float = FIRST_SHARE,
           parallelism: int = PARALLEL_FITS) -> tuple[dict[str, float], list[dict]]:
    """Best of `trials` random settings by weighted F1 (three classes) or area under the ROC curve (two).

    All settings run for `first_share` of their rounds; that share of them (at least one; of equally good ones the earlier
    drawn) then runs for all rounds, and the best of these wins. `stopped` marks the others, whose score is that of the
    first stage; with a share of 1 there are none. The result does not depend on `parallelism`.
    """
    metric = "f1" if classes > 2 else "auc"
    train = with_class_weights(_labelled(train, target), "label").cache()
    validation = _labelled(validation, target).cache()
    drawn = random_settings(trials, seed, space)

    def scores(chosen: Sequence[int], share: float) -> dict[int, float]:
        estimators = {i: (_tunable({**drawn[i], "maxIter": max(1, round(drawn[i]["maxIter"] * share))}, classes, seed), train)
                      for i in chosen}
        return fit_and_score(estimators, features, lambda m: classification_scores(m, validation, classes)[metric], parallelism)[1]

    found = scores(range(trials), first_share)
    ranked = sorted(found, key=lambda i: (-found[i], i))
    ahead = ranked[:max(1, round(trials * first_share))]
    if first_share < 1:
        found.update(scores(ahead, 1.0))
    train.unpersist()
    validation.unpersist()
    tried = [{**settings, "score": found[i], "stopped": i not in ahead} for i, settings in enumerate(drawn)]
    return drawn[max(sorted(ahead), key=found.get)], tried


def retrain(train: DataFrame, test: DataFrame, features: Sequence[str], target: str, classes: int,
            settings: Mapping[str, Mapping[str, float]], seed: int = SEED) -> Trained:
    """Refit each named setting on the full training part; the best F1 wins (the first on a tie)."""
    train, test = with_class_weights(_labelled(train, target), "label").cache(), _labelled(test, target)
    models, metrics = fit_and_score({n: (_tunable(s, classes, seed), train) for n, s in settings.items()}, features,
                                    lambda m: classification_scores(m, test, classes))
    train.unpersist()
    return Trained(models, metrics, max(metrics, key=lambda n: metrics[n]["f1"]))


def choose_final(baseline: float, tuned: float | None) -> str:
    """The tuned model only if it is strictly better."""
    return "tuned" if tuned is not None and tuned > baseline else "baseline"


def selection_report(rows: Sequence[tuple[str, str, float, float | None]]) -> list[dict]:
    """One entry per task from (task, metric, baseline score, tuned score)."""
    return [
        {"use_case": u, "metric": m, "baseline": round(b, 4), "tuned": None if t is None else round(t, 4),
         "winner": choose_final(b, t)}
        for u, m, b, t in rows
    ]


def feature_importance(model: PipelineModel, features: Sequence[str], limit: int = 20) -> list[tuple[str, float]]:
    """Most important features of a tree model; empty for a model without importances."""
    last = model.stages[-1]
    if not hasattr(last, "featureImportances"):
        return []
    weights = last.featureImportances.toArray()
    return sorted(zip(features, map(float, weights)), key=lambda p: (-p[1], p[0]))[:limit]
