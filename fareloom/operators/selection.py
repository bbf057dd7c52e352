"""Feature selection by correlation and by tree importance. Only k-by-k or k-long results reach the driver."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.operators.training import with_class_weights


def _pearson(x: Column, y: Column) -> Column:
    """Correlation over the rows that have both; null for a constant side, where `corr` would divide by zero.

    A constant side is told by its extremes: merging partial deviations can leave a tiny value instead of zero.
    """
    both_x, both_y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    varies = (F.min(both_x) < F.max(both_x)) & (F.min(both_y) < F.max(both_y))
    spread = F.stddev_pop(both_x) * F.stddev_pop(both_y)
    return F.when(varies, F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0)))


def target_correlations(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """`feature`, `correlation` with the target; a feature without values has none.

    A row per feature and row is aggregated by feature, in compiled code: one wide aggregate of all features would be too
    long to be compiled.
    """
    y = F.col(f"`{target}`").cast("double")
    cells = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    found = (
        df.select(y.alias("y"), F.posexplode(cells).alias("place", "x"))
        .groupBy("place").agg(_pearson(F.col("x"), F.col("y")).alias("correlation"))
    )
    names = df.sparkSession.createDataFrame(list(enumerate(features)), "place INT, feature STRING")
    return names.join(found, "place", "left").select("feature", "correlation")


def correlation_ranking(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Features by absolute correlation, strongest first; a constant feature has none and comes last."""
    strength = F.abs(F.col("correlation"))
    return (
        target_correlations(df, features, target)
        .withColumn("strength", strength)
        .orderBy(F.desc_nulls_last("strength"), "feature")
    )


def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


def correlation_matrix(df: DataFrame, features: Sequence[str]) -> list[list[float]]:
    """Pearson matrix of the features (no missing values allowed), NaN where a feature is constant."""
    vectors = _assembled(df, features).select("features")
    matrix = Correlation.corr(vectors, "features").first()[0].toArray()
    ends = vectors.select(Summarizer.metrics("min", "max").summary(F.col("features")).alias("e")).first()["e"]
    constant = ends["min"].toArray() == ends["max"].toArray()
    matrix[constant, :] = matrix[:, constant] = math.nan
    return matrix.tolist()


def redundant_features(features: Sequence[str], matrix: Sequence[Sequence[float]], strength: dict[str, float | None],
                       bound: float) -> set[str]:
    """Of every pair correlated at or above the bound, the one less correlated with the target.

    Features are visited in column order and compared with the earlier ones; one that is out no longer counts,
    except that a feature which goes out during its own visit is still compared with the rest.
    """
    out: set[str] = set()
    for j, feature in enumerate(features):
        if feature in out:
            continue
        for i in range(j):
            other = features[i]
            if other in out or math.isnan(matrix[i][j]) or abs(matrix[i][j]) < bound:
                continue
            weaker = other if (strength[feature] or 0.0) >= (strength[other] or 0.0) else feature
            out.add(weaker)
    return out


def correlation_filter(train: DataFrame, features: Sequence[str], target: str, min_target: float = 0.01,
                       max_mutual: float = 0.95) -> tuple[list[str], dict]:
    """Kept features and a report. A constant feature has no correlation and is kept.

    `train` has no missing values here, so one matrix over the features and the target serves both stages.
    """
    matrix = correlation_matrix(train, [*features, target])
    place = {f: i for i, f in enumerate(features)}
    with_target = {f: abs(matrix[i][-1]) for f, i in place.items()}
    strength = {f: None if math.isnan(c) else c for f, c in with_target.items()}
    weak = [f for f in features if strength[f] is not None and strength[f] < min_target]
    left = [f for f in features if f not in set(weak)]
    mutual = [[matrix[place[a]][place[b]] for b in left] for a in left]
    redundant = redundant_features(left, mutual, strength, max_mutual)
    kept = [f for f in left if f not in redundant]
    ranking = sorted(((f, strength[f]) for f in kept), key=lambda p: (p[1] is None, -(p[1] or 0.0), p[0]))
    return kept, {"low_target_correlation": weak, "redundant": sorted(redundant), "ranking": ranking}


def importances(train: DataFrame, features: Sequence[str], target: str, classification: bool, trees: int = 50,
                depth: int = 6, seed: int = 42) -> list[tuple[str, float]]:
    """Random-forest importances on the whole training part, largest first."""
    data = _assembled(train, features).select("features", F.col(target).alias("label"))
    if classification:
        data = with_class_weights(data, "label")
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, weightCol="weight")
    else:
        forest = RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=seed)
    weights = forest.fit(data).featureImportances.toArray()
    return sorted(zip(features, map(float, weights)), key=lambda p: (-p[1], p[0]))


def importance_filter(train: DataFrame, features: Sequence[str], target: str, classification: bool,
                      top_n: int | None = None, threshold: float | None = None, trees: int = 50,
                      seed: int = 42) -> tuple[list[str], dict]:
    """Keep the `top_n` most important features, or those at or above `threshold`; exactly one must be given."""
    if (top_n is None) == (threshold is None):
        raise ValueError("give either top_n or threshold")
    ranked = importances(train, features, target, classification, trees, seed=seed)
    kept = [f for f, _ in ranked[:top_n]] if top_n is not None else [f for f, w in ranked if w >= threshold]
    return kept, {"importance": ranked, "kept": kept, "dropped": [f for f, _ in ranked if f not in set(kept)]}
