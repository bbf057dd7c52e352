"""Model evaluation as aggregations over a scored table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.exprs import round_stable, safe_ratio
from fareloom.functions.quantiles import running_totals

_F1_GUARD = 1e-9  # fixed value: keeps the F1 of an empty point defined


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def confusion(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("count"))


def confusion_matrix(scored: DataFrame, classes: list[int], label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """One row per actual class, one column `predicted_<class>` per class."""
    return (
        confusion(scored, label, prediction)
        .groupBy("label").pivot("prediction", classes).sum("count").fillna(0)
        .withColumnsRenamed({str(c): f"predicted_{c}" for c in classes})
        .orderBy("label")
    )


def class_report(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class; an undefined ratio is 0.

    The confusion counts (one row per pair of classes) are all that is joined or regrouped.
    """
    pairs = confusion(scored, label, prediction)
    per_class = (
        pairs.select(F.inline(F.array(
            F.struct(F.col("label").alias("class"), F.col("count").alias("actual"), F.lit(0).cast("bigint").alias("named"),
                     F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0).alias("hit")),
            F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("actual"),
                     F.col("count").alias("named"), F.lit(0).cast("bigint").alias("hit")),
        )))
        .groupBy("class").agg(F.sum("actual").alias("support"), F.sum("named").alias("named"), F.sum("hit").alias("hit"))
    )
    precision = _or_zero(safe_ratio(F.col("hit"), F.col("named")))
    recall = _or_zero(safe_ratio(F.col("hit"), F.col("support")))
    f1 = _or_zero(safe_ratio(2 * F.col("hit"), F.col("named") + F.col("support")))
    return per_class.select("class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
                            "support", "hit")


def classification_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction",
                           positive: int | None = None, digits: int = 4) -> DataFrame:
    """One row: accuracy with precision, recall and F1 of the positive class, or weighted by support without one."""
    report = class_report(scored, label, prediction)
    accuracy = round_stable(safe_ratio(F.sum("hit"), F.sum("support")), digits).alias("accuracy")
    if positive is not None:
        mine = [_or_zero(F.max(F.when(F.col("class") == positive, F.col(m)))) for m in ("precision", "recall", "f1")]
    else:
        mine = [safe_ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")) for m in ("precision", "recall", "f1")]
    named = [round_stable(m, digits).alias(n) for m, n in zip(mine, ("precision", "recall", "f1"))]
    return report.agg(accuracy, *named, F.sum("support").alias("rows"))


def score_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Per distinct score, from high to low: rows and positives at it (`n`, `pos`) and down to it (`cum_n`, `cum_pos`)."""
    return running_totals(
        scored.select(F.col(score).alias("score"), F.col(label).cast("int").alias("label")),
        "score", {"n": F.count(F.lit(1)), "pos": F.count_if(F.col("label") == 1)}, descending=True,
    )


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area: every (positive, negative) pair in order counts 1, every tied pair one half."""
    neg = F.col("n") - F.col("pos")
    won = F.col("cum_pos").cast("double") - F.col("pos") / 2
    total_pos, total_neg = F.sum("pos"), F.sum(neg)
    return score_curve(scored, label, score).agg(
        safe_ratio(F.sum(neg * won), total_pos.cast("double") * total_neg).alias("auc"),
        total_pos.alias("positives"), total_neg.alias("negatives"),
    )


def _points(scored: DataFrame, label: str, score: str) -> DataFrame:
    curve = score_curve(scored, label, score)
    positives = scored.agg(F.count_if(F.col(label) == 1).alias("p"))
    precision = F.col("cum_pos") / F.col("cum_n")
    recall = _or_zero(safe_ratio(F.col("cum_pos"), positives.scalar()))
    return curve.select(F.col("score").alias("threshold"), precision.alias("precision"), recall.alias("recall")).withColumn(
        "f1", 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + _F1_GUARD))


def best_f1_threshold(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """The score with the highest F1 when everything at or above it is flagged; the lowest such score on a tie."""
    points = _points(scored, label, score)
    pick = F.struct(-round_stable(F.col("f1"), 9), F.col("threshold"))
    return points.agg(*[F.min_by(c, pick).alias(c) for c in ("threshold", "precision", "recall", "f1")])


def precision_threshold(scored: DataFrame, min_precision: float = 0.65, label: str = "label",
                        score: str = "score") -> DataFrame:
    """The lowest score that still reaches the precision; the F1-best score when none does."""
    points = _points(scored, label, score)
    reached = F.when(F.col("precision") >= min_precision, F.col("threshold"))
    fallback = F.min_by("threshold", F.struct(-round_stable(F.col("f1"), 9), F.col("threshold")))
    return points.agg(
        F.coalesce(F.min(reached), fallback).alias("threshold"),
        F.when(F.min(reached).isNotNull(), "precision").otherwise("best_f1").alias("strategy"),
    )


def threshold_comparison(scored: DataFrame, tuned: float, default: float = 0.5, label: str = "label",
                         score: str = "score", digits: int = 4) -> DataFrame:
    """Confusion counts and rates at the default and at the tuned threshold, from one pass."""
    rows = F.array(*[
        F.struct(F.lit(name).alias("setting"), F.lit(float(at)).alias("threshold"), (F.col(score) >= at).alias("flagged"))
        for name, at in (("default", default), ("tuned", tuned))
    ])
    yes = F.col(label) == 1
    counted = (
        scored.select(label, score, F.inline(rows))
        .groupBy("setting", "threshold")
        .agg(
            F.count_if(yes & F.col("flagged")).alias("tp"), F.count_if(~yes & F.col("flagged")).alias("fp"),
            F.count_if(yes & ~F.col("flagged")).alias("fn"), F.count_if(~yes & ~F.col("flagged")).alias("tn"),
        )
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rates = {
        "precision": safe_ratio(tp, tp + fp), "recall": safe_ratio(tp, tp + fn),
        "f1": safe_ratio(2 * tp, 2 * tp + fp + fn), "fp_rate": safe_ratio(fp, fp + tn),
    }
    return counted.withColumns({n: round_stable(_or_zero(r), digits) for n, r in rates.items()})


def regression_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction",
                       log_target: bool = True, digits: int = 4) -> DataFrame:
    """MAE, RMSE and R2, on the original scale when the target is a logarithm."""
    y, p = F.col(label), F.col(prediction)
    if log_target:
        y, p = F.expm1(y), F.expm1(p)
    pairs = scored.select(y.alias("y"), p.alias("p")).filter(F.col("y").isNotNull() & F.col("p").isNotNull())
    gap = F.col("y") - F.col("p")
    return pairs.agg(
        round_stable(F.avg(F.abs(gap)), digits).alias("mae"),
        round_stable(F.sqrt(F.avg(gap * gap)), digits).alias("rmse"),
        round_stable(1 - safe_ratio(F.avg(gap * gap), F.var_pop("y")), digits).alias("r2"),
        F.count(F.lit(1)).alias("rows"),
    )


def residuals(scored: DataFrame, label: str = "label", prediction: str = "prediction", log_target: bool = True) -> DataFrame:
    y, p = F.col(label), F.col(prediction)
    if log_target:
        y, p = F.expm1(y), F.expm1(p)
    return scored.withColumns({"actual": y, "predicted": p, "residual": y - p})
