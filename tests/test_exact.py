"""Quantiles, running totals, splits and curves against brute force, with hot values."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from fareloom.functions import quantiles
from fareloom.functions.quantiles import exact_quantiles, running_totals
from fareloom.operators import evaluation, splitting

PROBS = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]


def sample(n, seed=7):
    """A third of the values are one and the same."""
    draw = random.Random(seed)
    return [0.25 if draw.random() < 1 / 3 else draw.lognormvariate(0, 2) for _ in range(n)]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 1000, 20_000, 150_000])
def test_quantiles_equal_numpy(spark, n):
    data = sample(n)
    df = spark.createDataFrame([(x, float(i)) for i, x in enumerate(data)], "x DOUBLE, i DOUBLE")
    got = {r["feature"]: [r[f"q{k}"] for k in range(len(PROBS))]
           for r in exact_quantiles(df, ["x", "i"], PROBS).collect()}
    assert np.allclose(got["x"], np.quantile(data, PROBS), rtol=0, atol=1e-12)
    assert np.allclose(got["i"], np.quantile(np.arange(n, dtype=float), PROBS), rtol=0, atol=1e-9)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 1000, 20_000, 150_000])
@pytest.mark.parametrize("kept", [10, 50_000])
def test_narrowed_quantiles_equal_numpy(spark, monkeypatch, n, kept):
    """Few rows kept force several rounds; a third of the rows are one value, and one column has a single value."""
    monkeypatch.setattr(quantiles, "KEPT_ROWS", kept)
    data = sample(n)
    df = spark.createDataFrame([(x, float(i), 3.0, None) for i, x in enumerate(data)], "x DOUBLE, i DOUBLE, s DOUBLE, e DOUBLE")
    got = quantiles.quantile_values(df, ["x", "i", "s", "e"], PROBS)
    assert np.allclose(got["x"], np.quantile(data, PROBS), rtol=0, atol=1e-12)
    assert np.allclose(got["i"], np.quantile(np.arange(n, dtype=float), PROBS), rtol=0, atol=1e-9)
    assert got["s"] == [3.0] * len(PROBS) and "e" not in got


def test_a_bracket_with_a_third_of_the_distinct_values(spark, monkeypatch):
    """Values so close that the first bounds catch a third of them, beside far ones, infinity and NaN."""
    monkeypatch.setattr(quantiles, "KEPT_ROWS", 50)
    data = [1.0 + i * 1e-12 for i in range(20_000)] + [float(i * 1000) for i in range(1, 40_001)]
    df = spark.createDataFrame([(x,) for x in data], "x DOUBLE").repartition(4)
    assert np.allclose(quantiles.quantile_values(df, ["x"], PROBS)["x"], np.quantile(data, PROBS), rtol=1e-12, atol=0)
    odd = spark.createDataFrame([(x,) for x in [1.0, float("inf"), float("-inf"), float("nan"), 2.0]], "x DOUBLE")
    low, middle, high = quantiles.quantile_values(odd, ["x"], [0.0, 0.5, 1.0])["x"]
    assert (low, middle) == (float("-inf"), 2.0) and high != high


def test_rounds_need_no_row_per_cell(spark, monkeypatch):
    """A round reads the source twice, and only rows inside the last brackets are exploded."""
    seen = []
    narrow = quantiles._narrowed
    monkeypatch.setattr(quantiles, "_narrowed", lambda *a: seen.append(narrow(*a)) or seen[-1])
    df = spark.range(400_000).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(id % 7 AS DOUBLE) AS d")
    assert quantiles.quantile_values(df, ["x", "d"], [0.25, 0.5]) == {"x": [99_999.75, 199_999.5], "d": [1.0, 3.0]}
    assert len(seen) <= 2 and all(b.inside < 4_000 for b in seen[-1] if b.column == "x")


def test_quantiles_by_group_skip_nulls(spark):
    rows = [("a", 1.0), ("a", None), ("a", 3.0), ("b", None), ("c", 5.0)]
    df = spark.createDataFrame(rows, "g STRING, x DOUBLE")
    got = {r["g"]: r["q0"] for r in exact_quantiles(df, ["x"], [0.5], by=["g"]).collect()}
    assert got == {"a": 2.0, "c": 5.0}


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("slices", [2, 16])
def test_running_totals(spark, descending, slices):
    data = sample(3000)
    df = spark.createDataFrame([(x,) for x in data], "x DOUBLE")
    rows = {r["x"]: r for r in running_totals(df, "x", {"n": F.count(F.lit(1))}, descending, slices).collect()}
    total = 0
    for value in sorted(set(data), reverse=descending):
        total += data.count(value)
        assert rows[value]["n"] == data.count(value) and rows[value]["cum_n"] == total
    assert len(rows) == len(set(data))


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_split_is_exact_and_does_not_depend_on_partitions(spark, partitions):
    # One class holds nearly all rows, one a single row.
    labels = [0] * 4000 + [1] * 801 + [2]
    df = spark.createDataFrame(list(enumerate(labels)), "booking_id BIGINT, y INT").repartition(partitions)
    split = splitting.train_test(df, "booking_id", "y")
    counts = {(r["y"], r["split"]): r["count"] for r in split.groupBy("y", "split").count().collect()}
    assert counts == {(0, "test"): 800, (0, "train"): 3200, (1, "test"): 160, (1, "train"): 641, (2, "train"): 1}
    chosen = sorted(r[0] for r in split.filter("split = 'test'").select("booking_id").collect())
    import hashlib
    ranked = sorted((hashlib.md5(f"{k}-42".encode()).hexdigest(), k) for k, y in enumerate(labels) if y == 0)
    assert sorted(k for _, k in ranked[:800]) == [k for k in chosen if k < 4000]


def test_share_bounds(spark):
    df = spark.range(100).withColumnRenamed("id", "booking_id")
    assert splitting.mark_share(df, "booking_id", 0.0).filter("chosen").count() == 0
    assert splitting.mark_share(df, "booking_id", 1.0).filter("chosen").count() == 100
    other = splitting.mark_share(df, "booking_id", 0.5, seed=1).filter("chosen").exceptAll(
        splitting.mark_share(df, "booking_id", 0.5, seed=2).filter("chosen"))
    assert other.count() > 0


def scored(spark, n=2000, digits=2):
    draw = random.Random(3)
    rows = []
    for i in range(n):
        y = int(draw.random() < 0.3)
        rows.append((i, y, round(min(1.0, max(0.0, draw.gauss(0.4 + 0.2 * y, 0.2))), digits)))
    return spark.createDataFrame(rows, "booking_id BIGINT, label INT, score DOUBLE"), rows


@pytest.mark.parametrize("digits", [1, 2, 15])
def test_auc(spark, digits):
    df, rows = scored(spark, digits=digits)
    pos = np.array([s for _, y, s in rows if y])
    neg = np.array([s for _, y, s in rows if not y])
    exact = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert evaluation.roc_auc(df).first()["auc"] == pytest.approx(exact, abs=1e-12)
    vectors = df.select(F.col("label").cast("double"), F.col("score").alias("rawPrediction"))
    ml = BinaryClassificationEvaluator(numBins=0).evaluate(vectors)
    assert evaluation.roc_auc(df).first()["auc"] == pytest.approx(ml, abs=1e-6)


def test_thresholds(spark):
    df, rows = scored(spark)

    def at(t):
        tp = sum(1 for _, y, s in rows if y and s >= t)
        flagged = sum(1 for _, _, s in rows if s >= t)
        p, r = tp / flagged, tp / sum(y for _, y, _ in rows)
        return p, 2 * p * r / (p + r + 1e-9)

    scores = sorted({s for _, _, s in rows})
    best = max(scores, key=lambda t: (round(at(t)[1], 9), -t))
    assert evaluation.best_f1_threshold(df).first()["threshold"] == best
    reach = [t for t in scores if at(t)[0] >= 0.5]
    assert evaluation.precision_threshold(df, 0.5).first().asDict() == {"threshold": min(reach), "strategy": "precision"}
    assert evaluation.precision_threshold(df, 1.1).first().asDict() == {"threshold": best, "strategy": "best_f1"}


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "label INT, score DOUBLE")
    assert evaluation.roc_auc(df).first()["auc"] is None


def test_unknown_ratios_are_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label INT, prediction INT")
    found = evaluation.classification_metrics(df, positive=1).first()
    assert (found["precision"], found["recall"], found["f1"]) == (0.0, 0.0, 0.0)


def test_share_does_not_shuffle_the_frame(spark):
    """A join on the few classes by shuffling would read a whole class in one task."""
    df = spark.range(500).select(F.col("id").alias("booking_id"), (F.col("id") % 3).alias("kind"), F.lit("x").alias("wide"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        marked = splitting.mark_share(df, "booking_id", 0.2, "kind")
        plan = marked._jdf.queryExecution().executedPlan().toString()
        counts = {r["kind"]: r["n"] for r in marked.filter("chosen").groupBy("kind").agg(F.count("*").alias("n")).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert counts == {0: 33, 1: 33, 2: 33} and marked.count() == 500


def test_narrowing_reads_short_branches_and_uneven_values(spark, monkeypatch):
    """Every column is found, however many there are; values that buckets of equal width hardly part are cut by rank."""
    monkeypatch.setattr(quantiles, "KEPT_ROWS", 20)
    uneven = [1e300, -1e300] + [10.0 ** -(i / 100) for i in range(20_000)]
    df = spark.createDataFrame([(x,) for x in uneven], "x DOUBLE").repartition(4)
    assert quantiles.quantile_values(df, ["x"], PROBS)["x"] == pytest.approx(np.quantile(uneven, PROBS), rel=1e-12, abs=0)
    wide = spark.range(101).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(3 * quantiles.CELL_COLUMNS + 1)])
    assert quantiles.quantile_values(wide, wide.columns, [0.5]) == {c: [50.0 * i] for i, c in enumerate(wide.columns)}
