"""Exact order statistics and running totals that never gather a whole column in one task.

Spark's `percentile` keeps every distinct value of a group in one aggregation buffer. Here an approximate pass
first brackets the wanted rank between two values; then only the values inside the bracket are counted and ordered.
Running totals over a large ordered domain are split at fitted cut points: totals per slice, then a window per slice.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fareloom.sources.tables import settled

# The bracket spans this share of the rows on each side; the sketch is ten times finer.
BRACKET_MARGIN = 1e-4
SKETCH_ACCURACY = 100_000
SLICE_VALUES = 1_000_000
# A bracket of whole columns is narrowed until it holds so many rows; a round cuts it into so many parts of equal width,
# after EVEN_ROUNDS rounds into so many parts of about as many rows.
KEPT_ROWS = 50_000
BUCKETS = 1024
EVEN_ROUNDS = 3
RANK_STEPS = 100
CELL_COLUMNS = 12


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Linearly interpolated quantiles: one row per group and column with `feature` and `q0`, `q1`, ...

    Nulls are left out. The result equals `percentile` and numpy's default method. In few rows a bracket can miss a
    wanted rank by one place, so the nearest values below and above each bracket are kept as well.
    """
    by = list(by)
    marks = [max(p - BRACKET_MARGIN, 0.0) for p in probs] + [min(p + BRACKET_MARGIN, 1.0) for p in probs]
    number = {c: F.col(c).cast("double") for c in columns}

    # One wide pass for all columns, without a row per column.
    sketches = df.groupBy(*by).agg(*[
        F.struct(F.lit(c).alias("feature"), F.count(x).alias("n"), F.percentile_approx(x, marks, SKETCH_ACCURACY).alias("marks")).alias(f"_s{k}")
        for k, (c, x) in enumerate(number.items())
    ])
    ranks = []
    for i, p in enumerate(probs):
        position = (F.col("s.n") - 1) * F.lit(float(p))
        ranks.append(F.struct(
            F.lit(i).alias("i"), F.get("s.marks", F.lit(i)).alias("low"), F.get("s.marks", F.lit(len(probs) + i)).alias("high"),
            (F.floor(position) + 1).alias("at"), (position - F.floor(position)).alias("part"),
        ))
    brackets = (
        sketches.select(*by, F.explode(F.array(*[f"_s{k}" for k in range(len(columns))])).alias("s")).filter("s.n > 0")
        .select(*by, F.col("s.feature").alias("feature"), F.explode(F.array(*ranks)).alias("r")).select(*by, "feature", "r.*")
    )
    long = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), x.alias("x")) for c, x in number.items()
    ])).alias("v")).select(*by, "v.feature", "v.x").filter(F.col("x").isNotNull())

    # One row per bracket for what lies outside, one per value inside: only these are ordered.
    keys = [*by, "feature", "i"]
    placed = long.join(brackets, [*by, "feature"])
    outside = placed.groupBy(*keys, "at", "part").agg(
        F.count_if(F.col("x") < F.col("low")).alias("below"),
        F.max(F.when(F.col("x") < F.col("low"), F.col("x"))).alias("before"),
        F.min(F.when(F.col("x") > F.col("high"), F.col("x"))).alias("after"),
    )
    inside = placed.filter(F.col("x").between(F.col("low"), F.col("high"))).groupBy(*keys, F.col("x").alias("value")).agg(F.count(F.lit(1)).alias("c"))
    in_order = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = inside.withColumn("upto", F.sum("c").over(in_order))

    def at_rank(rank: Column) -> Column:
        return F.min(F.when(F.col("below") + F.col("upto") >= rank, F.col("value")))

    found = (
        outside.join(ordered, keys)
        .groupBy(*keys, "at", "part", "below", "before", "after")
        .agg(at_rank(F.col("at")).alias("x0"), at_rank(F.col("at") + 1).alias("x1"))
        .withColumns({
            "x0": F.when(F.col("at") <= F.col("below"), F.col("before")).otherwise(F.coalesce("x0", "after")),
            "x1": F.when(F.col("at") + 1 <= F.col("below"), F.col("before")).otherwise(F.coalesce("x1", "after")),
        })
        .withColumn("q", F.col("x0") + (F.coalesce("x1", "x0") - F.col("x0")) * F.col("part"))
    )
    return found.groupBy(*by, "feature").agg(
        *[F.max(F.when(F.col("i") == i, F.col("q"))).alias(f"q{i}") for i in range(len(probs))]
    )


@dataclass(frozen=True)
class Bracket:
    """Where ranks of a column are searched: `below` rows lie under `low`, `inside` rows from `low` to `high`."""

    column: str
    low: float
    high: float
    below: int
    inside: int
    ends: tuple[float, float]  # the least and the greatest finite value inside

    @property
    def single(self) -> bool:
        return _same(self.low, self.high)

    @property
    def open(self) -> bool:
        return self.inside > KEPT_ROWS and not self.single


def _same(a: float, b: float) -> bool:
    return a == b or (a != a and b != b)


def _cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`place`, `x`: a row per value that is not null. A branch reads CELL_COLUMNS columns, so that its code stays short enough
    for the JVM to compile."""
    parts = []
    for first in range(0, len(columns), CELL_COLUMNS):
        values = F.array(*[F.col(f"`{c}`").cast("double") for c in columns[first:first + CELL_COLUMNS]])
        parts.append(df.select(F.posexplode(values).alias("place", "x")).filter(F.col("x").isNotNull())
                     .withColumn("place", F.col("place") + first))
    return reduce(DataFrame.unionByName, parts)


def _inside(cells: DataFrame, places: Mapping[str, int], brackets: Sequence[Bracket]) -> DataFrame:
    """`k`, `x`, `start`, `scale`: the values inside of each bracket, and how they are laid over its buckets."""
    def scale(b: Bracket) -> float:
        width = b.ends[1] / 2 - b.ends[0] / 2
        found = BUCKETS / width if width > 0 else 0.0
        return found if math.isfinite(found) else 0.0

    bounds = cells.sparkSession.createDataFrame(
        [(k, places[b.column], float(b.low), float(b.high), b.ends[0], scale(b)) for k, b in enumerate(brackets)],
        "k INT, place_of INT, low DOUBLE, high DOUBLE, start DOUBLE, scale DOUBLE")
    hit = (cells["place"] == bounds["place_of"]) & cells["x"].between(bounds["low"], bounds["high"])
    return cells.join(F.broadcast(bounds), hit).select("k", "x", "start", "scale")


def _even_buckets(inside: DataFrame) -> DataFrame:
    """Buckets of equal width; values that are not finite have their own."""
    x = F.col("x")
    place = F.floor((x / 2 - F.col("start") / 2) * F.col("scale"))
    bucket = (
        F.when(F.isnan(x), BUCKETS + 1).when(x == F.lit(math.inf), BUCKETS).when(x == F.lit(-math.inf), -1)
        .otherwise(F.least(place, F.lit(BUCKETS - 1)))
    )
    return inside.withColumn("bucket", bucket)


def _ranked_buckets(inside: DataFrame) -> DataFrame:
    """Buckets cut at approximate quantiles, for values so uneven that buckets of equal width hardly part them."""
    steps = [i / RANK_STEPS for i in range(1, RANK_STEPS)]
    cuts = inside.groupBy("k").agg(F.percentile_approx("x", steps, 10 * RANK_STEPS).alias("cuts"))
    return inside.join(F.broadcast(cuts), "k").withColumn("bucket", F.size(F.filter("cuts", lambda c: c < F.col("x"))))


def _narrowed(cells: DataFrame, places: Mapping[str, int], ranks: Mapping[tuple[str, int], Bracket],
              buckets: Callable[[DataFrame], DataFrame]) -> list[Bracket]:
    """For each (column, rank) the bucket of its bracket that holds the rank: one pass over the cells, counted by bucket."""
    brackets = list(dict.fromkeys(ranks.values()))
    number = {b: k for k, b in enumerate(brackets)}
    keys = list(ranks)
    wanted = cells.sparkSession.createDataFrame(
        [(i, number[ranks[key]], key[1] - ranks[key].below) for i, key in enumerate(keys)], "i INT, k INT, place BIGINT")
    counted = buckets(_inside(cells, places, brackets)).groupBy("k", "bucket").agg(
        F.count(F.lit(1)).alias("c"), F.min("x").alias("low"), F.max("x").alias("high"))
    upto = F.sum("c").over(Window.partitionBy("k").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # a place falls in the first bucket up to which that many rows are counted
    ordered = counted.withColumn("upto", upto)
    on_place = (ordered["k"] == wanted["k"]) & (wanted["place"] > ordered["upto"] - ordered["c"]) & (wanted["place"] <= ordered["upto"])
    held = {r["i"]: r for r in ordered.join(F.broadcast(wanted), on_place).select("i", "low", "high", "upto", "c").collect()}
    return [
        Bracket(column, held[i]["low"], held[i]["high"], ranks[column, rank].below + held[i]["upto"] - held[i]["c"], held[i]["c"],
                (held[i]["low"], held[i]["high"]))
        for i, (column, rank) in enumerate(keys)
    ]


def quantile_values(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """Linearly interpolated quantiles of a whole frame, a list for each column that has any value.

    Selection by narrowing: every wanted rank has a bracket of values, at first the whole range of its column. A round
    is one pass that counts the rows of all brackets by BUCKETS parts of each; the part with the rank, from its least to
    its greatest value, is the next bracket. It ends when none holds more than KEPT_ROWS rows or more than one value. Then
    the values left are counted one by one. Cells are rows (column, value) that are aggregated where they are made, in
    compiled code; wide aggregates of all columns would be too long to be compiled. The result equals `percentile` and numpy's default
    method; nulls are left out, NaN is the largest value.
    """
    if not columns:
        return {}
    cells = _cells(df, columns)
    finite = F.when(~F.isnan("x") & (F.abs("x") < F.lit(math.inf)), F.col("x"))
    whole = cells.groupBy("place").agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"),
        F.min(finite).alias("first"), F.max(finite).alias("last")).collect()
    places, found = {c: i for i, c in enumerate(columns)}, {}
    parts: dict[str, list[tuple[int, float]]] = {}
    for i, n, low, high, first, last in sorted(whole):
        column, every = columns[i], Bracket(columns[i], low, high, 0, n, (first or 0.0, last or 0.0))
        for p in probs:
            place = (n - 1) * p
            rank = math.floor(place) + 1
            parts.setdefault(column, []).append((rank, place - math.floor(place)))
            found.update({(column, r): every for r in (rank, min(rank + 1, n))})
    rounds = 0
    while going := {key: b for key, b in found.items() if b.open}:
        narrower = _narrowed(cells, places, going, _even_buckets if rounds < EVEN_ROUNDS else _ranked_buckets)
        if rounds >= EVEN_ROUNDS and narrower == list(going.values()):
            break
        found.update(zip(going, narrower))
        rounds += 1
    left = {key: b for key, b in found.items() if not b.single}
    if left:
        found.update(zip(left, _narrowed(cells, places, left, lambda inside: inside.withColumn("bucket", F.col("x")))))
    result = {}
    for c, wanted in parts.items():
        pairs = [(found[c, rank].low + 0.0, found.get((c, rank + 1), found[c, rank]).low + 0.0, part) for rank, part in wanted]
        result[c] = [x if not part or _same(x, after) else x + (after - x) * part for x, after, part in pairs]
    return result


def running_totals(df: DataFrame, order_by: str, totals: Mapping[str, Column], descending: bool = False,
                   slices: int | None = None) -> DataFrame:
    """Per distinct `order_by` value: each total (`name`) and its running sum in that order (`cum_<name>`).

    Rows are first combined per value. The values are cut into slices of about equal size, so no slice depends on
    how the values are spread, and their number grows with the values; a value that holds most of the rows is still one row.
    """
    names = list(totals)
    # Stored, because the cut points, the slice totals and the slices all start from it.
    per_value = settled(
        df.filter(F.col(order_by).isNotNull())
        .groupBy(F.col(order_by).cast("double").alias(order_by))
        .agg(*[expr.alias(name) for name, expr in totals.items()]),
        "per_value",
    )
    if slices is None:  # slices of bounded size, however many values there are
        slices = max(2, -(-per_value.count() // SLICE_VALUES))
    marks = per_value.agg(
        F.percentile_approx(order_by, [i / slices for i in range(1, slices)], max(10 * slices, 10_000)).alias("m")
    ).first()["m"] or []
    cuts = [float("-inf"), *(sorted(set(marks)) or [0.0]), float("inf")]
    sliced = Bucketizer(splits=cuts, inputCol=order_by, outputCol="slice").transform(per_value)

    direction = F.col("slice").desc() if descending else F.col("slice")
    earlier = Window.partitionBy(F.lit(0)).orderBy(direction).rowsBetween(Window.unboundedPreceding, -1)
    before = (
        sliced.groupBy("slice").agg(*[F.sum(n).alias(n) for n in names])
        .select("slice", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"before_{n}") for n in names])
    )
    order = F.col(order_by).desc() if descending else F.col(order_by)
    within = Window.partitionBy("slice").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        sliced.join(before, "slice")
        .select(
            order_by, *names,
            *[(F.sum(n).over(within) + F.col(f"before_{n}")).alias(f"cum_{n}") for n in names],
        )
    )
