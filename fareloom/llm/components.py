"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.frames import stored_at
from fareloom.sources.tables import drop_path


def components(edges: DataFrame, left: str, right: str, name: str = "components") -> DataFrame:
    """node and component (its least node) of every node that has an edge to another one.

    A large star hangs each node's larger neighbours under the least node near it, a small star the smaller ones; both
    keep the components. After a few rounds every node hangs under its component's least node. Each round is written to
    the shared folder. A node with very many neighbours is only ever joined with one row of its own, so that the
    engine can split it; minima are combined before the shuffle. No edges give no rows.
    """
    pairs = edges.select(F.greatest(left, right).alias("high"), F.least(left, right).alias("low")).where("high > low").distinct()
    now, place = stored_at(pairs, name)
    seen = _signature(now)
    while True:
        before = place
        now, place = stored_at(_small_star(_large_star(now)), name)
        drop_path(now.sparkSession, before)  # the new table stands on its own
        after = _signature(now)
        if after == seen:
            return now.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
                now.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct())
        seen = after


def _signature(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("high", "low") % (1 << 31)).alias("s"),
                    F.bit_xor(F.xxhash64("low", "high")).alias("x")).first()
    return row.n, row.s, row.x


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.select(F.col("high").alias("u"), F.col("low").alias("v")).unionByName(pairs.select(F.col("low").alias("u"), F.col("high").alias("v")))
    least = (
        both.groupBy("u").agg(F.min("v").alias("v_min")).select("u", F.least("u", "v_min").alias("m"))
    )
    return both.join(least, "u").where("v > u AND v > m").select(F.col("v").alias("high"), F.col("m").alias("low")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("high").agg(F.min("low").alias("m"))
    hung = pairs.join(least, "high").where("low > m").select(F.col("low").alias("high"), F.col("m").alias("low"))
    return hung.unionByName(least.select("high", F.col("m").alias("low"))).distinct()
