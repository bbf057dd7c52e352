"""Exact, repeatable splits. A row's place is decided by a hash of its key, never by its position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_HASH_DIGITS = 4  # leading hex digits that form the coarse slices: 65,536 of them


def draw(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))


def _fetched(df: DataFrame) -> DataFrame:
    """One row per class as a local table; it is broadcast, so that joins with it do not shuffle the other side."""
    return F.broadcast(df.sparkSession.createDataFrame(df.collect(), df.schema))


def mark_share(df: DataFrame, key: str, share: float, label: str | None = None, seed: int = 42,
               name: str = "chosen") -> DataFrame:
    """Flag the rounded `share` of the rows of every class (or of all rows) with the smallest hash of key and seed.

    A rank over a whole class would put it in one task. Instead the hash space is cut into slices: counting them
    shows which slice holds the last chosen row of each class, and only that slice is ranked. The cut points, one row
    per class, are fetched and stand as a local table: a join on the few classes by shuffling would put a class in one
    task as well. The frame itself is not shuffled.
    """
    # a missing class is a class, and joins only match values
    stratum = F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("missing")) if label else F.lit("all")
    marked = df.withColumns({"_stratum": stratum, "_draw": draw(key, seed)})
    slim = marked.select("_stratum", "_draw", F.col(key).alias("_key"),
                         F.substring("_draw", 1, _HASH_DIGITS).alias("_slice"))

    by_slice = Window.partitionBy("_stratum").orderBy("_slice")
    in_class = Window.partitionBy("_stratum")
    counted = (
        slim.groupBy("_stratum", "_slice").agg(F.count(F.lit(1)).alias("_n"))
        .withColumns({
            "_upto": F.sum("_n").over(by_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "_want": F.floor(F.sum("_n").over(in_class) * F.lit(share) + 0.5),
        })
    )
    last_slices = _fetched(
        counted.filter((F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_n") < F.col("_want")))
        .select("_stratum", "_slice", (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_take"))
    )
    in_slice = Window.partitionBy("_stratum").orderBy("_draw", "_key")
    cuts = _fetched(
        slim.join(last_slices, ["_stratum", "_slice"])
        .withColumn("_place", F.row_number().over(in_slice))
        .filter(F.col("_place") == F.col("_take"))
        .select("_stratum", F.col("_draw").alias("_cut"), F.col("_key").alias("_cut_key"))
    )
    before = (F.col("_draw") < F.col("_cut")) | (
        (F.col("_draw") == F.col("_cut")) & (F.col(key) <= F.col("_cut_key")))
    return (
        marked.join(cuts, "_stratum", "left")
        .withColumn(name, F.coalesce(before, F.lit(False)))
        .drop("_stratum", "_draw", "_cut", "_cut_key")
    )


def drop_missing_target(df: DataFrame, target: str) -> DataFrame:
    return df.filter(F.col(target).isNotNull())


def train_test(df: DataFrame, key: str, label: str | None = None, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Column `split` with 'train' or 'test'; with a label every class is split in the same proportion.

    Rows without a label are a class of their own.
    """
    marked = mark_share(df, key, test_share, label, seed, "_test")
    return marked.withColumn("split", F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def tuning_subset(train: DataFrame, key: str, label: str, share: float = 0.4, seed: int = 42) -> DataFrame:
    return mark_share(train, key, share, label, seed, "_tune").filter("_tune").drop("_tune")
