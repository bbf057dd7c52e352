"""Mixing of sources to target weights by systematic sampling.

Each document of a source expects target / size of the source copies. The documents of a source stand in one order
(words, then a bucket of the id, then the id); the expected copies are summed along it, one random offset is added, and
a document is taken once for each whole number that its stretch of the sum crosses. The order by words keeps the words
taken near the target: the error of every prefix is below one document.

Defined results: a null text has 0 words; rows with a null source are a source of their own, ordered last; null ids
count as id 0 in the order; repeated rows are drawn one by one; an empty table gives no rows; a source without words has
target 0 and takes nothing. Columns other than doc_id, text and source are not read.

No source and no group of equal documents is ordered in one task: the place of a row is the number of rows in earlier
(source, words) pairs, plus those in earlier buckets of its pair, plus its rank within the bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.frames import numbered, stored, text_column

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 1024


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_column(text), F.lit(WORD)).cast("long")


def targets(measured: DataFrame, share: float, cap: float, weights: tuple[int, ...]) -> DataFrame:
    """source_size and target of each source.

    The sources fill like vessels of width weight and volume cap x size: all stand at one level but for those that are
    full. The level is found from the running sums in the order in which they fill up. One row per source.
    """
    by_source = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(ordered) - 1) % len(weights) + 1).cast("int"))
    filling = Window.orderBy(F.col("volume") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    leveled = (
        by_source.withColumn("weight", weight).withColumn("volume", F.col("source_size") * F.lit(cap))
        .withColumn("wanted", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("full", F.coalesce(F.sum("volume").over(filling), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filling), F.lit(0.0)))
        .withColumn("level", F.max((F.col("wanted") - F.col("full")) / F.col("open")).over(everything))
    )
    return leveled.select("source", "source_size", F.least("volume", F.col("level") * F.col("weight")).alias("target"))


def offset(seed: str) -> Column:
    """The source's random offset in [0, 1), the same in every run with the same seed."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("source"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mixed_copies(docs: DataFrame, share: float = 1.5, cap: float = 2.0, weights: tuple[int, ...] = (3, 1, 2), seed: str = "mix") -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (words) of each row of `docs`."""
    bucket = F.coalesce(F.pmod("doc_id", F.lit(BUCKETS)), F.lit(0)).cast("int")
    measured = stored(docs.select("doc_id", "source", word_count().alias("size"), bucket.alias("bucket")), "mixing-sizes")
    cells = measured.groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    pairs = cells.groupBy("source", "size").agg(F.sum("rows").alias("pair_rows"))
    up_to = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    pairs = pairs.select(F.col("source").alias("p_source"), F.col("size").alias("p_size"),
                         F.coalesce(F.sum("pair_rows").over(up_to), F.lit(0)).alias("before_pair"))
    inside = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("source", "size", "bucket", F.coalesce(F.sum("rows").over(inside), F.lit(0)).alias("before_cell"))
    cells = cells.join(pairs, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size")))
    aims = targets(measured, share, cap, weights).select(F.col("source").alias("t_source"), "source_size", "target")
    cells = (
        cells.join(aims, F.col("source").eqNullSafe(F.col("t_source")))
        .select(F.col("source").alias("c_source"), F.col("size").alias("c_size"), F.col("bucket").alias("c_bucket"),
                (F.col("before_pair") + F.col("before_cell")).alias("before"), "source_size", "target")
    )
    rank = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("doc_id"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (
        measured.withColumn("rank", rank)
        .join(cells, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("size") == F.col("c_size")) & (F.col("bucket") == F.col("c_bucket")))
        .withColumn("place", (F.col("rank") + F.col("before")).cast("double")).withColumn("rate", rate).withColumn("offset", offset(seed))
        .withColumn("copies", F.floor(F.col("rate") * F.col("place") + F.col("offset"))
                    - F.floor(F.col("rate") * (F.col("place") - 1) + F.col("offset")))
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of `docs`, each as often as it is taken, in its own columns.

    Rows that agree in doc_id, source and number of words share their copies equally, rounded half up.
    """
    drawn = mixed_copies(docs, **settings).groupBy(F.col("doc_id").alias("d_id"), F.col("source").alias("d_source"), F.col("size").alias("d_size")) \
        .agg(F.round(F.avg("copies")).cast("int").alias("d_copies")).where("d_copies > 0")
    rows, at = numbered(docs)
    same = F.col(at["doc_id"]).eqNullSafe(F.col("d_id")) & F.col(at["source"]).eqNullSafe(F.col("d_source")) & (F.col("d_words") == F.col("d_size"))
    taken = rows.withColumn("d_words", word_count(at["text"])).join(drawn, same)
    return taken.withColumn("d_copy", F.explode(F.sequence(F.lit(1), F.col("d_copies")))).select(*[F.col(at[c]).alias(c) for c in docs.columns])
