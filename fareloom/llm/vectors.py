"""Embeddings as numpy blocks, shared by the vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, id_name: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """node and vector (doubles) of the distinct rows that can be compared.

    Left out: null ids, null vectors, vectors with null or non-finite components, and vectors without length. Only the
    most frequent dimension takes part (the smaller one of equally frequent ones).
    """
    x = F.col("vector")
    numbers = vectors.select(F.col(id_name).alias("node"), F.col(vector).cast("array<double>").alias("vector")).where(
        F.col("node").isNotNull() & x.isNotNull()
        & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
        & F.exists(x, lambda v: v != 0))
    common = numbers.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return numbers.where(F.size("vector") == (common.d if common else 0)).distinct()


def sample(numbers: DataFrame, rows: int) -> np.ndarray:
    """At most about `rows` vectors, chosen by the hash of their ids: a bounded sample to fit a rotation on."""
    total = numbers.count()
    share = min(1.0, rows / max(total, 1))
    picked = numbers.where(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).orderBy("node").limit(2 * rows).collect()
    return np.array([r.vector for r in picked], dtype=np.float64)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equal lengths as a two-dimensional array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
