"""Inputs and small frame helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.sources.tables import scratch_path

# Rows of an Arrow batch that goes to a Python worker: whole texts, so a batch of long ones must fit a worker.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def python_tasks(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Readies the session for Python tasks: bounds the rows a worker holds at once and gives workers this package's code.

    The code goes out once per application as a zip that Spark serves to its executors, so that they need no install.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).resolve().parents[1]
        place = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(place, "w") as archive:
            for source in sorted(package.rglob("*.py")):
                archive.write(source, source.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(place))
        _shipped.add(application)


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The frame written once to the shared folder and read back, and its place (see `drop_path`, `clear_scratch`)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back: its work is never repeated, whatever executors go."""
    return stored_at(df, name)[0]


def numbered(rows: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows with columns in_0, in_1, ..., and the new name of each: names of further columns then cannot clash."""
    return rows.toDF(*[f"in_{i}" for i in range(len(rows.columns))]), {c: f"in_{i}" for i, c in enumerate(rows.columns)}


def text_column(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def crc_remainder(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id written as text, modulo `modulus`; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus, F.lit(-1))


def gathered(batches: Iterator[pa.RecordBatch], limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches put together until they hold `limit` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= limit:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of consecutive rows with equal keys, from batches sorted by the keys; holds one group at a time."""
    held: list[pa.Table] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        columns = [part.column(k).to_numpy() for k in keys]
        new = np.ones(len(part), bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        starts = np.flatnonzero(new)
        for start, end in zip(starts, np.append(starts[1:], len(part))):
            key = tuple(c[start] for c in columns)
            if held and key != held_key:
                yield pa.concat_tables(held)
                held = []
            held_key = key
            held.append(part.slice(start, end - start))
    if held:
        yield pa.concat_tables(held)
