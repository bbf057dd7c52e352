"""Readers and writers of the ride tables, splits and artifacts."""

from __future__ import annotations

import json
import tempfile
import threading
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.sources import schemas

_local_scratch: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's shared `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    global _local_scratch
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"file://{_local_scratch}"


_scratch: dict[str, set[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new place for an intermediate table; it belongs to the application until `drop_path` or `clear_scratch`."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    _scratch.get(spark.sparkContext.applicationId, set()).discard(path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application. Frames that read them are of no use afterwards."""
    for path in list(_scratch.get(spark.sparkContext.applicationId, ())):
        drop_path(spark, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def settled(df: DataFrame, name: str = "settled", even: bool = False, folder: str | None = None) -> DataFrame:
    """The frame written once as Parquet and read back: later jobs start from files, whatever executors are lost.

    With `even` the rows are rebalanced first. That is one more shuffle, for tables that many jobs scan: joins on
    hot keys or few large inputs would otherwise leave files of very different size.
    """
    # A new name each time: a write that died half-way never stands in the way of the next attempt.
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder else scratch_path(df.sparkSession, name)
    (df.hint("rebalance") if even else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Tables ------------------------------------------------------------------------------------------------------------

def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    (
        df.write.mode(mode)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def load_raw_data(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five delivered CSV tables `<folder>/<table>.csv`."""
    return {name: read_csv(spark, f"{folder}/{name}.csv", s) for name, s in schemas.RAW_TABLES.items()}


def load_cleaned_data(spark: SparkSession, folder: str, register: bool = False) -> dict[str, DataFrame]:
    """The five cleaned Parquet tables `<folder>/<table>`, also as temp views if asked."""
    names = [n for n in schemas.TABLES if n != "predictions"]
    tables = {n: spark.read.parquet(f"{folder}/{n}") for n in names}
    if register:
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
    return tables


def write_tables(tables: Mapping[str, DataFrame], folder: str, form: str = "parquet") -> None:
    for name, df in tables.items():
        if form == "csv":
            write_csv(df, f"{folder}/{name}.csv")
        else:
            df.write.mode("overwrite").parquet(f"{folder}/{name}")


def create_tables(spark: SparkSession, database: str | None = None, location: str | None = None) -> list[str]:
    """Drop and create the six typed tables in the catalog; returns their names."""
    made = []
    for name, schema in schemas.TABLES.items():
        full = f"{database}.{name}" if database else name
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        options = {"path": f"{location}/{name}"} if location else {}
        spark.catalog.createTable(full, source="parquet", schema=schema, **options)
        made.append(full)
    return made


def append_rows(df: DataFrame, path: str, table: str) -> None:
    """Append rows to a table in its declared column order and types."""
    typed = schemas.narrow(df, table)
    typed.select(*[c for c in schemas.TABLES[table].names if c in typed.columns]).write.mode("append").parquet(path)


def replace_predictions(predictions: DataFrame, path: str) -> DataFrame:
    """Replace all stored predictions; returns the stored rows per risk tier."""
    predictions.write.mode("overwrite").parquet(path)
    stored = predictions.sparkSession.read.schema(predictions.schema).parquet(path)
    return tier_counts(stored)


PREDICTION_KEY = ("booking_id", "model_version")


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key is null or comes more than once; only a few offending keys reach the driver."""
    bad = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) | reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))
        .limit(5).collect()
    )
    if bad:
        raise ValueError(f"{', '.join(keys)} must be unique and not null, but not so: {[tuple(r) for r in bad]}")


def replace_versions(predictions: DataFrame, path: str) -> DataFrame:
    """Replace the stored predictions of every model version that occurs in `predictions`; other versions stay.

    A booking comes once per version, else nothing is written. The rows are staged first and take the place of the old
    ones when all of them are there: a write that fails leaves the table as it was, a rerun gives the same table. Frames
    without rows replace nothing. Returns the stored table.
    """
    staged = settled(predictions, "staged")
    require_unique(staged, PREDICTION_KEY)
    (
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("model_version").parquet(path)
    )
    return predictions.sparkSession.read.schema(predictions.schema).parquet(path).select(*predictions.columns)


def tier_counts(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("cancel_risk_tier").agg(F.count(F.lit(1)).alias("count"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def run_query(spark: SparkSession, sql: str, params: Mapping[str, object] | None = None, **frames: DataFrame) -> DataFrame:
    """A SQL text with `:name` parameters; keyword frames are usable in it as `{name}`. A failing text raises."""
    return spark.sql(sql, args=dict(params or {}), **frames)


class QueryCache:
    """Results of SQL texts, kept for `lifetime` seconds per text, parameters and frames.

    Expired results are released at the next call of any query, so that no more is held than was asked for within a
    lifetime. A result that is still in use by its caller stays correct after its release: Spark computes it again.
    """

    def __init__(self, spark: SparkSession, lifetime: float = 300.0, clock: Callable[[], float] = time.monotonic) -> None:
        self.spark, self.lifetime, self._clock = spark, lifetime, clock
        self._held: dict[tuple, tuple[float, DataFrame, dict[str, DataFrame]]] = {}
        self._lock = threading.Lock()

    def __len__(self) -> int:
        return len(self._held)

    def query(self, sql: str, params: Mapping[str, object] | None = None, **frames: DataFrame) -> DataFrame:
        key = (sql, tuple(sorted((k, repr(v)) for k, v in (params or {}).items())),
               tuple(sorted((n, f.semanticHash()) for n, f in frames.items())))
        with self._lock:
            now = self._clock()
            self._release([k for k, (since, _, _) in self._held.items() if now - since >= self.lifetime])
            if key in self._held:
                _, result, given = self._held[key]
                if all(given[n].sameSemantics(f) for n, f in frames.items()):
                    return result
                self._release([key])  # another frame of the same hash
            result = run_query(self.spark, sql, params, **frames).cache()
            self._held[key] = (now, result, frames)
            return result

    def release(self) -> None:
        """Drop all results now."""
        with self._lock:
            self._release(list(self._held))

    def _release(self, keys: Sequence[tuple]) -> None:
        for key in keys:
            self._held.pop(key)[1].unpersist()


# Splits and artifacts ----------------------------------------------------------------------------------------------

def save_split(split: DataFrame, folder: str, use_case: str) -> None:
    """Store a split frame (column `split` is 'train' or 'test'), partitioned by use case and split."""
    split.write.mode("overwrite").partitionBy("split").parquet(f"{folder}/use_case={use_case}")


def load_split(spark: SparkSession, folder: str, use_case: str) -> tuple[DataFrame, DataFrame]:
    stored = spark.read.parquet(f"{folder}/use_case={use_case}")
    return tuple(stored.filter(F.col("split") == part).drop("split") for part in ("train", "test"))


def save_model(model: PipelineModel, folder: str, name: str) -> None:
    model.write().overwrite().save(f"{folder}/{name}")


def load_model(folder: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{folder}/{name}")


def save_json(spark: SparkSession, content: object, path: str) -> None:
    """Store a small document (thresholds, feature names, parameters, report) as one JSON text."""
    spark.createDataFrame([(json.dumps(content, sort_keys=True),)], "value STRING").coalesce(1).write.mode(
        "overwrite").text(path)


def load_json(spark: SparkSession, path: str, default: object = None) -> object:
    """The stored document, or `default` when there is none."""
    if not path_exists(spark, path):
        return default
    return json.loads(spark.read.text(path).first()["value"])
