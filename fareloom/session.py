"""Session settings used by the benchmark and the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "fareloom", **conf: str) -> SparkSession:
    """A session with adaptive execution and skew handling on, in UTC.

    On a cluster leave `master` and `shuffle_partitions` unset: the submit settings and
    adaptive coalescing decide. Locally the partition count should be near the core count.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Call-site capture for every column expression costs more than building the plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
        )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def compile_in_short_methods(spark: SparkSession) -> None:
    """Have rows of many columns made by several short methods.

    Spark's default puts a stage into one method of up to 65,535 bytes of code. The JVM leaves methods of more than 8,000
    bytes interpreted, which makes a hundred derived columns several times slower. A limit that was set by the user stays.
    """
    if spark.conf.get(METHOD_LIMIT, "65535") == "65535":
        spark.conf.set(METHOD_LIMIT, "8000")
