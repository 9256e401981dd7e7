"""Session for the command line, the tests and the benchmark."""

from __future__ import annotations

from math import ceil

from pyspark.sql import SparkSession

PARTITION_BYTES = 128 * 1024**2
MIN_PARTITIONS = 200


def shuffle_partitions(input_bytes: int) -> int:
    """Partitions a shuffle of the whole input starts with, so that each fits a task.

    Adaptive execution merges the small ones afterwards, so too many costs
    little while too few spill.
    """
    return max(MIN_PARTITIONS, ceil(input_bytes / PARTITION_BYTES))


def get_spark(
    app: str = "filmlake",
    master: str | None = None,
    input_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """Session with adaptive execution and skew splitting on.

    ``input_bytes`` sizes the shuffles; without it the cluster's setting holds.
    Keyword names use ``__`` for the dots of a Spark setting.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    if input_bytes is not None:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            str(shuffle_partitions(input_bytes)),
        )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()
