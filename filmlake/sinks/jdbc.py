"""Relational sink."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    batch_size: int | None = None,
    timeout: int | None = None,
    writers: int | None = None,
) -> None:
    """Append rows to a relational table, one transaction per partition.

    ``batch_size`` rows go in one insert, a statement may take ``timeout``
    seconds, and at most ``writers`` connections are open at once. The target's
    primary key guards against a retried task inserting twice.
    """
    options = {
        "batchsize": batch_size,
        "queryTimeout": timeout,
        "numPartitions": writers,
    }
    writer = df.write.mode("append")
    for name, value in options.items():
        if value is not None:
            writer = writer.option(name, str(value))
    writer.jdbc(url, table, properties=dict(properties or {}))
