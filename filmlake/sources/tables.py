"""Tables that are not files: relational ones, local rows, named views."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A relational table; filters and columns are pushed into its query.

    With a numeric ``key`` and its ``bounds`` the table is read in ``partitions``
    slices at once. Rows outside the bounds are still read, by the outer slices.
    """
    properties = dict(properties or {})
    if key is None:
        return spark.read.jdbc(url, table, properties=properties)
    if bounds is None or partitions is None:
        raise ValueError("a sliced read needs key, bounds and partitions")
    return spark.read.jdbc(
        url,
        table,
        column=key,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=partitions,
        properties=properties,
    )


def local_rows(spark: SparkSession, rows: Iterable, schema: StructType | str) -> DataFrame:
    """A few rows held by the program, with their types stated."""
    return spark.createDataFrame(list(rows), schema)


def read_table(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame:
    """A whole named table: a dataset below ``folder``, or a view of the session."""
    if folder is None:
        return spark.table(name)
    return spark.read.parquet(f"{folder}/{name}")


def list_views(spark: SparkSession, database: str | None = None) -> list[str]:
    """Names of the views of a schema, temporary ones included, sorted."""
    return sorted(
        table.name
        for table in spark.catalog.listTables(database)
        if table.tableType in ("VIEW", "TEMPORARY")
    )
