"""File sinks. Each writes from the executors and counts rows as they pass.

The count sits on top of the plan, in the stage that writes, where Spark takes
each output partition once however often a task is retried.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from filmlake.staging import discard, move

# rows of one JSON document
DOCUMENT_ROWS = 10_000


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _in_files(df: DataFrame, num_files: int | None) -> DataFrame:
    """Leave the file count to the plan, or spread the rows over ``num_files``."""
    return df if num_files is None else df.repartition(num_files)


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", num_files: int | None = None
) -> int:
    """Write Parquet in a save mode of the caller's choice; rows written."""
    counted, seen = _counted(_in_files(df, num_files))
    counted.write.mode(mode).parquet(path)
    return seen.get["rows"]


def write_parquet_unless_empty(df: DataFrame, path: str, num_files: int | None = None) -> int:
    """Overwrite ``path``, but leave it as it is when there is nothing to write.

    The rows are computed once: they are written beside ``path``, and take its place if there are any.
    """
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    spark = df.sparkSession
    try:
        rows = write_parquet(df, beside, num_files=num_files)
        if rows:
            discard(spark, path)
            move(spark, beside, path)
            spark.catalog.refreshByPath(path)
    finally:
        discard(spark, beside)
    return rows


def write_csv(df: DataFrame, path: str, num_files: int | None = None) -> int:
    """CSV with a header and doubled quotes; rows written.

    A small result comes out as one file because adaptive execution merges its
    partitions; ``num_files=1`` forces that, for results known to be small.
    """
    if num_files is not None:
        df = df.coalesce(num_files)
    counted, seen = _counted(df)
    counted.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return seen.get["rows"]


def write_json_lines(df: DataFrame, path: str, split_by: str | None = None) -> int:
    """Append one UTF-8 JSON object per row, NULL fields included; rows written.

    ``split_by`` puts the rows of each value into a folder of their own.
    """
    counted, seen = _counted(df)
    writer = counted.write.mode("append").option("ignoreNullFields", False)
    if split_by is not None:
        writer = writer.partitionBy(split_by)
    writer.json(path)
    return seen.get["rows"]


def write_json_array(df: DataFrame, path: str, document_rows: int = DOCUMENT_ROWS) -> None:
    """Write a table as JSON arrays, one document a file, of at most ``document_rows`` rows each.

    A table that fits is one document, rows in column order. A larger one is dealt by ranges of its
    values, each cut into documents. A row's number is part of what ranges are cut by, so equal rows,
    however many, go over as many tasks as their share takes. An empty table gives no
    document. Columns must be of types that can be sorted.
    """
    if df.limit(document_rows + 1).count() > document_rows:
        order = [*df.columns, "_number"]
        dealt = df.withColumn("_number", F.monotonically_increasing_id()).repartitionByRange(*order)
        dealt = dealt.sortWithinPartitions(*order)
    else:
        dealt = df.repartition(1)
    # the upper bits of the id are the task, the lower ones the row in it
    at = F.monotonically_increasing_id()
    place = F.floor(at.bitwiseAND(F.lit((1 << 33) - 1)) / document_rows)
    rows = F.sort_array(F.collect_list(F.struct(*df.columns)))
    documents = (
        dealt.select(F.shiftrightunsigned(at, 33).alias("_task"), place.alias("_document"), *df.columns)
        .groupBy("_task", "_document")
        .agg(F.to_json(rows, {"ignoreNullFields": "false"}).alias("value"))
    )
    documents.select("value").write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
