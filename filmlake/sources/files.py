"""JSON sources, read with a fixed schema so that no inference job runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from filmlake.schemas import CORRUPT, FILM_RAW, GENRE_RAW

FILM_FILES = "*.jsonl"


# what tells a file from another, or from a later state of itself
SOURCES = StructType([
    StructField("path", StringType()),
    StructField("length", LongType()),
    StructField("modificationTime", TimestampType()),
])


def list_files(spark: SparkSession, folder: str, pattern: str = FILM_FILES) -> DataFrame:
    """The files of ``folder`` that match ``pattern``; none of them is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(*SOURCES.names)


def read_films(
    spark: SparkSession,
    folder: str | list[str],
    pattern: str = FILM_FILES,
    schema: StructType = FILM_RAW,
) -> DataFrame:
    """Every JSON-lines file of ``folder`` that matches ``pattern``, or of a list of files, as one table.

    Columns are matched by name in each file. A line that is not JSON keeps its
    text in ``_corrupt_record``; ``source_file`` tells where a row came from. A
    folder without matching files gives no rows.
    """
    return (
        spark.read.schema(StructType([*schema.fields, StructField(CORRUPT, StringType())]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", pattern)
        .json(folder)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )


def read_genres(spark: SparkSession, path: str) -> DataFrame:
    """One JSON array of ``{id, genero}`` objects; ids become numbers here, once."""
    return (
        spark.read.schema(GENRE_RAW)
        .option("multiLine", True)
        .json(path)
        .select(F.col("id").cast("long").alias("id"), "genero")
    )
