"""Written intermediate tables, and small helpers that the operators share."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlake.staging import discard, new_folder


# seconds between two times that the driver is made to collect its unused frames
RELEASE_S = 3.0


class Scratch:
    """A folder in the shared place for the tables of one run of an operator.

    ``keep`` writes a table and reads it back, so that it is computed once and
    outlives the executors that made it. Then shuffle files that no frame needs
    any more are given up, by letting the driver collect its unused frames.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.folder = new_folder(spark, name)
        self.name = self.folder.rpartition("/")[2].replace("-", "_")
        self.tables: set[str] = set()
        self.released = 0.0

    def keep(self, df: DataFrame, table: str, buckets: tuple[str, ...] = ()) -> DataFrame:
        """``buckets`` deals the rows by these columns, so that later joins on them move only the other side."""
        path = f"{self.folder}/{table}"
        self.tables.add(table)
        writer = df.write.option("compression", "zstd")
        if buckets:
            name = f"{self.name}_{table}"
            count = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            writer.bucketBy(count, *buckets).option("path", path).format("parquet").saveAsTable(name)
            written = self.spark.table(name)
        else:
            writer.parquet(path)
            written = self.spark.read.schema(df.schema).parquet(path)
        del df, writer
        self.release()
        return written

    def release(self) -> None:
        """Not more than once in ``RELEASE_S``: the pause costs more than short steps leave behind."""
        if time.monotonic() - self.released < RELEASE_S:
            return
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
        self.released = time.monotonic()

    def drop(self, *tables: str) -> None:
        """Delete tables that no later step reads."""
        for table in tables:
            self.tables.discard(table)
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{table}")
            discard(self.spark, f"{self.folder}/{table}")


    def leave(self, *tables: str) -> None:
        """Delete all tables but these, which a result still reads."""
        self.drop(*(self.tables - set(tables)))


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns, whatever else the table has."""
    return df.select(*(df[name] for name in columns))


def part(key: str, parts: int) -> Column:
    """The part, of ``parts``, that a row's key falls in: crc32 of its text; NULL keys in none."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(parts))
