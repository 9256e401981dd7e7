"""Written tables that cut lineage, in the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; without one, the session's warehouse.

    Executors must reach it. A warehouse in a folder of the driver's machine, which is where an
    unconfigured session has it, is taken only when all executors run there too.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.conf.get("spark.sql.warehouse.dir")
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme()
        if store == "file" and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors reach; {folder} is one machine's")
    return folder.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """Spark's own view of a path and of the store it lies in."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared one, deleted when the session's driver ends."""
    path = f"{shared_folder(spark)}/filmlake-{name}-{uuid.uuid4().hex}"
    jvm_path, files = hadoop_path(spark, path)
    files.mkdirs(jvm_path)
    files.deleteOnExit(jvm_path)
    return path


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once and hand back the written table.

    Unlike a cache it outlives its executors and is read column by column.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def move(spark: SparkSession, source: str, goal: str) -> None:
    """Give a written table another name."""
    path, files = hadoop_path(spark, source)
    if not files.rename(path, hadoop_path(spark, goal)[0]):
        raise OSError(f"{source} could not be moved to {goal}")


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table when the run that wrote it is over."""
    jvm_path, files = hadoop_path(spark, path)
    files.delete(jvm_path, True)
