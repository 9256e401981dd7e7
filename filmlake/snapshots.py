"""Versions of a group of tables, of which one small file says which is current.

Below a root, ``tables`` holds Parquet folders that are written once and never changed, and
``manifests`` a numbered JSON file for each version: the folders that each table consists of. A
version exists from the moment its manifest has its name. That is the only step that makes a change
seen, so a reader finds one version or the next one, whole; a writer that dies before it leaves nothing but
folders that no manifest names. Adding rows writes a further folder and a manifest that names the old ones too.

A manifest is written under another name and renamed, which is one step in a file system; an
object store copies the few bytes instead, and they appear whole. Two writers that start from the same version can't
both make the next one: the later one fails. (An object store without conditional writes leaves
a gap between the look and the copy; there let one writer at a time change a root.)
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from filmlake.staging import discard, hadoop_path

# versions that stay readable besides the current one
KEPT = 2


class Conflict(RuntimeError):
    """Another writer has made a version since the one that this one started from."""


@dataclass(frozen=True)
class Snapshot:
    """A version: its number, 0 before the first, and the folders of each table."""

    root: str
    number: int = 0
    tables: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def read(self, spark: SparkSession, table: str, schema: StructType) -> DataFrame:
        """All rows of a table; none if the version lacks it."""
        paths = [f"{self.root}/tables/{folder}" for folder in self.tables.get(table, ())]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _numbers(spark: SparkSession, root: str) -> dict[int, str]:
    """The manifests there are, by number."""
    path, files = hadoop_path(spark, f"{root}/manifests")
    if not files.exists(path):
        return {}
    names = (status.getPath().getName() for status in files.listStatus(path))
    return {int(name.removesuffix(".json")): name for name in names if name.removesuffix(".json").isdigit()}


def _load(spark: SparkSession, root: str, number: int) -> Snapshot:
    path, files = hadoop_path(spark, f"{root}/manifests/{number:08d}.json")
    stream = files.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Snapshot(root, number, json.loads(text))


def current(spark: SparkSession, root: str) -> Snapshot | None:
    """The newest version; none if there has never been one."""
    numbers = _numbers(spark, root)
    return _load(spark, root, max(numbers)) if numbers else None


def new_table(root: str, table: str) -> tuple[str, str]:
    """Name and path of a folder for rows of a table, that no version knows yet."""
    name = f"{table}-{uuid.uuid4().hex}"
    return name, f"{root}/tables/{name}"


def commit(spark: SparkSession, base: Snapshot, tables: Mapping[str, Sequence[str]]) -> Snapshot:
    """Make a version of these folders, all written, that follows ``base``."""
    number = base.number + 1
    goal, files = hadoop_path(spark, f"{base.root}/manifests/{number:08d}.json")
    draft, _ = hadoop_path(spark, f"{base.root}/manifests/_{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps({name: list(folders) for name, folders in tables.items()}).encode()))
    out.close()
    newest = max(_numbers(spark, base.root), default=0)
    if newest != base.number or not files.rename(draft, goal):
        files.delete(draft, False)
        raise Conflict(f"{base.root} is at version {newest}, this one was to follow {base.number}")
    return Snapshot(base.root, number, dict(tables))


def expire(spark: SparkSession, root: str, keep: int = KEPT) -> None:
    """Delete versions but the current one and ``keep`` before it, and folders only they name."""
    numbers = sorted(_numbers(spark, root))
    old = [_load(spark, root, n) for n in numbers[: -keep - 1]]
    if not old:
        return
    used = {x for n in numbers[-keep - 1 :] for folders in _load(spark, root, n).tables.values() for x in folders}
    for snapshot in old:  # the oldest first, a reader takes the newest
        discard(spark, f"{root}/manifests/{snapshot.number:08d}.json")
    for folder in {x for snapshot in old for folders in snapshot.tables.values() for x in folders} - used:
        discard(spark, f"{root}/tables/{folder}")
