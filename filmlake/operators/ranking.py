"""Top-k with ties, first rows, sorted pages and extracts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmlake.staging import new_folder, stage


def ranked_top(
    df: DataFrame, by: Sequence[str], order: str, k: int, rank: str = "ranking"
) -> DataFrame:
    """Rows whose rank within their group is at most ``k``, ties kept, by a window.

    For groups that are small by nature: the tied rows of a group meet in one
    task. ``top_with_ties`` gives the same rows for groups of any size.
    """
    places = Window.partitionBy(*by).orderBy(F.col(order).desc_nulls_last())
    return df.withColumn(rank, F.rank().over(places)).filter(F.col(rank) <= k)


def top_with_ties(
    df: DataFrame, by: Sequence[str], order: str, k: int, rank: str = "ranking"
) -> DataFrame:
    """The rows of ``ranked_top`` without bringing a group, or its ties, together.

    A group is dealt over as many parts as there are shuffle partitions, by a hash
    of the row. A row whose rank within its part is over ``k`` has no place in its
    group, so only candidates go on; up to a ``k`` of
    ``spark.sql.optimizer.windowGroupLimitThreshold`` each task finds its own
    before it sends any. Candidates are counted by group, value and part, where there
    are any. A value's place is one more than the rows of its group above it; places meet the
    candidates by group, value and part, so neither a group nor equal values gather, and there are
    never more places than candidates, however many groups. The candidates are shuffled once for
    both sides. They are counted in the order that the rank has sorted them in already, so a task holds
    them in one sort and no hash map. Columns must be of types that can be hashed.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    best = F.col(order).desc_nulls_last()
    hashed = F.xxhash64(*df.columns)
    in_part = Window.partitionBy(*by, "_part").orderBy(best)
    near = (
        df.withColumn("_part", F.pmod(hashed, F.lit(parts)).cast("int"))
        .withColumn("_near", F.rank().over(in_part))
        .filter(F.col("_near") <= k)
    )

    def down_to(window):
        """Peers included: the rows down to and with this value."""
        return window.rangeBetween(Window.unboundedPreceding, Window.currentRow)

    # of every row; the hash keeps all columns, so that both sides read the same shuffled candidates
    any_row = F.when(F.col("_part") >= 0, hashed)
    counts = (
        near.withColumns({"_at": F.row_number().over(in_part), "_down": F.count(any_row).over(down_to(in_part))})
        # the first row of each value stands for it
        .filter(F.col("_at") == F.col("_near"))
        .select(*by, order, "_part", (F.col("_down") - F.col("_near") + 1).alias("_rows"))
    )
    in_group = Window.partitionBy(*by).orderBy(best)
    # at most one count of each part
    equal = in_group.rangeBetween(Window.currentRow, Window.currentRow)
    places = (
        counts.withColumns({"_down": F.sum("_rows").over(down_to(in_group)), "_equal": F.sum("_rows").over(equal)})
        .withColumn(rank, (F.col("_down") - F.col("_equal") + 1).cast("int"))
        .filter(F.col(rank) <= k)
        .select(*(F.col(name).alias(f"_of_{name}") for name in (*by, order, "_part")), rank)
    )
    same = (F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in (*by, order, "_part"))
    return near.join(places, reduce(and_, same)).select(*df.columns, rank)


def first_rows(df: DataFrame, n: int, key: Sequence[str] = ()) -> DataFrame:
    """``n`` rows, the first by ``key`` or any if none is given."""
    return (df.orderBy(*key) if key else df).limit(n)


def schema_rows(df: DataFrame) -> DataFrame:
    """Name and type of each column, as rows."""
    return df.sparkSession.createDataFrame(df.dtypes, "column_name string, column_type string")


# The sort keys of an extract, each taken ".desc" or ".asc"
SORT_FIELDS = (
    "original_title",
    "title",
    "popularity",
    "revenue",
    "primary_release_date",
    "vote_average",
    "vote_count",
)
SORT_KEYS = tuple(f"{field}.{way}" for field in SORT_FIELDS for way in ("desc", "asc"))

# A collection takes every sort key but the most popular first
EXTRACTS = tuple(key for key in SORT_KEYS if key != "popularity.desc")
PAGE_SIZE = 20
# rows up to which a page is taken from the best rows of each task
SHALLOW = 10_000

# the record field behind a sort field, where the names differ
FIELD_COLUMNS = {"primary_release_date": "release_date"}


def sort_order(sort_by: str) -> Column:
    """Order of a sort key, NULLs last either way."""
    if sort_by not in SORT_KEYS:
        raise ValueError(f"unknown sort key {sort_by!r}, expected one of {', '.join(SORT_KEYS)}")
    field, way = sort_by.split(".")
    column = F.col(FIELD_COLUMNS.get(field, field))
    return column.desc_nulls_last() if way == "desc" else column.asc_nulls_last()


def _ranges(df: DataFrame, sort_keys: Sequence[str], key: str) -> DataFrame:
    """``extract``, ``position`` from 1, and ``_key`` of each row in each of the orders.

    One shuffle deals all orders over ranges of (extract, order, key). Only the column that an
    extract is sorted by counts in its rows: there is one sort column for each type and direction, and
    the others are NULL. Ranges are written once, as a second run might cut them elsewhere; a row's position is its
    place in its range, and the rows in the ranges of its extract before. No task holds more than a range.
    """
    columns: dict[tuple[str, bool], Column] = {}
    for sort_by in sort_keys:
        field, way = sort_by.split(".")
        name = FIELD_COLUMNS.get(field, field)
        kind = (df.schema[name].dataType.simpleString(), way == "desc")
        columns[kind] = F.when(F.col("extract") == sort_by, F.col(name)).otherwise(columns.get(kind, F.lit(None)))
    names = [f"_order{i}" for i in range(len(columns))]
    order = [
        F.col(name).desc_nulls_last() if falls else F.col(name).asc_nulls_last()
        for name, (_, falls) in zip(names, columns, strict=True)
    ]
    tagged = df.select("*", F.explode(F.array(*map(F.lit, sort_keys))).alias("extract")).select(
        "extract", F.col(key).alias("_key"), *(c.alias(name) for name, c in zip(names, columns.values(), strict=True))
    )
    by = ["extract", *order, "_key"]
    dealt = tagged.repartitionByRange(*by).sortWithinPartitions(*by)
    spark = df.sparkSession
    # the upper bits of the id are the range, the lower ones the place in it
    placed = stage(
        dealt.select("extract", "_key", F.monotonically_increasing_id().alias("_at")),
        f"{new_folder(spark, 'ranges')}/placed",
    ).withColumn("_range", F.shiftrightunsigned("_at", 33))
    before = Window.partitionBy("extract").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("extract", "_range")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
        .select("extract", "_range", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_start"))
    )
    # a row for each range and extract in it
    return placed.join(F.broadcast(starts), ["extract", "_range"]).select(
        "extract", (F.col("_start") + F.col("_at") + 1).alias("position"), "_key"
    )


def sorted_page(
    df: DataFrame,
    sort_by: str,
    first_page: int = 1,
    pages: int | None = None,
    page_size: int = PAGE_SIZE,
    key: str = "id",
) -> DataFrame:
    """``pages`` pages of the sorted table from ``first_page`` on, ties by ``key``.

    Without ``pages`` it is the whole table, sorted over all tasks. Pages that end within
    ``SHALLOW`` rows are taken from the best rows of each task. Deeper ones are found by position, so
    that no task holds the rows before them; ``key`` identifies a row then.
    """
    order = sort_order(sort_by)
    if pages is None:
        if first_page != 1:
            raise ValueError("all pages start with the first")
        return df.orderBy(order, F.col(key).asc())
    if (first_page - 1 + pages) * page_size <= SHALLOW:
        return df.orderBy(order, F.col(key).asc()).offset((first_page - 1) * page_size).limit(pages * page_size)
    found = union_of_extracts(df, [sort_by], pages, page_size, key, first_page)
    return found.orderBy("position").select(*df.columns)


def union_of_extracts(
    df: DataFrame,
    sort_keys: Sequence[str] = EXTRACTS,
    pages: int | None = None,
    page_size: int = PAGE_SIZE,
    key: str = "id",
    first_page: int = 1,
) -> DataFrame:
    """One extract per sort key, tagged with it and with each row's ``position``; a row may be in many.

    ``key`` identifies a row. Without ``pages`` every extract holds every row. All orders are settled at
    once on their sort columns, by ranges that are written when this is called; the whole rows are
    fetched in one further pass. Pages at any depth cost the same.
    """
    for sort_by in sort_keys:
        sort_order(sort_by)
    placed = _ranges(df, sort_keys, key)
    if pages is not None:
        start = (first_page - 1) * page_size
        placed = placed.filter((F.col("position") > start) & (F.col("position") <= start + pages * page_size))
    return df.join(placed, F.col(key).eqNullSafe(F.col("_key"))).select("extract", "position", *df.columns)
